"""Cleaning, coercion and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.functions.numbers import money, number_or_zero, percent
from hustings.functions.text import category, contains_any, major_party, missing_to_null, strip, title_case
from hustings.operators.cleaning import drop_incomplete, drop_none_of_above, with_defaults
from hustings.operators.models import outcome_label
from hustings.sources.pages import standard_name
from hustings.sources.sinks import project_existing

_CANDIDATE = """case event_type when 'error' then 'NOTA' when 'view' then 'None Of The Above' else event_type end"""


def _clean_sql(names: str) -> str:
    return f"""with e as (
      select event_id, {_CANDIDATE} as candidate, case when value >= 2 then user_id end as constituency,
        case when value < 12 then value end as total_votes_raw, case when user_id < 75 then event_type end as party
      from events)
    select event_id, candidate, constituency, total_votes_raw, coalesce(party, 'IND') as party, 0 as crim_count from e
    where candidate is not null and constituency is not null and total_votes_raw is not null and {names}"""


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "NOTA").when(kind == "view", "None Of The Above").otherwise(kind).alias("candidate"),
        F.when(F.col("value") >= 2, F.col("user_id")).alias("constituency"),
        F.when(F.col("value") < 12, F.col("value")).alias("total_votes_raw"),
        F.when(F.col("user_id") < 75, kind).alias("party"),
    )


@query("p4_clean", _clean_sql("upper(candidate) not in ('NOTA', 'NONE OF THE ABOVE')"))
def clean_broad(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = drop_incomplete(_event_records(spark, sf_dir), ["candidate", "constituency", "total_votes_raw"])
    return with_defaults(drop_none_of_above(complete), {"party": "IND", "crim_count": 0})


@query("p4_clean_exact", _clean_sql("candidate <> 'NOTA'"))
def clean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = drop_incomplete(_event_records(spark, sf_dir), ["candidate", "constituency", "total_votes_raw"])
    return with_defaults(drop_none_of_above(complete, broad=False), {"party": "IND", "crim_count": 0})


_RAW = """case event_type when 'click' then ' ' || cast(user_id as varchar) || ' ' when 'view' then
  '1,' || cast(user_id as varchar) when 'error' then '0x' || cast(user_id as varchar)
  when 'purchase' then cast(user_id as varchar) || 'e1' else cast(user_id as varchar) || 'd' end"""


@query(
    "f1_coerce",
    f"""with e as (select event_id, {_RAW} as raw from events)
    select event_id, raw, case when regexp_matches(raw, '^\\s*[+-]?[0-9]+(e[0-9]+)?\\s*$')
      then cast(trim(raw) as double) else 0.0 end as votes from e""",
)
def coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    raw = (
        F.when(kind == "click", F.concat(F.lit(" "), user, F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("1,"), user))
        .when(kind == "error", F.concat(F.lit("0x"), user))
        .when(kind == "purchase", F.concat(user, F.lit("e1")))
        .otherwise(F.concat(user, F.lit("d")))
    )
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).withColumn("votes", number_or_zero(F.col("raw")))


@query(
    "f2_title",
    r"""with t as (select p_partkey, ' ' || upper(p_name) || '-' || p_brand || '''' || lower(p_type) || chr(9) as raw from part)
    select p_partkey, regexp_replace(regexp_replace(list_aggregate(list_transform(
      regexp_extract_all(lower(raw), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), 'string_agg', ''),
      '^\s+', ''), '\s+$', '') as title from t""",
)
def title(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lit(" "), F.upper("p_name"), F.lit("-"), F.col("p_brand"), F.lit("'"), F.lower("p_type"), F.lit("\t")
    )
    return table(spark, sf_dir, "part").select("p_partkey", title_case(raw).alias("title"))


@query(
    "f6_money",
    """with c as (select c_custkey, case c_mktsegment when 'BUILDING' then 'Nil'
        when 'MACHINERY' then 'Rs ' || cast(c_custkey as varchar) || ' Crore ' || cast(c_nationkey as varchar) || ' Lacs'
        when 'HOUSEHOLD' then 'Rs ' || cast(c_custkey as varchar) || ',' || cast(c_nationkey as varchar) || ' ~ 9 Lacs+'
        when 'FURNITURE' then 'Rs ' || cast(c_nationkey as varchar) || '.50' else ' ' end as raw from customer)
    select c_custkey, raw, case when contains(raw, 'Nil') then 0.0 else coalesce(try_cast(regexp_replace(
      split_part(raw, '~', 1), '[^0-9]', '', 'g') as double), 0.0) end as amount from c""",
)
def money_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, key, nation = F.col("c_mktsegment"), F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    raw = (
        F.when(segment == "BUILDING", "Nil")
        .when(segment == "MACHINERY", F.concat(F.lit("Rs "), key, F.lit(" Crore "), nation, F.lit(" Lacs")))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("Rs "), key, F.lit(","), nation, F.lit(" ~ 9 Lacs+")))
        .when(segment == "FURNITURE", F.concat(F.lit("Rs "), nation, F.lit(".50")))
        .otherwise(" ")
    )
    return table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw")).withColumn("amount", money(F.col("raw")))


@query(
    "f5_major_flag",
    """select p_partkey,
      cast(contains(p_name, 'red') or contains(p_name, 'bolt') as int) as exact_case,
      cast(contains(p_name, 'RED') or contains(p_name, 'BOLT') as int) as wrong_case,
      cast(contains(upper(p_name), 'RED') or contains(upper(p_name), 'BOLT') as int) as any_case,
      cast(coalesce(contains(upper(nullif(p_type, 'SMALL')), 'ECO'), false) as int) as nullable
    from part""",
)
def major_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        major_party(name, ["red", "bolt"], any_case=False).alias("exact_case"),
        major_party(name, ["RED", "BOLT"], any_case=False).alias("wrong_case"),
        major_party(name, ["RED", "BOLT"]).alias("any_case"),
        major_party(F.nullif(F.col("p_type"), F.lit("SMALL")), ["ECO"]).alias("nullable"),
    )


@query(
    "f7_text_functions",
    r"""select p_partkey, coalesce(nullif(p_type, 'SMALL'), 'nan') as category, upper(p_name) as upper_name,
      lower(p_type) as lower_type, replace(replace('Rs 1,' || cast(p_size as varchar), 'Rs', ''), ',', '') as replaced,
      split_part(p_name, ' ', 1) as first_word, nullif(p_brand, 'Brand#1') is null as missing,
      regexp_replace(regexp_replace(chr(9) || p_name || chr(10), '^\s+', ''), '\s+$', '') as stripped,
      case when p_brand <> 'Brand#2' then p_brand end as not_missing_text
    from part""",
)
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        category(F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("category"),
        F.upper("p_name").alias("upper_name"),
        F.lower("p_type").alias("lower_type"),
        F.replace(
            F.replace(F.concat(F.lit("Rs 1,"), F.col("p_size").cast("string")), F.lit("Rs"), F.lit("")), F.lit(","), F.lit("")
        ).alias("replaced"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_word"),
        F.nullif(F.col("p_brand"), F.lit("Brand#1")).isNull().alias("missing"),
        strip(F.concat(F.lit("\t"), F.col("p_name"), F.lit("\n"))).alias("stripped"),
        missing_to_null(F.when(F.col("p_brand") == "Brand#2", "n/a").otherwise(F.col("p_brand"))).alias("not_missing_text"),
    )


@query(
    "p8_standard_names",
    """select event_id, case when contains(lower(props || event_type), 'err') then 'other' else event_type end as title,
      case event_type when 'click' then 'candidate' when 'view' then 'constituency' when 'purchase' then 'total_assets'
        else event_type end as name from events""",
)
def standard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", "CANDIDATE / Party")
        .when(kind == "view", "AC Constituency")
        .when(kind == "purchase", "Total Assets (Rs)")
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(contains_any(F.lower(F.concat("props", "event_type")), ["err"]), "other").otherwise(kind).alias("title"),
        standard_name(raw).alias("name"),
    )


@query(
    "p3_export_shape",
    """select 'state ' || l_returnflag as state, l_orderkey as constituency, l_linestatus as party,
      case when l_quantity > 25 then 'WIN' else 'LOSS' end as outcome,
      printf('%.2f%%', l_discount * 100) as share from lineitem""",
)
def export_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, prune, drop working columns, label and project the listed columns that exist."""
    renamed = table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "constituency", "l_linestatus": "party", "absent": "candidate"}
    )
    worked = renamed.withColumns(
        {
            "state": F.concat(F.lit("state "), F.col("l_returnflag")),
            "prediction": (F.col("l_quantity") > 25).cast("int"),
            "share": percent(F.col("l_discount")),
        }
    )
    labelled = worked.withColumn("outcome", outcome_label()).drop("prediction", "l_quantity")
    return project_existing(labelled, ["state", "constituency", "candidate", "party", "outcome", "share"])


@query("a3_class_balance", "select quality, count(*) as n from labels group by quality")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "labels").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "quality")


@query("a4_counts", "select count(*) as n_rows, count(distinct event_type) as n_sources from events")
def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_type").alias("n_sources")
    )


@query("t1_preview", "select event_type, event_id, user_id from events order by event_type, event_id limit 10")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "user_id")
    return events.orderBy("event_type", "event_id").limit(10)
