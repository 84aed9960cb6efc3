"""Vocabularies, codes and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.operators.encoding import SafeEncoder, SafeEncoderModel, encode_closed, field_values, sorted_codes, with_sentinel
from hustings.operators.ordering import balanced_folds, exact_median
from hustings.session import fresh_path


@query(
    "w3_encode",
    """with v as (
      select 'name' as field, c_name as value from customer union select 'name', s_name from supplier
      union select 'segment', c_mktsegment from customer union select 'segment', nullif(p_type, 'SMALL') from part
      union select 'name', 'UNKNOWN' union select 'segment', 'UNKNOWN')
    select field, value, cast(row_number() over (partition by field order by value) - 1 as int) as code
    from v where value is not null""",
)
def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary of past and future values, missing ones left out, with the sentinel."""
    past = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    coming = table(spark, sf_dir, "supplier").select("s_name")
    kinds = table(spark, sf_dir, "part").select(F.nullif(F.col("p_type"), F.lit("SMALL")).alias("kind"))
    values = (
        field_values(past, {"name": "c_name", "segment": "c_mktsegment"})
        .unionByName(field_values(coming, {"name": "s_name"}))
        .unionByName(field_values(kinds, {"segment": "kind"}))
    )
    return sorted_codes(with_sentinel(values, ["name", "segment"]))


@query(
    "j1_safe_encode",
    """with fit as (select substr(s_name, 10) as number, cast(s_nationkey as varchar) as nation from supplier),
    numbers as (select number as v from fit union select 'UNKNOWN'),
    nations as (select nation as v from fit union select 'UNKNOWN'),
    nc as (select v, cast(row_number() over (order by v) - 1 as int) as code from numbers),
    na as (select v, cast(row_number() over (order by v) - 1 as int) as code from nations)
    select c_custkey, coalesce(nc.code, (select code from nc where v = 'UNKNOWN')) as number_code,
      coalesce(na.code, (select code from na where v = 'UNKNOWN')) as nation_code
    from customer left join nc on nc.v = substr(c_name, 10)
      left join na on na.v = nullif(cast(c_nationkey as varchar), '7')""",
)
def safe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on suppliers, applied to customers: most numbers are unseen, some nations are missing."""
    past = table(spark, sf_dir, "supplier").select(
        F.substr("s_name", F.lit(10)).alias("number"), F.col("s_nationkey").cast("string").alias("nation")
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substr("c_name", F.lit(10)).alias("number"),
        F.nullif(F.col("c_nationkey").cast("string"), F.lit("7")).alias("nation"),
    )
    encoder = SafeEncoder(inputCols=["number", "nation"], outputCols=["number_code", "nation_code"])
    return encoder.fit(past).transform(rows).select("c_custkey", "number_code", "nation_code")


@query(
    "m3_kept_encoder",
    """with v as (select 'number' as field, substr(s_name, 10) as value from supplier union select 'number', substr(c_name, 10) from customer
        where c_custkey % 2 = 0 union select 'nation', cast(s_nationkey as varchar) from supplier
        union select 'nation', nullif(cast(c_nationkey as varchar), '7') from customer where c_custkey % 2 = 0
        union select 'number', 'UNKNOWN' union select 'nation', 'UNKNOWN'),
    code as (select field, value, cast(row_number() over (partition by field order by value) - 1 as int) as code from v where value is not null),
    unknown as (select field, code from code where value = 'UNKNOWN')
    select c_custkey, coalesce(n.code, (select code from unknown where field = 'number')) as number_code,
      coalesce(k.code, (select code from unknown where field = 'nation')) as nation_code
    from customer left join code n on n.field = 'number' and n.value = substr(c_name, 10)
      left join code k on k.field = 'nation' and k.value = nullif(cast(c_nationkey as varchar), '7')""",
)
def kept_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An encoder with a template and then its model are saved and loaded; half of the customers are unseen."""
    past = table(spark, sf_dir, "supplier").select(
        F.substr("s_name", F.lit(10)).alias("number"), F.col("s_nationkey").cast("string").alias("nation")
    )
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substr("c_name", F.lit(10)).alias("number"),
        F.nullif(F.col("c_nationkey").cast("string"), F.lit("7")).alias("nation"),
    )
    columns = {"inputCols": ["number", "nation"], "outputCols": ["number_code", "nation_code"]}
    given = SafeEncoder(**columns, template=rows.where(F.col("c_custkey") % 2 == 0), rowId=["c_custkey"], broadcastRows=100)
    paths = fresh_path(spark, "encoder"), fresh_path(spark, "encoder-model")
    given.save(paths[0])
    SafeEncoder.load(paths[0]).fit(past).save(paths[1])
    return SafeEncoderModel.load(paths[1]).transform(rows).select("c_custkey", "number_code", "nation_code")


@query(
    "j2_encode_closed",
    """with e as (select event_id, coalesce(nullif(event_type, 'error'), 'nan') as kind, cast(user_id as varchar) as person
      from events)
    select event_id, cast(dense_rank() over (order by kind) - 1 as int) as kind_code,
      cast(dense_rank() over (order by person) - 1 as int) as person_code from e""",
)
def closed_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("kind"), F.col("user_id").alias("person")
    )
    coded = encode_closed(events, {"kind": "kind_code", "person": "person_code"}, ["event_id"])
    return coded.select("event_id", "kind_code", "person_code")


@query(
    "w4_folds",
    """select doc_id, quality, cast((row_number() over (partition by quality
      order by md5(concat(doc_id, ':42')), doc_id) - 1) % 5 as int) as fold from labels""",
)
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_folds(table(spark, sf_dir, "labels"), ["quality"], ["doc_id"]).select("doc_id", "quality", "fold")


@query(
    "w5_state_folds",
    """select event_id, user_id, event_type, cast((row_number() over (partition by user_id, event_type
      order by md5(concat(event_id, ':42')), event_id) - 1) % 5 as int) as fold from events""",
)
def state_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds within every state (user) and class (event type)."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return balanced_folds(events, ["user_id", "event_type"], ["event_id"], digits=1)


@query("a6_median", "select round(median(l_extendedprice), 6) as median from lineitem")
def median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_median(table(spark, sf_dir, "lineitem"), "l_extendedprice").select(F.round("median", 6).alias("median"))
