"""Feature building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.functions.text import major_party
from hustings.operators.features import proxy_label, risk_band, risk_flag


@query(
    "f12_proxy_label",
    """with c as (select c_custkey, c_acctbal,
        cast(contains(c_mktsegment, 'BUILD') or contains(c_mktsegment, 'AUTO') as int) as is_major_party,
        cast(('0x' || substr(md5(concat(c_custkey, ':2026')), 1, 8)) as bigint) / 4294967296.0::double as noise
      from customer)
    select c_custkey, is_major_party, cast(is_major_party * 0.5::double
      + cast(c_acctbal > (select median(c_acctbal) from customer) as int) * 0.3::double
      + noise * 0.2::double > 0.65::double as int) as proxy from c""",
)
def proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_acctbal",
        major_party(F.col("c_mktsegment"), ["BUILD", "AUTO"], any_case=False).alias("is_major_party"),
    )
    return proxy_label(customers, F.col("c_custkey"), "c_acctbal").select("c_custkey", "is_major_party", "proxy")


@query(
    "f14_risk",
    """with e as (select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as cases from events)
    select event_id, cases, cast(cases > 0 as int) as has_cases,
      case when cases >= 60 then 'high' when cases >= 30 then 'medium' when cases >= 1 then 'low' else 'none' end as risk
    from e""",
)
def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    events = table(spark, sf_dir, "events").select("event_id", cases.alias("cases"))
    bands = [(1, "low"), (30, "medium"), (60, "high")]
    return events.withColumns({"has_cases": risk_flag(F.col("cases")), "risk": risk_band(F.col("cases"), bands)})
