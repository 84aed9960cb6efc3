"""Results joined with profiles and past terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.operators.profiles import flag_incumbents, merge_profiles


@query(
    "j5_profile_merge",
    """select o_orderkey, o_custkey as constituency_no, c_mktsegment, c_acctbal
    from orders left join customer on c_custkey = o_custkey and c_mktsegment <> 'MACHINERY'""",
)
def profile_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two sources spell names differently; candidates of one segment have no profile."""
    results = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("constituency_no"),
        F.concat(F.lit(" CUSTOMER  "), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(".")).alias("candidate"),
    )
    profiles = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "MACHINERY").select(
        F.col("c_custkey").alias("constituency_no"), F.col("c_name").alias("candidate"), "c_mktsegment", "c_acctbal"
    )
    merged = merge_profiles(results, profiles, ["constituency_no"], ["o_orderkey"])
    return merged.select("o_orderkey", "constituency_no", "c_mktsegment", "c_acctbal")


@query(
    "j6_incumbent",
    """with r as (select o_orderkey, o_custkey, o_orderpriority, cast(year(o_orderdate) as int) as term, o_totalprice
      from orders),
    w as (select distinct o_custkey, o_orderpriority, term + 1 as term from (
      select *, max(o_totalprice) over (partition by o_custkey, term) as top from r) where o_totalprice = top)
    select r.o_orderkey, r.term, cast(w.term is not null as int) as incumbent
    from r left join w on w.o_custkey = r.o_custkey and w.o_orderpriority = r.o_orderpriority and w.term = r.term""",
)
def incumbents(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("term"), "o_totalprice"
    )
    flagged = flag_incumbents(results, ["o_custkey"], "o_orderpriority", "term", "o_totalprice", ["o_orderkey"])
    return flagged.select("o_orderkey", "term", "incumbent")
