"""Winner labels, single winners, margins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.operators.profiles import wealth_to_margin
from hustings.operators.skew import spread_join
from hustings.operators.winners import label_winners, margins, pick_winners, turnout

LINE = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


@query(
    "w1_winner_flag",
    """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
      cast(l_quantity = max(l_quantity) over (partition by l_orderkey) as int) as win from lineitem""",
)
def winner_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    return label_winners(lines, ["l_orderkey"], "l_quantity", ["l_partkey", "l_suppkey", "l_linenumber"])


@query(
    "w1_winners_by_status",
    """with w as (select l_returnflag, l_linestatus, cast(l_quantity = max(l_quantity) over (
        partition by l_returnflag, l_suppkey) as int) as win from lineitem)
    select l_returnflag, l_linestatus, cast(sum(win) as bigint) as n_wins, count(*) as n_rows from w group by 1, 2""",
)
def winners_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few, large contests."""
    lines = table(spark, sf_dir, "lineitem")
    won = label_winners(lines, ["l_returnflag", "l_suppkey"], "l_quantity", ["l_orderkey", *LINE])
    return won.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("win").alias("n_wins"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "w2_one_winner",
    """select l_returnflag, l_orderkey, l_partkey, l_suppkey, l_linenumber,
      case when nullif(l_discount, 0) is not null and row_number() over (partition by l_returnflag, l_orderkey
        order by nullif(l_discount, 0) desc nulls last, l_partkey, l_suppkey, l_linenumber, l_shipdate,
        l_extendedprice) = 1 then 'W' else 'L' end as outcome from lineitem""",
)
def one_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero discount is taken as a missing score."""
    lines = table(spark, sf_dir, "lineitem").withColumn("p", F.nullif(F.col("l_discount"), F.lit(0.0)))
    picked = pick_winners(lines, ["l_returnflag", "l_orderkey"], "p", LINE)
    return picked.select("l_returnflag", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "outcome")


_MARGINS = """with r as (
      select l_orderkey, l_quantity, row_number() over (partition by l_orderkey order by l_quantity desc) as rn
      from lineitem),
    m as (select l_orderkey, max(case when rn = 1 then l_quantity end) as winner_votes,
      max(case when rn = 2 then l_quantity end) as runner_up_votes from r group by 1)"""


@query(
    "w7_margin",
    f"{_MARGINS} select *, winner_votes - coalesce(runner_up_votes, 0) as margin from m",
)
def margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return margins(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", LINE)


@query(
    "a11_ratio",
    f"""{_MARGINS} select l_orderkey, c_custkey, winner_votes - coalesce(runner_up_votes, 0) as margin,
      c_acctbal / nullif(winner_votes - coalesce(runner_up_votes, 0), 0) as wealth_ratio
    from m join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey""",
)
def wealth_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    contests = margins(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_quantity", LINE)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")
    )
    profiles = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    merged = spread_join(contests.join(orders, "l_orderkey"), profiles, ["c_custkey"], ["l_orderkey"], "inner")
    rated = wealth_to_margin(merged, "c_acctbal")
    return rated.select("l_orderkey", "c_custkey", "margin", "wealth_ratio")


@query(
    "a10_turnout",
    """select l_returnflag, l_suppkey, sum(l_quantity) as votes_cast, max(l_partkey) as electors,
      sum(l_quantity) / nullif(max(l_partkey), 0) as turnout from lineitem group by 1, 2""",
)
def turnout_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities are whole numbers, so their sums are exact in any order."""
    return turnout(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_suppkey"], "l_quantity", "l_partkey")
