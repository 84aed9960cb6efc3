"""Global order without a global sort in one task: positions, exact medians and balanced fold numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.operators.skew import spread_join
from hustings.session import materialise


def positions(
    keyed: DataFrame, key: str, weight: Column | None = None, ranges: int | None = None, **others: Column
) -> DataFrame:
    """Add ``before``: the total weight (default: the number) of rows whose ``key`` is smaller; and under its own name the same
    for every one of ``others``.

    ``key`` is unique and not null; a struct gives a multi-column order.  The rows are cut into ranges of the key,
    by default one per shuffle partition, and written once: another pass could cut them elsewhere.  A row's position
    is the weight of the lower ranges plus its place within its own range.
    """
    weights = {"before": F.lit(1).cast("bigint") if weight is None else weight} | others
    ranges = ranges or int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        keyed.withColumns({f"_weight_{name}": w for name, w in weights.items()})
        .repartitionByRange(ranges, key)
        .withColumn("_range", F.spark_partition_id())
    )
    # One row per range, whatever the size of the data.
    totals = ranged.groupBy("_range").agg(*[F.sum(f"_weight_{name}").alias(f"_total_{name}") for name in weights])
    lower = W.orderBy("_range")
    starts = totals.select(
        "_range", *[(F.sum(f"_total_{name}").over(lower) - F.col(f"_total_{name}")).alias(f"_start_{name}") for name in weights]
    )
    inside = W.partitionBy("_range").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    placed = ranged.withColumns({f"_inside_{name}": F.sum(f"_weight_{name}").over(inside) - F.col(f"_weight_{name}") for name in weights})
    working = [f"_{part}_{name}" for part in ("weight", "inside", "start") for name in weights]
    return (
        placed.join(F.broadcast(starts), "_range")
        .withColumns({name: F.col(f"_start_{name}") + F.col(f"_inside_{name}") for name in weights})
        .drop("_range", *working)
    )


def running_totals(df: DataFrame, group: list[str], order: list[Column], sums: list[str]) -> DataFrame:
    """Add ``before_x`` and ``all_x`` for every ``x`` in ``sums``: the total of ``x``, a whole number, over the rows of the same
    group that come earlier in ``order``, and over the whole group.

    The order is strict within a group; nulls make a group like any value.  Rows are cut into ranges of group and order, so
    a group of any size is summed by many tasks: the totals of lower ranges plus those within the own range, less what lies
    before the group.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*group, *[o.alias(f"_o{i}") for i, o in enumerate(order)])
    ranged = materialise(df.withColumn("_key", key).repartitionByRange(ranges, "_key").withColumn("_range", F.spark_partition_id()))
    # One row per range.
    totals = ranged.groupBy("_range").agg(*[F.sum(x).alias(f"_total_{x}") for x in sums])
    lower = W.orderBy("_range")
    starts = totals.select("_range", *[(F.sum(f"_total_{x}").over(lower) - F.col(f"_total_{x}")).alias(f"_start_{x}") for x in sums])
    inside = W.partitionBy("_range").orderBy("_key").rowsBetween(W.unboundedPreceding, 0)
    placed = ranged.join(F.broadcast(starts), "_range").withColumns(
        {f"_before_{x}": F.col(f"_start_{x}") + F.sum(x).over(inside) - F.col(x) for x in sums}
    )
    keyed = placed.withColumn("_group", F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit(""))
    facts = keyed.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min(f"_before_{x}").alias(f"_first_{x}") for x in sums],
        *[F.sum(x).alias(f"all_{x}") for x in sums],
    )
    joined = spread_join(keyed, facts, ["_group"], ["_key"], "inner")
    return joined.select(
        *df.columns, *[(F.col(f"_before_{x}") - F.col(f"_first_{x}")).alias(f"before_{x}") for x in sums], *[f"all_{x}" for x in sums]
    )


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the exact median of the known values of ``column``, as ``median``.

    A quantile sketch brackets the middle; its rank error (1 in 10,000) is a tenth of the bracket's half width, so
    the median lies inside.  Only the values within the bracket are grouped and ordered.
    """
    x = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    sketch = x.agg(F.percentile_approx("x", [0.499, 0.501], 10_000).alias("q")).scalar()
    tagged = x.withColumn("q", sketch)
    size = (
        tagged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.col("q")[0]).alias("below"))
        .select(F.struct("n", "below").alias("size"))
        .scalar()
    )
    middle = (
        tagged.where((F.col("x") >= F.col("q")[0]) & (F.col("x") <= F.col("q")[1]))
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ranked = positions(middle, "x", F.col("copies")).withColumn("size", size)
    first = F.col("size.below") + F.col("before")
    lower = F.floor((F.col("size.n") - 1) / 2)
    upper = F.floor(F.col("size.n") / 2)
    held = (
        F.when((first <= lower) & (lower < first + F.col("copies")), 1).otherwise(0)
        + F.when((first <= upper) & (upper < first + F.col("copies")), 1).otherwise(0)
    )
    return (
        ranked.withColumn("held", held)
        .where(F.col("held") > 0)
        .agg((F.sum(F.col("x") * F.col("held")) / F.sum("held")).alias("median"))
    )


def balanced_folds(
    df: DataFrame, strata: list[str], row_id: list[str], folds: int = 5, seed: int = 42, digits: int = 4
) -> DataFrame:
    """Add ``fold`` (0 … folds-1): a seeded shuffle within each stratum, fold sizes differing by at most one.

    Rows are ordered by the MD5 of their identity and the seed and dealt out in turn.  The leading ``digits`` hex
    digits cut every stratum into equal ranges, so a stratum of any size is numbered in parallel; many small strata need
    fewer digits.
    """
    identity = F.concat(F.concat_ws("|", *row_id), F.lit(f":{seed}"))
    hashed = df.withColumn("_hash", F.md5(identity)).withColumn("_range", F.substring("_hash", 1, digits))
    strata_columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_s{i}") for i, c in enumerate(strata)]
    names = [f"_s{i}" for i in range(len(strata))]
    hashed = hashed.select("*", *strata_columns)
    # At most 16^digits rows per stratum.
    sizes = hashed.groupBy(*names, "_range").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.withColumn("_start", F.sum("_size").over(W.partitionBy(*names).orderBy("_range")) - F.col("_size"))
    turn = F.row_number().over(W.partitionBy(*names, "_range").orderBy("_hash", *row_id)) - 1
    return (
        hashed.withColumn("_turn", turn)
        .join(starts.drop("_size"), [*names, "_range"])
        .withColumn("fold", F.pmod(F.col("_start") + F.col("_turn"), F.lit(folds)).cast("int"))
        .drop("_hash", "_range", "_turn", "_start", *names)
    )
