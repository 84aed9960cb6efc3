"""Joins that hold when a single key owns a large share of the rows.

A key is *hot* when it has more rows than one task should take.  The hot list is the top of the per-key counts and
is limited to ``HOT_KEYS`` rows, so it is always safe to broadcast.  A key that misses the list because it is full
holds at most ``1 / HOT_KEYS`` of all rows and is joined in the ordinary way, so no row is ever left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 100_000
ROWS_PER_TASK = 2_000_000
BROADCAST_ROWS = 200_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; counted in parallel, without reading columns where the source allows."""
    return df.count() <= rows


def all_known(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(all_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def hot_keys(counts: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of parts each is cut into.

    All columns take part in the order, so that counts taken along with other sums stay one aggregate of the input.
    """
    rest = [c for c in counts.columns if c != "_n"]
    return (
        counts.where(F.col("_n") > rows_per_task)
        .orderBy(F.desc("_n"), *rest)
        .limit(HOT_KEYS)
        .select(*keys, parts(rows_per_task).alias("_parts"))
    )


def parts(rows_per_task: int) -> Column:
    return F.greatest(F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("bigint"), F.lit(1).cast("bigint"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    row_id: list[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    at_most: int | None = None,
) -> DataFrame:
    """Equi-join ``left`` to a smaller ``right``, cutting hot keys of ``left`` into parts.

    ``row_id`` names columns that tell the rows of a key apart; the part is their hash, so a recomputed task puts
    every row where it was before.  Rows of ``right`` are repeated once per part, only for hot keys.  Rows of
    ``left`` with a null key match nothing and are spread by the same hash.  A column ``_n`` in ``right``, the number
    of ``left`` rows of the key, saves the pass that counts them; it is not part of the result.
    ``at_most``, a number of rows that ``left`` is known not to exceed, saves the list of hot keys where none can be hot.
    """
    counted = "_n" in right.columns
    part = F.xxhash64(*row_id)
    whole = F.lit(0).cast("bigint")
    if at_most is not None and at_most <= rows_per_task:
        parted_left = left.withColumn("_part", F.when(~all_known(on), part).otherwise(whole))
        parted_right = right.drop("_n").withColumn("_part", F.explode(F.array(whole)))
        return parted_left.join(parted_right, [*on, "_part"], how).drop("_part")
    counts = right if counted else key_counts(left, on)
    hot = F.broadcast(hot_keys(counts, on, rows_per_task))
    parted_left = (
        left.join(hot, on, "left")
        .withColumn(
            "_part",
            F.when(~all_known(on), part)
            .when(F.col("_parts").isNotNull(), F.pmod(part, F.col("_parts")))
            .otherwise(whole),
        )
        .drop("_parts")
    )
    if counted:
        sized = right.withColumn("_parts", parts(rows_per_task)).drop("_n")
    else:
        sized = right.join(hot, on, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint")))
    every_part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    parted_right = sized.withColumn("_part", every_part).drop("_parts")
    return parted_left.join(parted_right, [*on, "_part"], how).drop("_part")


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    row_id: list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join to a table that is usually small: broadcast when a count proves it, otherwise spread the keys.

    The count runs at once, so ``right`` should be a table or something cheap.
    """
    if fits_broadcast(right, broadcast_rows):
        return left.join(F.broadcast(right.drop("_n")), on, how)
    return spread_join(left, right, on, row_id, how)
