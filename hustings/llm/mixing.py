"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from random import Random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.tables import WORD, own_columns, stored, text_of, unused
from hustings.operators.ordering import positions
from hustings.operators.skew import spread_join

WEIGHTS = (5, 2, 1)
SHARE, LIMIT, SEED = 1.5, 2.0, 20


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """Add ``target`` to rows ``source_size, weight``: shares by weight of ``share`` times all sizes, none above
    ``limit`` times its own size; what is cut off is shared again by weight among the rest.

    Every round is one aggregate over the sources; only three numbers come to the driver.
    """
    most = limit * F.col("source_size")
    goal, level = None, None
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > most
        total, cut, weight, n_cut = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(above, F.col("source_size")).otherwise(0)),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))),
            F.count_if(above),
        ).first()
        goal = share * (total or 0)
        if level is not None and n_cut == before or not weight:
            break
        before, level = n_cut, (goal - limit * cut) / weight
    level = level or 0.0
    return sources.withColumn("target", F.when(F.col("weight") * level > most, most).otherwise(F.col("weight") * level))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    seed: int = SEED,
    row: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``, and ``row``, if a column that
    tells all rows apart is named so.

    A document's size is its number of words, a null text has none.  Sources in code point order, null last, get the
    weights in turn.  Every document of a source expects ``target / source_size`` copies.  The documents stand in order
    of size (then id), which makes the systematic sample a stratified one; their expectations are summed up, one random
    offset is added, and a document is emitted once per whole number that its part of the sum crosses.  So nothing
    exceeds ``limit`` copies, and the taken words differ from the target by about one large document.

    Repeated rows are documents of their own.  Sources without words have target 0 and give no copy.  No rows give no
    rows.  The offset comes from ``seed`` alone, so reruns agree.
    """
    given = {"doc_id": doc_id, "source": source, "text": text} | ({"row": row} if row else {})
    counted = own_columns(docs, **given).withColumn("size", words(text_of("text"))).drop("text")
    return drawn(stored(counted, "sizes"), weights, share, limit, seed)


def drawn(sized: DataFrame, weights: tuple[int, ...], share: float, limit: float, seed: int) -> DataFrame:
    """``mix`` of written rows ``doc_id, source, size`` and, if there is one, ``row``."""
    identity = ["row"] if "row" in sized.columns else []
    sized = sized.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t")))
    # "s..." stands before "t": null sources come last.
    sources = sized.groupBy("_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    ranked = positions(sources, "_key", _start=F.col("_n")).withColumnRenamed("before", "_rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    weighted = ranked.withColumn("weight", F.get(cycle, F.pmod("_rank", F.lit(len(weights))).cast("int"))).drop("_rank")
    targets = source_targets(stored(weighted, "source-weights"), weights, share, limit)
    placed = positions(sized.withColumn("_place", F.struct("_key", "size", "doc_id", *identity)), "_place").drop("_place")
    joined = spread_join(placed, targets, ["_key"], ["doc_id", "before"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = Random(seed).random()
    turn = F.col("before") - F.col("_start")

    def crossed(place: Column) -> Column:
        return F.floor(place.cast("double") * rate + F.lit(offset)).cast("bigint")

    copies = crossed(turn + 1) - crossed(turn)
    return joined.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *identity
    )


def mixture(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    seed: int = SEED,
) -> DataFrame:
    """The mixture itself: every row of ``docs`` as often as ``mix`` emits it, with ``copy`` counted from 1 (a column of
    that name is replaced).

    The rows are written once with a number and their size each, so every row keeps its own copies, whatever it shares with
    others, and the texts are read for their sizes while they are written.
    """
    number, size, copies = unused(docs, "_number", "_size", "_copies")
    numbered = docs.select(
        "*", F.monotonically_increasing_id().alias(number), words(text_of(F.col(f"`{text}`"))).alias(size)
    )
    rows = stored(numbered, "numbered")
    sized = own_columns(rows, doc_id=doc_id, source=source, row=number, size=size)
    taken = drawn(sized, weights, share, limit, seed).where("copies > 0")
    emitted = rows.drop(size).join(taken.select(F.col("row").alias(number), F.col("copies").cast("int").alias(copies)), number)
    return emitted.drop(number).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop(copies)
