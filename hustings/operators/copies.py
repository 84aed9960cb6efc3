"""Submissions taken over from others: equal ones by their prints, changed ones by a set-similarity join.

A submission is the set of its predictions (state, constituency, candidate).  Two submissions are near copies when they share
at least ``percent`` of the larger one's predictions.  The join uses what follows from that:

* The sizes of both lie within ``percent``, so only neighbouring bands of sizes meet.
* With all predictions in one order, the rarest first, the first prediction that both share stands among the first
  ``size - need + 1`` of each (the prefix), and the second among the first ``size - need + 2``.  A prediction that many
  prefixes hold is therefore only looked up together with a second one.
* What is left after the first shared prediction must be long enough to reach the share.

Lists of one key are cut into blocks and met block against block.  The pairs that remain are counted exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.operators.ordering import positions
from hustings.operators.skew import spread_join
from hustings.session import materialise

SEAT = ["state", "constituency"]


def said_once(predictions: DataFrame) -> DataFrame:
    """Distinct predictions per entry as ``entry_id, submitted_at, token``; rows without a seat or a candidate say nothing."""
    token = F.xxhash64(*SEAT, "candidate").alias("token")
    known = predictions.dropna(subset=["entry_id", *SEAT, "candidate"])
    return known.groupBy("entry_id", token).agg(F.min("submitted_at").alias("submitted_at"))


def classes(said: DataFrame) -> DataFrame:
    """Per entry ``size``, ``submitted_at``, the earliest entry with equal predictions (``copy_of``) and how many have them."""
    prints = said.groupBy("entry_id").agg(
        F.min("submitted_at").alias("submitted_at"),
        F.count(F.lit(1)).alias("size"),
        F.bit_xor("token").alias("_print1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "token")).alias("_print2"),
    )
    same = ["size", "_print1", "_print2"]
    groups = prints.groupBy(*same).agg(
        F.min(F.struct("submitted_at", "entry_id"))["entry_id"].alias("copy_of"),
        F.count(F.lit(1)).alias("n_equal"),
        F.count(F.lit(1)).alias("_n"),
    )
    return spread_join(prints, groups, same, ["entry_id"], "inner").drop("_print1", "_print2")


def equal_submissions(predictions: DataFrame) -> DataFrame:
    """One row per entry: ``entry_id, size, copy_of`` (the earliest entry that says the same) and ``n_equal``.

    The earliest is the first by ``submitted_at``, then by ``entry_id``.  Entries that predict nothing are left out.
    """
    return classes(said_once(predictions)).select("entry_id", "size", "copy_of", "n_equal")


def need(size, percent: int):
    """The least number of shared predictions for a larger set of this size, in whole numbers."""
    return F.floor((size * percent + 99) / 100).cast("bigint")


def prefixes(said: DataFrame, entries: DataFrame, percent: int) -> DataFrame:
    """The rarest predictions of every entry: ``entry_id, submitted_at, size, token, place`` (from 0), up to the longer prefix."""
    own = spread_join(said.drop("submitted_at"), entries, ["entry_id"], ["token"], "inner")
    holders = own.groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.count(F.lit(1)).alias("_n"))
    counted = spread_join(own, holders, ["token"], ["entry_id"], "inner")
    placed = positions(counted.select(F.struct("entry_id", "holders", "token").alias("key"), "submitted_at", "size"), "key")
    placed = placed.select("key.entry_id", "key.token", "submitted_at", "size", "before")
    starts = placed.groupBy("entry_id").agg(F.min("before").alias("_start"), F.count(F.lit(1)).alias("_n"))
    ranked = spread_join(placed, starts, ["entry_id"], ["token"], "inner")
    return materialise(
        ranked.withColumn("place", F.col("before") - F.col("_start"))
        .drop("before", "_start")
        .where(F.col("place") < F.col("size") - need(F.col("size"), percent) + 2)
    )


def met(rows: DataFrame, key: list[str], percent: int, block: int) -> DataFrame:
    """Pairs of rows with one key whose sizes and places allow the share, the earlier submission as ``source_entry``."""
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sized = spread_join(rows, counts.withColumn("_blocks", F.ceil(F.col("_n") / block)), key, ["entry_id"], "inner")
    own = sized.withColumn("_own", F.pmod(F.xxhash64("entry_id"), F.col("_blocks")))
    left = own.withColumn("_j", F.explode(F.sequence("_own", F.col("_blocks") - 1))).withColumnRenamed("_own", "_i")
    right = own.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_own")))).withColumnRenamed("_own", "_j")
    facts = ["entry_id", "submitted_at", "size", "place", "band"]
    a = left.select(*key, "_i", "_j", *[F.col(c).alias(f"a_{c}") for c in facts])
    b = right.select(*key, "_i", "_j", *[F.col(c).alias(f"b_{c}") for c in facts])
    larger = need(F.greatest("a_size", "b_size"), percent)
    rest = F.least(F.col("a_size") - F.col("a_place"), F.col("b_size") - F.col("b_place"))
    fits = (F.least("a_size", "b_size") >= larger) & (rest >= larger)
    once = ((F.col("_i") < F.col("_j")) | (F.col("a_entry_id") < F.col("b_entry_id"))) & (F.col("meets") == F.greatest("a_band", "b_band"))
    pairs = a.join(b, [*key, "_i", "_j"]).where(once & fits & (F.col("a_entry_id") != F.col("b_entry_id")))
    earlier = F.struct("a_submitted_at", "a_entry_id") < F.struct("b_submitted_at", "b_entry_id")
    return pairs.select(
        F.when(earlier, F.col("b_entry_id")).otherwise(F.col("a_entry_id")).alias("entry_id"),
        F.when(earlier, F.col("a_entry_id")).otherwise(F.col("b_entry_id")).alias("source_entry"),
    )


def candidate_pairs(said: DataFrame, entries: DataFrame, percent: int, dense: int, block: int) -> DataFrame:
    """Pairs of entries that may share ``percent``; every pair that does is among them."""
    # A little wider than the share, so that rounding never puts a fitting pair two bands apart.
    width = math.log(100 / percent) + 0.001
    longer = prefixes(said, entries, percent).withColumn("band", F.floor(F.log(F.col("size").cast("double")) / width))
    short = longer.where(F.col("place") < F.col("size") - need(F.col("size"), percent) + 1)
    meeting = short.withColumn("meets", F.explode(F.array("band", F.col("band") + 1)))
    crowded = materialise(
        meeting.groupBy("token", "meets").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense)
    )
    tagged = spread_join(meeting, crowded.withColumn("crowded", F.lit(True)), ["token", "meets"], ["entry_id"])
    # Sets that need a single shared prediction have no second one.
    alone = F.col("crowded").isNull() | (need(F.col("size"), percent) < 2)
    single = tagged.where(alone).drop("crowded")
    second = longer.select(F.col("entry_id").alias("_entry"), F.col("token").alias("second"), F.col("place").alias("_place"))
    later = (F.col("entry_id") == F.col("_entry")) & (F.col("place") < F.col("_place"))
    double = tagged.where("crowded").join(second, later).drop("crowded", "_entry", "_place")
    found = met(single, ["token", "meets"], percent, block).unionByName(met(double, ["token", "second", "meets"], percent, block))
    return found.distinct()


def near_copies(predictions: DataFrame, percent: int = 80, dense: int = 1000, block: int = 2000) -> DataFrame:
    """Pairs of entries that share at least ``percent`` of the larger one's predictions but do not say the same.

    ``predictions`` is ``entry_id, submitted_at, state, constituency, candidate``.  Gives ``entry_id, source_entry`` (the
    earlier), ``size, source_size, n_shared`` and ``agreement``, shared predictions over the larger size.  Entries that say the
    same are represented by the earliest of them; :func:`equal_submissions` tells who they are.  An entry may have several
    sources.  A prediction said twice counts once.  ``dense`` is the number of entries in one list from which a second shared
    prediction is asked for, ``block`` the number that a task compares at a time; neither changes the result.
    """
    said = materialise(said_once(predictions))
    entries = materialise(classes(said)).where(F.col("entry_id") == F.col("copy_of")).select("entry_id", "submitted_at", "size")
    pairs = materialise(candidate_pairs(said, entries, percent, dense, block))
    sizes = entries.select("entry_id", "size")
    own = spread_join(said.select("entry_id", "token"), pairs, ["entry_id"], ["token"], "inner")
    theirs = said.select(F.col("entry_id").alias("source_entry"), "token")
    shared = (
        spread_join(own, theirs, ["source_entry", "token"], ["entry_id"], "inner")
        .groupBy("entry_id", "source_entry")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    known = spread_join(shared, sizes, ["entry_id"], ["source_entry"], "inner")
    source = sizes.select(F.col("entry_id").alias("source_entry"), F.col("size").alias("source_size"))
    both = spread_join(known, source, ["source_entry"], ["entry_id"], "inner")
    larger = F.greatest("size", "source_size")
    return both.where(F.col("n_shared") >= need(larger, percent)).select(
        "entry_id", "source_entry", "size", "source_size", "n_shared", (F.col("n_shared") / larger).alias("agreement")
    )
