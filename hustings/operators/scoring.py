"""Predictions against official results: accuracies, ranking, tiers and prizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.operators.ordering import positions
from hustings.operators.skew import lookup, spread_join
from hustings.session import materialise

SEAT = ["state", "constituency"]
RANK_KEYS = ["aggregate", "submitted_at", "breadth", "largest_accuracy"]

# Fixed values of the rules: counted status, accuracy limits, prizes by rank.
COUNTED_STATUS = "declared"
BREADTH_LIMIT = 0.75
PRIZE_LIMIT = 0.75
TIER_1, TIER_2 = 0.60, 0.75
PRIZES = {1: 100_000, 2: 10_000, 3: 5_000}


def counted_seats(official: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Seats that count: ``state, constituency, winner`` where the latest status is declared.

    Where reports are dated (``reported_at``) the last one per seat holds; with ``as_of`` the last up to that moment.
    Undated results must have one row per seat.
    """
    latest = official
    if as_of is not None or "reported_at" in official.columns:
        newest = W.partitionBy(*SEAT).orderBy(F.desc("reported_at"), "status", "winner")
        dated = official if as_of is None else official.where(F.col("reported_at") <= as_of)
        latest = (
            dated.withColumn("_age", F.row_number().over(newest))
            .where(F.col("_age") == 1)
        )
    return latest.where(F.col("status") == COUNTED_STATUS).select(*SEAT, "winner")


def without_seats(official: DataFrame, excluded: DataFrame) -> DataFrame:
    """Official results less a list of excluded seats."""
    return official.join(excluded.select(*SEAT).distinct(), SEAT, "left_anti")


def state_accuracy(predictions: DataFrame, seats: DataFrame) -> DataFrame:
    """Per entry and state: ``n_seats`` counted, ``n_predicted``, ``n_correct``, ``accuracy`` = correct / counted.

    A seat counts once per entry: naming its winner again adds nothing, naming different candidates is wrong.  A seat
    the entry left out counts as wrong; a state the entry left out has no row (see :func:`entry_scores`), which spares
    an entry-by-state grid.
    """
    totals = seats.groupBy("state").agg(F.count(F.lit(1)).alias("n_seats"))
    judged = lookup(predictions, seats, SEAT, ["entry_id"], "inner")
    picks = judged.groupBy("entry_id", *SEAT).agg(
        F.bool_and(F.col("candidate").eqNullSafe(F.col("winner")) & F.col("winner").isNotNull()).alias("right")
    )
    per_state = picks.groupBy("entry_id", "state").agg(
        F.count(F.lit(1)).alias("n_predicted"), F.count_if("right").alias("n_correct")
    )
    return (
        lookup(per_state, totals, ["state"], ["entry_id"], "inner")
        .select("entry_id", "state", "n_seats", "n_predicted", "n_correct")
        .withColumn("accuracy", F.col("n_correct") / F.col("n_seats"))
    )


def entry_scores(per_state: DataFrame, seats: DataFrame, missing_as_zero: bool = True) -> DataFrame:
    """Per entry: ``aggregate`` (unweighted mean over states), ``breadth``, ``largest_accuracy``.

    The mean is over all states with counted seats, states left out counting 0, or over the entry's own states.
    It is rounded to 9 places so that equal accuracies tie whatever the order of summation.
    """
    n_states = seats.agg(F.count_distinct("state")).scalar()
    summed = per_state.groupBy("entry_id").agg(
        F.sum("accuracy").alias("_sum"),
        F.count(F.lit(1)).alias("n_states"),
        F.count_if(F.col("accuracy") >= BREADTH_LIMIT).alias("breadth"),
        F.max_by("accuracy", F.struct("n_seats", "state")).alias("largest_accuracy"),
    )
    divisor = n_states if missing_as_zero else F.col("n_states")
    return summed.withColumn("_states", divisor).select(
        "entry_id",
        F.round(F.col("_sum") / F.col("_states"), 9).alias("aggregate"),
        "breadth",
        "n_states",
        F.round("largest_accuracy", 9).alias("largest_accuracy"),
    )


def with_absent(scores: DataFrame, entries: DataFrame) -> DataFrame:
    """A score for every row of ``entries``: those that predicted no counted seat have 0."""
    joined = entries.join(scores, "entry_id", "left")
    return joined.fillna(0, ["aggregate", "breadth", "n_states", "largest_accuracy"])


def leaderboard(scores: DataFrame) -> DataFrame:
    """Add ``rank`` and ``tied`` by aggregate, then earlier ``submitted_at``, breadth, accuracy in the largest state.

    Entries equal on all four share a rank and are flagged, as the remaining steps need human judgement.  Ranks come
    from the counts of the distinct key combinations, so neither a huge field nor a huge tie meets in one task.
    A missing key ranks first in its step, and two missing ones are equal.
    """
    order = F.struct(
        (-F.col("aggregate")).alias("a"),
        F.col("submitted_at").alias("b"),
        (-F.col("breadth")).alias("c"),
        (-F.col("largest_accuracy")).alias("d"),
    )
    # Inside a struct null equals null.
    scores = materialise(scores.withColumn("_order", order))
    combos = scores.groupBy("_order").agg(F.count(F.lit(1)).alias("_n"))
    ranked = positions(combos, "_order", F.col("_n")).select(
        "_order", "_n", (F.col("before") + 1).alias("rank"), (F.col("_n") > 1).cast("int").alias("tied")
    )
    return spread_join(scores, ranked, ["_order"], ["entry_id"], "inner").drop("_order")


def tier(accuracy: Column) -> Column:
    return F.when(accuracy >= TIER_2, F.lit("Tier 2")).when(accuracy >= TIER_1, F.lit("Tier 1")).otherwise(F.lit("none"))


def prizes(board: DataFrame) -> DataFrame:
    """Entries in a prize place with ``prize``; entries sharing a place all stay, flagged by ``tied``."""
    amount = F.lit(0)
    for place, value in PRIZES.items():
        amount = F.when(F.col("rank") == place, F.lit(value)).otherwise(amount)
    return board.where((F.col("aggregate") >= PRIZE_LIMIT) & (F.col("rank") <= max(PRIZES))).withColumn("prize", amount)


def without_entries(entries: DataFrame, listed: DataFrame) -> DataFrame:
    """Entries not on a list: disqualified ones before ranking, publication opt-outs after it."""
    return entries.join(listed.select("entry_id").distinct(), "entry_id", "left_anti")


def certificates(board: DataFrame, members: DataFrame) -> DataFrame:
    """One row per team member: own name, team name, the team's accuracy and tier."""
    scored = board.select("entry_id", "aggregate")
    return spread_join(members, scored, ["entry_id"], ["person_id"], "inner").select(
        "entry_id", "team_name", "person_id", "full_name", "aggregate", tier(F.col("aggregate")).alias("tier")
    )
