"""Who won: winner labels, a single predicted winner per contest, margins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.functions.numbers import ratio
from hustings.operators.skew import ROWS_PER_TASK, all_known, spread_join


def known_score(score: str) -> Column:
    return F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))


def label_winners(
    df: DataFrame,
    contest: list[str],
    votes: str,
    row_id: list[str],
    label: str = "win",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``label``: 1 for the rows with their contest's top vote (all of them on a tie), 0 else, null without a key.

    A missing or NaN vote is never the top.  The top is aggregated before the shuffle and joined back, so a contest of
    any size is compared in parallel.
    """
    vote = F.when(known_score(votes), F.col(votes))
    tops = df.where(all_known(contest)).groupBy(*contest).agg(F.max(vote).alias("_top"), F.count(F.lit(1)).alias("_n"))
    joined = spread_join(df, tops, contest, row_id, "left", rows_per_task)
    is_top = F.coalesce(vote == F.col("_top"), F.lit(False)).cast("int")
    return joined.withColumn(label, F.when(all_known(contest), is_top)).drop("_top")


def best_rows(df: DataFrame, contest: list[str], score: str, row_id: list[str], keep: int = 1) -> DataFrame:
    """The ``keep`` best rows per contest with their ``place``; ties go to the smaller ``row_id``.

    The filter on ``place`` makes Spark cut every contest down within each input task before the shuffle.
    """
    order = W.partitionBy(*contest).orderBy(F.desc(score), *row_id)
    return (
        df.where(all_known(contest) & known_score(score))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= keep)
    )


def pick_winners(
    df: DataFrame,
    contest: list[str],
    score: str,
    row_id: list[str],
    outcome: str = "outcome",
    win: str = "W",
    lose: str = "L",
) -> DataFrame:
    """Add ``outcome``: ``win`` for exactly one row per contest, the best score, first row on a tie.

    Rows without a score never win; a contest whose rows all lack a score, or without a key, has no winner.
    """
    identity = [*contest, *[c for c in row_id if c not in contest]]
    winners = best_rows(df.select(*identity, score), contest, score, row_id).select(
        *identity, F.lit(True).alias("_won")
    )
    marked = df.join(winners, identity, "left")
    return marked.withColumn(outcome, F.when(F.col("_won"), F.lit(win)).otherwise(F.lit(lose))).drop("_won")


def margins(df: DataFrame, contest: list[str], votes: str, row_id: list[str], candidate: str | None = None) -> DataFrame:
    """Per contest: winner's and runner-up's votes and the margin; a sole candidate's margin is the full vote."""
    top_two = best_rows(df, contest, votes, row_id, keep=2)
    at = lambda place, c: F.max(F.when(F.col("place") == place, F.col(c)))
    named = [at(1, candidate).alias(candidate)] if candidate else []
    return (
        top_two.groupBy(*contest)
        .agg(at(1, votes).alias("winner_votes"), at(2, votes).alias("runner_up_votes"), *named)
        .withColumn("margin", F.col("winner_votes") - F.coalesce("runner_up_votes", F.lit(0)))
    )


def turnout(df: DataFrame, contest: list[str], votes: str, electors: str) -> DataFrame:
    """Per contest: votes cast and their share of the electors, null where the electors are not known or 0."""
    cast = df.where(all_known(contest)).groupBy(*contest).agg(
        F.sum(votes).alias("votes_cast"), F.max(electors).alias("electors")
    )
    return cast.withColumn("turnout", ratio(F.col("votes_cast"), F.col("electors")))
