"""Results joined with what is known about the candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.numbers import ratio
from hustings.functions.text import name_key
from hustings.operators.skew import spread_join
from hustings.operators.winners import label_winners


def merge_profiles(
    results: DataFrame, profiles: DataFrame, contest: list[str], row_id: list[str], how: str = "left"
) -> DataFrame:
    """Join results to profiles on the contest and the normalised candidate name (``candidate`` on both sides)."""
    left = results.withColumn("candidate_norm", name_key(F.col("candidate")))
    right = profiles.withColumn("candidate_norm", name_key(F.col("candidate"))).drop("candidate")
    return spread_join(left, right, [*contest, "candidate_norm"], row_id, how)


def flag_incumbents(
    results: DataFrame, contest: list[str], person: str, term: str, votes: str, row_id: list[str], step: int = 1
) -> DataFrame:
    """Add ``incumbent``: 1 when the same person won the same contest one term (``step``) earlier."""
    won = (
        label_winners(results, [*contest, term], votes, row_id, "_won")
        .where(F.col("_won") == 1)
        .select(*contest, person, (F.col(term) + step).cast("int").alias(term))
        .distinct()
        .withColumn("_held", F.lit(1))
    )
    joined = spread_join(results, won, [*contest, person, term], row_id)
    return joined.withColumn("incumbent", F.coalesce("_held", F.lit(0))).drop("_held")


def wealth_to_margin(merged: DataFrame, assets: str, margin: str = "margin") -> DataFrame:
    """Add ``wealth_ratio`` = assets / margin, null for a zero margin."""
    return merged.withColumn("wealth_ratio", ratio(F.col(assets), F.col(margin)))
