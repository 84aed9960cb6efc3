"""Registrations, submissions and official results to a published leaderboard."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.operators import copies, rules, scoring
from hustings.operators.skew import spread_join
from hustings.session import materialise
from hustings.sources.sinks import check_target


@dataclass
class Contest:
    """The contest's tables."""

    registrations: DataFrame  # entry_id, person_id, age, is_staff, is_contesting, media_opt_out
    members: DataFrame  # entry_id, person_id, full_name, team_name, changed_at, notified
    submissions: DataFrame  # submission_id, entry_id, submitted_at, has_predictions, note_text
    predictions: DataFrame  # submission_id, state, constituency, candidate
    official: DataFrame  # state, constituency, winner, status
    disqualified: DataFrame  # entry_id


def admitted_entries(contest: Contest) -> DataFrame:
    """Entries whose registrations, team and record are in order."""
    memberships = contest.registrations.select("entry_id", "person_id").unionByName(
        contest.members.select("entry_id", "person_id")
    )
    everyone = contest.registrations.select("entry_id").distinct()
    unfit = rules.ineligible(contest.registrations)
    twice = rules.repeated_registrations(contest.registrations).select("person_id")
    repeated = spread_join(contest.registrations, twice, ["person_id"], ["entry_id"], "left_semi")
    entries = everyone.join(rules.valid_entries(memberships).select("entry_id"), "entry_id", "left_semi")
    for listed in (unfit, repeated, rules.late_changes(contest.members), contest.disqualified):
        entries = scoring.without_entries(entries, listed)
    return entries


def final_predictions(contest: Contest, **period: object) -> tuple[DataFrame, DataFrame]:
    """Per admitted entry the submission that counts (``submission_id, entry_id, submitted_at``), and its predictions."""
    valid = rules.complete_submission(F.col("has_predictions"), F.col("note_text"))
    final = rules.last_valid_submissions(contest.submissions, valid, **period).select(
        "submission_id", "entry_id", "submitted_at"
    )
    final = materialise(final.join(admitted_entries(contest), "entry_id", "left_semi"))
    return final, spread_join(contest.predictions, final, ["submission_id"], scoring.SEAT, "inner")


def suspected_copies(contest: Contest, percent: int = 90, **period: object) -> DataFrame:
    """Submissions for review: ``entry_id, source_entry`` (the earlier), ``agreement`` over the larger of both and ``n_equal``.

    An entry that says the same as an earlier one is listed with the earliest of them and agreement 1; ``n_equal`` tells how
    many say so.  Different ones are listed with every earlier entry, standing for all that say the same, whose predictions they
    share by ``percent`` or more.  Whether a listed entry is disqualified is for the organisers to say.
    """
    _, predictions = final_predictions(contest, **period)
    predictions = materialise(predictions.select("entry_id", "submitted_at", *scoring.SEAT, "candidate"))
    equal = copies.equal_submissions(predictions).where(F.col("entry_id") != F.col("copy_of"))
    near = copies.near_copies(predictions, percent)
    return equal.select("entry_id", F.col("copy_of").alias("source_entry"), F.lit(1.0).alias("agreement"), "n_equal").unionByName(
        near.select("entry_id", "source_entry", "agreement", F.lit(None).cast("bigint").alias("n_equal"))
    )


def ranking(contest: Contest, as_of: Column | None = None, **period: object) -> DataFrame:
    """Ranked entries with accuracy, breadth, tier, prize and tie flag."""
    final, predictions = final_predictions(contest, **period)
    seats = scoring.counted_seats(contest.official, as_of)
    scores = scoring.entry_scores(scoring.state_accuracy(predictions, seats), seats)
    board = scoring.leaderboard(scoring.with_absent(scores, final.select("entry_id", "submitted_at")))
    prized = scoring.prizes(board).select("entry_id", "prize")
    return board.join(prized, "entry_id", "left").withColumn("tier", scoring.tier(F.col("aggregate")))


def published(contest: Contest, board: DataFrame) -> DataFrame:
    """The ranking less the entries that do not wish to appear; ranks stay as they are."""
    return scoring.without_entries(board, contest.registrations.where("media_opt_out"))


def read_contest(spark: SparkSession, folder: str) -> Contest:
    """The contest's tables from a folder with one Parquet table per field."""
    return Contest(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(Contest)})


def run(
    spark: SparkSession, folder: str, out: str, as_of: Column | None = None, overwrite: bool = False, **period: object
) -> DataFrame:
    """Tables to the published leaderboard in ``out``, which is checked first."""
    mode = check_target(spark, out, overwrite)
    contest = read_contest(spark, folder)
    board = materialise(published(contest, ranking(contest, as_of, **period)))
    board.write.mode(mode).parquet(out)
    return board.orderBy("rank", "entry_id")
