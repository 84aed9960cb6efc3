"""Validity of registrations, teams and submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.functions.text import word_count
from hustings.operators.skew import spread_join

ZONE = "Asia/Kolkata"

# Fixed values of the rules, local time of the contest.
OPENS = "2026-03-24 00:00:00"
CLOSES = "2026-04-30 23:59:59.999999"
TEAM_LOCK = "2026-04-10 23:59:59.999999"
MAX_SUBMISSIONS = 5
MAX_TEAM = 5
MIN_AGE = 18
MIN_NOTE_WORDS = 150


def local_time(df: DataFrame, column: str) -> Column:
    """Wall-clock time of the contest; a time without zone is taken as UTC, whatever the session's zone."""
    if df.schema[column].dataType.typeName() == "timestamp_ntz":
        return F.convert_timezone(F.lit("UTC"), F.lit(ZONE), F.col(column))
    return F.convert_timezone(None, F.lit(ZONE), F.col(column).cast("timestamp_ntz"))


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def may_take_part() -> Column:
    """An adult who is neither staff nor contesting an election."""
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    return F.coalesce(F.col("age") >= MIN_AGE, F.lit(False)) & no("is_staff") & no("is_contesting")


def eligible(registrations: DataFrame) -> DataFrame:
    return registrations.where(may_take_part())


def ineligible(registrations: DataFrame) -> DataFrame:
    return registrations.where(~may_take_part())


def repeated_registrations(registrations: DataFrame) -> DataFrame:
    """People with more than one registration: ``person_id, n_registrations``."""
    counts = registrations.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_registrations"))
    return counts.where(F.col("n_registrations") > 1)


def roster_conflicts(memberships: DataFrame) -> DataFrame:
    """People in more than one entry, team or individual: ``person_id, n_entries``."""
    pairs = memberships.select("person_id", "entry_id").distinct()
    counts = pairs.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_entries"))
    return counts.where(F.col("n_entries") > 1)


def conflicted_entries(memberships: DataFrame) -> DataFrame:
    """Entries with a member who is also in another entry; all of them are out."""
    shared = roster_conflicts(memberships).withColumnRenamed("n_entries", "_n")
    pairs = memberships.select("person_id", "entry_id").distinct()
    return spread_join(pairs, shared, ["person_id"], ["entry_id"], "inner").select("entry_id").distinct()


def valid_entries(memberships: DataFrame) -> DataFrame:
    """Entries of one to five people, none of whom is in another entry: ``entry_id, n_members``."""
    pairs = memberships.select("person_id", "entry_id").distinct()
    sizes = pairs.groupBy("entry_id").agg(F.count("person_id").alias("n_members"))
    fitting = sizes.where(F.col("n_members").between(1, MAX_TEAM))
    return fitting.join(conflicted_entries(memberships), "entry_id", "left_anti")


def late_changes(members: DataFrame, lock: str = TEAM_LOCK) -> DataFrame:
    """Entries whose team changed after the lock without notice."""
    late = local_time(members, "changed_at") > moment(lock)
    return members.where(late & ~F.coalesce("notified", F.lit(False))).select("entry_id").distinct()


def complete_submission(has_predictions: Column, note: Column, words: int = MIN_NOTE_WORDS) -> Column:
    """Both parts are there and the note is long enough."""
    return F.coalesce(has_predictions, F.lit(False)) & (word_count(note) >= words)


def last_valid_submissions(
    submissions: DataFrame,
    valid: Column,
    opens: str = OPENS,
    closes: str = CLOSES,
    limit: int = MAX_SUBMISSIONS,
) -> DataFrame:
    """Per entry the submission that counts: of the first five within the period, the last valid one."""
    when = local_time(submissions, "submitted_at")
    in_time = submissions.where((when >= moment(opens)) & (when <= moment(closes)))
    by_entry = W.partitionBy("entry_id")
    accepted = in_time.withColumn(
        "_nth", F.row_number().over(by_entry.orderBy("submitted_at", "submission_id"))
    ).where(F.col("_nth") <= limit)
    return (
        accepted.where(valid)
        .withColumn("_back", F.row_number().over(by_entry.orderBy(F.desc("_nth"))))
        .where(F.col("_back") == 1)
        .drop("_nth", "_back")
    )


def copied_submissions(predictions: DataFrame, block: list[str]) -> DataFrame:
    """Entries sharing whole blocks of predictions with an earlier entry, and how far the two agree overall.

    ``predictions`` is ``entry_id, submitted_at, state, constituency, candidate`` plus the ``block`` columns (usually
    the state).  Every entry is compared with the earliest entry of each block it has in common, not with all other
    copies, so the pairs grow with the entries and never with their square.  Gives ``entry_id, source_entry,
    shared_blocks, n_common`` and ``agreement``, the share of common seats with the same candidate.
    """
    seat = ["state", "constituency"]
    prints = predictions.groupBy("entry_id", "submitted_at", *block).agg(
        F.count(F.lit(1)).alias("_size"),
        F.bit_xor(F.xxhash64(*seat, "candidate")).alias("_print1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "candidate", *seat)).alias("_print2"),
    )
    same = [*block, "_size", "_print1", "_print2"]
    earliest = (
        prints.withColumn("_nth", F.row_number().over(W.partitionBy(*same).orderBy("submitted_at", "entry_id")))
        .where(F.col("_nth") == 1)
        .select(*same, F.col("entry_id").alias("source_entry"))
    )
    pairs = (
        spread_join(prints.drop("submitted_at"), earliest, same, ["entry_id"], "inner")
        .where(F.col("entry_id") != F.col("source_entry"))
        .groupBy("entry_id", "source_entry")
        .agg(F.count(F.lit(1)).alias("shared_blocks"))
    )
    own = predictions.select("entry_id", *seat, "candidate")
    paired = spread_join(own, pairs, ["entry_id"], seat, "inner")
    source = predictions.select(F.col("entry_id").alias("source_entry"), *seat, F.col("candidate").alias("_theirs"))
    both = spread_join(paired, source, ["source_entry", *seat], ["entry_id"], "inner")
    return both.groupBy("entry_id", "source_entry", "shared_blocks").agg(
        F.count(F.lit(1)).alias("n_common"),
        (F.count_if(F.col("candidate") == F.col("_theirs")) / F.count(F.lit(1))).alias("agreement"),
    )
