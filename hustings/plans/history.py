"""Past results to a cross-validated model and WIN/LOSS outcomes."""

from __future__ import annotations

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions.text import MAJOR_PARTIES_LONG
from hustings.operators.cleaning import clean_results
from hustings.operators.encoding import closed_encoder, encode_closed
from hustings.operators.features import RESULT_FEATURES, add_major_flag
from hustings.operators.models import (
    boosted_trees,
    cross_validate,
    fit,
    fold_accuracy,
    outcome_label,
    score,
    split_counts,
    training_rows,
)
from hustings.operators.ordering import balanced_folds
from hustings.operators.stages import TREES, MajorFlag, Outcomes, prediction_pipeline
from hustings.operators.winners import label_winners, pick_winners
from hustings.plans.outcome import Outcome, class_balance
from hustings.session import materialise
from hustings.sources.grids import ROW_KEY, SHEET_KEY, read_files, result_sheets
from hustings.sources.sinks import check_target, write_submission

CONTEST = [*SHEET_KEY, "constituency_no"]
COLUMNS = [*ROW_KEY, "state", "constituency_no", "constituency", "candidate", "party", "total_votes", "win"]
CODES = {"party": "party_code", "constituency": "constituency_code", "state": "state_code"}


def labelled_sheets(
    grid: DataFrame, broad: bool = True, fallback: int | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Who won each constituency, as cleaned result rows with ``win``, and the sheets left out with the reason.

    Constituency numbers repeat between states, so the contest is a sheet and a number.  ``grid`` is read more than once:
    pass a written one.
    """
    records, reasons = result_sheets(grid, fallback, strict)
    labelled = label_winners(clean_results(records, broad), CONTEST, "total_votes", ["row_idx"])
    return labelled.select(*COLUMNS), reasons


def labelled_results(
    grid: DataFrame, broad: bool = True, fallback: int | None = None, strict: bool = False
) -> DataFrame:
    """Who won each constituency.  The grid is written once, so its sources are opened once; counts, headers and records are
    taken from that table."""
    return labelled_sheets(materialise(grid), broad, fallback, strict)[0]


def read_results(
    spark: SparkSession, folder: str, kind: str = "xlsx", broad: bool = True, fallback: int | None = None
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Labelled rows of a folder, files and sheets left out with reasons, and counts, from one reading of every file."""
    read = read_files(spark, folder, kind)
    labelled, reasons = labelled_sheets(read.grid, broad, fallback)
    return labelled, reasons.unionByName(read.problems), read.counts


def result_features(labelled: DataFrame, names: list[str] | None = None, any_case: bool = True) -> DataFrame:
    flagged = add_major_flag(labelled, names or MAJOR_PARTIES_LONG, any_case)
    return encode_closed(flagged, CODES, ROW_KEY)


def training_table(labelled: DataFrame, folds: int = 5) -> DataFrame:
    """Assembled features with ``fold``, written once."""
    folded = balanced_folds(result_features(materialise(labelled)), ["win"], ROW_KEY, folds)
    return training_rows(folded, RESULT_FEATURES, "win", ROW_KEY)


def validate(
    rows: DataFrame, preset: str = "history", folds: int = 5, parallelism: int = 1, **changes: object
) -> DataFrame:
    """Accuracy per fold."""
    scored = cross_validate(rows, lambda: boosted_trees(preset, "win", **changes), folds, parallelism)
    return fold_accuracy(scored, "win")


def outcomes(rows: DataFrame, preset: str = "history", mode: str = "threshold", **changes: object) -> tuple[Model, DataFrame]:
    """Model fitted on all rows and their ``outcome``: by predicted class, or (``argmax``) one WIN per contest."""
    model = fit(rows, boosted_trees(preset, "win", **changes))
    scored = score(model, rows)
    if mode == "argmax":
        return model, pick_winners(materialise(scored), CONTEST, "p_win", ["row_idx"], win="WIN", lose="LOSS")
    return model, scored.withColumn("outcome", outcome_label())


def pipeline(mode: str = "threshold", preset: str = "history", names: list[str] | None = None, **changes: object) -> Pipeline:
    """From labelled rows to outcomes as one pipeline, which can be saved once it is fitted."""
    outcome = Outcomes(contest=CONTEST if mode == "argmax" else [], rowId=["row_idx"])
    prepare = [MajorFlag(names=names or MAJOR_PARTIES_LONG)]
    return prediction_pipeline(
        prepare, closed_encoder(CODES, ROW_KEY), RESULT_FEATURES, boosted_trees(preset, "win", **changes), ROW_KEY, outcome
    )


def left_out(spark: SparkSession, folder: str, kind: str = "xlsx", fallback: int | None = None) -> DataFrame:
    """Files and sheets that give no results and why: ``source, sheet, reason``."""
    return read_results(spark, folder, kind, fallback=fallback)[1]


def process(
    spark: SparkSession,
    folder: str,
    out: str,
    kind: str = "xlsx",
    mode: str = "threshold",
    overwrite: bool = False,
    model: PipelineModel | None = None,
    **changes: object,
) -> Outcome:
    """Result files to a submission in ``out``; the target is checked first and every file is opened once.

    With a kept ``model`` nothing is fitted or validated.
    """
    write_mode = check_target(spark, out, overwrite)
    labelled, reasons, counts = read_results(spark, folder, kind)
    # Rows without a contest have no label and no outcome.
    labelled, reasons = materialise(labelled.where(F.col("win").isNotNull())), materialise(reasons)
    if model is not None:
        predicted = materialise(model.transform(labelled))
        write_submission(predicted, out, mode=write_mode)
        return Outcome(predicted, reasons, balance=class_balance(labelled, "win"), model=model, counts=counts)
    accuracy = materialise(validate(training_table(labelled), **changes))
    fitted = fit(labelled, pipeline(mode, **changes))
    predicted = materialise(fitted.transform(labelled))
    write_submission(predicted, out, mode=write_mode)
    splits = materialise(split_counts(fitted.stages[TREES], spark, RESULT_FEATURES))
    return Outcome(predicted, reasons, accuracy, class_balance(labelled, "win"), splits, fitted, counts)


def run(spark: SparkSession, folder: str, out: str, kind: str = "xlsx", mode: str = "threshold", **changes: object) -> DataFrame:
    """Result files to a submission in ``out``; gives the accuracy per fold."""
    return process(spark, folder, out, kind, mode, **changes).accuracy
