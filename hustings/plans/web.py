"""Stored candidate pages to features, a stand-in label, a cross-validated model and WIN/LOSS outcomes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import MAJOR_PARTIES_WEB
from hustings.operators.cleaning import clean_candidates
from hustings.operators.encoding import closed_encoder, encode_closed
from hustings.operators.features import WEB_FEATURES, add_web_flags, proxy_label
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
from hustings.operators.stages import TREES, CleanCandidates, MajorFlag, Outcomes, StandInLabel, prediction_pipeline
from hustings.operators.winners import pick_winners
from hustings.plans.outcome import Outcome, class_balance
from hustings.session import materialise
from hustings.sources.grids import source_state
from hustings.sources.pages import candidate_rows, page_candidates, page_tables, tables_lacking
from hustings.sources.sinks import check_target, write_submission

ROW = ["source", "page", "row_idx"]
CODES = {"party": "party_code", "education": "edu_code", "constituency": "const_code", "state": "state_code"}


def candidates_from_pages(pages: DataFrame, source: str = "source", html: str = "html") -> DataFrame:
    """Candidate records of all pages with their ``state``."""
    return page_candidates(pages, source, html).withColumn("state", source_state(F.col("source")))


def web_features(cleaned: DataFrame) -> DataFrame:
    """Flag and codes of candidates already cleaned."""
    return encode_closed(add_web_flags(cleaned), CODES, ROW)


def training_table(candidates: DataFrame, folds: int = 5) -> DataFrame:
    cleaned = materialise(clean_candidates(candidates))  # pages are parsed once
    labelled = proxy_label(web_features(cleaned), F.concat_ws("|", *ROW))
    return training_rows(balanced_folds(labelled, ["proxy"], ROW, folds), WEB_FEATURES, "proxy", ROW)


def validate(rows: DataFrame, folds: int = 5, parallelism: int = 1, **changes: object) -> DataFrame:
    scored = cross_validate(rows, lambda: boosted_trees("web", "proxy", **changes), folds, parallelism)
    return fold_accuracy(scored, "proxy")


def outcomes(rows: DataFrame, mode: str = "threshold", **changes: object) -> DataFrame:
    """Rows with ``outcome``: by predicted class, or (``argmax``) one WIN per state and constituency."""
    model = fit(rows, boosted_trees("web", "proxy", **changes))
    scored = score(model, rows)
    if mode == "argmax":
        return pick_winners(materialise(scored), ["state", "constituency"], "p_win", ROW, win="WIN", lose="LOSS")
    return scored.withColumn("outcome", outcome_label())


def pipeline(mode: str = "threshold", **changes: object) -> Pipeline:
    """From candidate records to outcomes as one pipeline; its model is fitted with :func:`fit_pipeline` and can be saved.

    The model scores the records of other pages too: values it has not seen get a code of their own.
    """
    prepare = [CleanCandidates(), MajorFlag(names=MAJOR_PARTIES_WEB, anyCase=False), StandInLabel(rowId=ROW)]
    outcome = Outcomes(contest=["state", "constituency"] if mode == "argmax" else [], rowId=ROW)
    return prediction_pipeline(prepare, closed_encoder(CODES, ROW), WEB_FEATURES, boosted_trees("web", "proxy", **changes), ROW, outcome)


def fit_pipeline(candidates: DataFrame, mode: str = "threshold", **changes: object) -> PipelineModel:
    """The fitted pipeline; the pages of ``candidates`` are parsed once."""
    return fit(materialise(candidates), pipeline(mode, **changes))


def read_candidates(pages: DataFrame, source: str = "source", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Candidate records and the pages without a candidate table, from one reading of the pages."""
    tables = materialise(page_tables(pages, source, html))
    return candidate_rows(tables).withColumn("state", source_state(F.col("source"))), tables_lacking(tables)


def process(
    pages: DataFrame, out: str, mode: str = "threshold", overwrite: bool = False, model: PipelineModel | None = None, **changes: object
) -> Outcome:
    """Stored pages (``source, html``) to a submission in ``out``; the target is checked first and the pages are read once.

    With a kept ``model`` nothing is fitted or validated.
    """
    spark = pages.sparkSession
    write_mode = check_target(spark, out, overwrite)
    candidates, reasons = read_candidates(pages)
    candidates = materialise(candidates)
    if model is not None:
        predicted = materialise(model.transform(candidates))
        write_submission(predicted, out, mode=write_mode)
        return Outcome(predicted, reasons, model=model)
    rows = training_table(candidates)
    accuracy = materialise(validate(rows, **changes))
    fitted = fit(candidates, pipeline(mode, **changes))
    predicted = materialise(fitted.transform(candidates))
    write_submission(predicted, out, mode=write_mode)
    splits = materialise(split_counts(fitted.stages[TREES], spark, WEB_FEATURES))
    return Outcome(predicted, reasons, accuracy, class_balance(rows, "proxy"), splits, fitted)


def run(pages: DataFrame, out: str, mode: str = "threshold", **changes: object) -> DataFrame:
    """Stored pages (``source, html``) to a submission in ``out``; gives the accuracy per fold."""
    return process(pages, out, mode, **changes).accuracy
