"""Past results and a template of future candidates to one predicted winner per constituency."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions.text import MAJOR_PARTIES
from hustings.operators.cleaning import tidy_keys
from hustings.operators.encoding import SafeEncoder
from hustings.operators.features import RESULT_FEATURES
from hustings.operators.models import boosted_trees, fit
from hustings.operators.stages import MajorFlag, Outcomes, TidyKeys, prediction_pipeline
from hustings.plans.history import CODES, read_results
from hustings.plans.outcome import Outcome
from hustings.session import materialise
from hustings.sources.grids import (
    FALLBACK_HEADER,
    ROW_KEY,
    SHEET_KEY,
    TEMPLATE_COLUMNS,
    TEMPLATE_SHEETS,
    exact_places,
    promote,
    read_files,
    rejected,
    select_sheets,
)
from hustings.sources.sinks import OUTCOME_TITLE, check_target, fill_template, outcome_places, write_by_state, write_grid


def template_sheets(grid: DataFrame, sheets: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates to predict, and the sheets that give none with the reason: ``source, sheet, reason``.

    A sheet's header is the row naming the outcome column, else its first row.  Sheets without a constituency column have
    nothing to predict; a wanted sheet that is nowhere in the file is named too, without a source.
    """
    wanted = TEMPLATE_SHEETS if sheets is None else sheets
    chosen = select_sheets(grid, wanted)
    places = outcome_places(chosen, OUTCOME_TITLE)
    header_rows = chosen.select(*ROW_KEY, F.col("cells").alias("header"))
    headers = places.withColumnRenamed("outcome_row", "row_idx").join(header_rows, ROW_KEY, "left")
    headers = headers.withColumnRenamed("row_idx", "header_idx")
    columns = exact_places(TEMPLATE_COLUMNS)
    known = headers.where(F.col("header").isNotNull())
    lacking = rejected(headers.withColumn("header_idx", F.when(F.col("header").isNotNull(), F.col("header_idx"))), columns, ["constituency"])
    named = grid.sparkSession.createDataFrame([(s,) for s in wanted], "sheet string")
    absent = named.join(F.broadcast(places.select("sheet").distinct()), "sheet", "left_anti")
    absent = absent.select(F.lit(None).cast("string").alias("source"), "sheet", F.lit("no such sheet").alias("reason"))
    return promote(chosen, known, columns), lacking.unionByName(absent)


def template_records(grid: DataFrame, sheets: list[str] | None = None) -> DataFrame:
    """Candidates to predict."""
    return template_sheets(grid, sheets)[0]


def predict_template(
    labelled: DataFrame, template: DataFrame, partitions: int | None = None, **changes: object
) -> DataFrame:
    """Template rows with ``p_win`` and ``outcome``: W for exactly one row per sheet and constituency, else L.

    The vocabularies cover both datasets, and state names are brought to the same form first.
    """
    model, rows = fit_pipeline(labelled, template, partitions, **changes)
    return predict(model, rows)


def fit_pipeline(
    labelled: DataFrame, template: DataFrame, partitions: int | None = None, **changes: object
) -> tuple[PipelineModel, DataFrame]:
    """A pipeline from records to outcomes, fitted on past results, and the written template rows it covers.

    The model can be saved and loaded; it holds the vocabularies of both datasets.
    """
    columns = list(CODES)
    future = materialise(template)
    known = materialise(labelled.where(F.col("win").isNotNull()))
    encoder = SafeEncoder(inputCols=columns, outputCols=list(CODES.values()), template=tidy_keys(future, ["state"]), rowId=ROW_KEY)
    pipeline = prediction_pipeline(
        [TidyKeys(columns=["state"]), MajorFlag(names=MAJOR_PARTIES)],
        encoder,
        RESULT_FEATURES,
        boosted_trees("template", "win", **changes),
        ROW_KEY,
        Outcomes(contest=[*SHEET_KEY, "constituency"], rowId=["row_idx"], win="W", lose="L"),
        partitions,
    )
    return fit(known, pipeline), future


def predict(model: PipelineModel, template: DataFrame) -> DataFrame:
    """Outcomes of template rows by a fitted, or loaded, pipeline."""
    return model.transform(template).select(*ROW_KEY, "constituency", "state", "party", "p_win", "outcome")


def filled_template(grid: DataFrame, predicted: DataFrame) -> DataFrame:
    """The template grid with the predicted outcomes in its outcome column."""
    return fill_template(grid, predicted.select(*ROW_KEY, "outcome"))


def full_rows(filled: DataFrame, places: DataFrame) -> DataFrame:
    """The filled template below its headers with a text column per header title, ``sheet`` and ``row_idx`` in front.

    ``places`` are the outcome places of the grid.  The titles of all sheets (one header row each) name the columns, in
    order of appearance; a sheet without a title has null there.  The outcome column is always among them.  Titles that
    differ in case only share a column, and a title that is one of the working names gets a space in front.
    """
    tops = filled.join(
        places.select(*SHEET_KEY, F.col("outcome_row").alias("row_idx"), "outcome_row", "outcome_column"), ROW_KEY
    ).select(*SHEET_KEY, "outcome_row", "outcome_column", F.col("cells").alias("header"))
    tops = materialise(tops)
    titles = {}
    for row in tops.orderBy(*SHEET_KEY).collect():  # one row per sheet of the template
        for title in row["header"]:
            if title is not None:
                titles.setdefault(title.lower(), title)
    titles.setdefault(OUTCOME_TITLE.lower(), OUTCOME_TITLE)
    below = filled.join(F.broadcast(tops), SHEET_KEY).where(F.col("row_idx") > F.col("outcome_row"))
    lowered = F.transform("header", F.lower)

    def cell(key: str) -> F.col:
        place = F.array_position(lowered, F.lit(key)).cast("int")
        own = F.when(place > 0, F.get("cells", place - 1))
        return F.coalesce(own, F.get("cells", F.col("outcome_column") - 1)) if key == OUTCOME_TITLE.lower() else own

    working = ("sheet", "row_idx", "part_state")
    named = [cell(key).alias(f" {title}" if key in working else title) for key, title in titles.items()]
    return below.select("sheet", "row_idx", *named)


def process(
    spark: SparkSession,
    folder: str | None,
    template: str,
    out: str,
    kind: str = "xlsx",
    sheets: list[str] | None = None,
    overwrite: bool = False,
    model: PipelineModel | None = None,
    **changes: object,
) -> Outcome:
    """Result files and a template file to the whole template rows by state (``out/states``, the outcome in its column)
    and the filled template (``out/filled``).

    A file without a header row is read with the usual header position, and only the exact no-candidate text is left out.
    The targets are checked before anything is read; with ``overwrite`` the states in the template are replaced and other
    states' folders stay.  With a kept ``model`` no results are read and nothing is fitted.
    """
    states_mode, filled_mode = (check_target(spark, f"{out}/{part}", overwrite) for part in ("states", "filled"))
    read = read_files(spark, template, kind, glob="*", without_part=None)
    grid = materialise(select_sheets(read.grid, TEMPLATE_SHEETS if sheets is None else sheets))
    records, lacking = template_sheets(grid, sheets)
    reasons, counts = lacking.unionByName(read.problems), read.counts
    if model is None:
        labelled, others, counts = read_results(spark, folder, kind, broad=False, fallback=FALLBACK_HEADER)
        reasons = reasons.unionByName(others)
        model, records = fit_pipeline(labelled, records, **changes)
    predicted = materialise(predict(model, records))
    filled = materialise(filled_template(grid, predicted))
    write_by_state(
        full_rows(filled, outcome_places(grid)), f"{out}/states", ["row_idx"], state="sheet", working=["sheet", "row_idx"], mode=states_mode
    )
    write_grid(filled, f"{out}/filled", filled_mode)
    return Outcome(predicted, materialise(reasons), model=model, counts=counts)


def run(
    spark: SparkSession, folder: str, template: str, out: str, kind: str = "xlsx", sheets: list[str] | None = None, **changes: object
) -> DataFrame:
    """Result files and a template file to the predicted rows; see :func:`process`."""
    return process(spark, folder, template, out, kind, sheets, **changes).predicted
