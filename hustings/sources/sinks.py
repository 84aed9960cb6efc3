"""Outputs: flat submissions, one folder per state, filled templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.sources.grids import ROW_KEY, SHEET_KEY
from hustings.operators.skew import key_counts, lookup
from hustings.session import materialise

# The template's outcome column, the column used when no sheet row names it, the submission columns.
OUTCOME_TITLE = "Predicted Outcome (W/L/O)"
OUTCOME_COLUMN = 6
SUBMISSION_COLUMNS = ["state", "constituency", "candidate", "party", "outcome"]
# Quotes in delimited files are doubled, as spreadsheets read them.
CSV = {"header": "true", "escape": '"'}


def project_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in columns if c in df.columns])


def check_target(spark: SparkSession, path: str, overwrite: bool = False) -> str:
    """The write mode for ``path``; an error at once, before anything is read or fitted, if it exists and must not change."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if overwrite:
        return "overwrite"
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise FileExistsError(f"{path} already exists; ask for overwriting to replace it")
    return "errorifexists"


def write_submission(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    project_existing(df, SUBMISSION_COLUMNS).write.mode(mode).format(fmt).options(**CSV).save(path)


def write_by_state(
    df: DataFrame,
    path: str,
    order: list[str],
    state: str = "state",
    fmt: str = "csv",
    mode: str = "errorifexists",
    rows_per_file: int = 5_000_000,
    working: list[str] | None = None,
) -> None:
    """One folder per state (``part_state=…``), rows in ``order``; the state stays a column of the files.

    Columns in ``working`` serve the order only and are not written.  With ``mode="overwrite"`` the folders of the states in
    ``df`` are replaced and those of other states stay.

    Rows are ranged by state and order, so a large state is written by several tasks and a small one by one.
    """
    (
        df.withColumn("part_state", F.col(state))
        .repartitionByRange("part_state", *order)
        .sortWithinPartitions("part_state", *order)
        .drop(*working or [])
        .write.mode(mode)
        .partitionBy("part_state")
        .options(**CSV)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .format(fmt)
        .save(path)
    )


def outcome_places(grid: DataFrame, title: str = OUTCOME_TITLE, default_column: int = OUTCOME_COLUMN) -> DataFrame:
    """Per sheet: row and 1-based column of the first cell row that names the outcome; first row and column 6 if none."""
    place = F.array_position("cells", F.lit(title)).cast("int")
    first = W.partitionBy(*SHEET_KEY).orderBy("row_idx")
    found = (
        grid.where(place > 0)
        .withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") == 1)
        .select(*SHEET_KEY, F.col("row_idx").alias("_row"), place.alias("_place"))
    )
    return materialise(
        key_counts(grid, SHEET_KEY)
        .join(found, SHEET_KEY, "left")
        .select(
            *SHEET_KEY,
            "_n",
            F.coalesce("_row", F.lit(0).cast("bigint")).alias("outcome_row"),
            F.coalesce("_place", F.lit(default_column)).alias("outcome_column"),
        )
    )


def fill_template(grid: DataFrame, outcomes: DataFrame, title: str = OUTCOME_TITLE) -> DataFrame:
    """The template grid with each row's outcome written into its outcome column, everything else unchanged.

    ``outcomes`` has ``source, sheet, row_idx, outcome``, one row per template row below the header.  Rows are
    matched by ``row_idx``; short rows are extended with nulls up to the outcome column.  The grid is read more than once:
    pass a written one.
    """
    places = outcome_places(grid, title)
    joined = lookup(grid, places, SHEET_KEY, ["row_idx"], "inner").join(
        outcomes.select(*ROW_KEY, "outcome"), ROW_KEY, "left"
    )
    at = F.col("outcome_column") - 1
    missing = F.greatest(F.col("outcome_column") - F.size("cells"), F.lit(0))
    padded = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), missing))
    filled = F.transform(padded, lambda c, i: F.when(i == at, F.col("outcome")).otherwise(c))
    writes = (F.col("row_idx") > F.col("outcome_row")) & F.col("outcome").isNotNull()
    return joined.select(*ROW_KEY, F.when(writes, filled).otherwise(F.col("cells")).alias("cells"))


def write_grid(grid: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A grid as a table in row order within each sheet range."""
    grid.repartitionByRange(*ROW_KEY).sortWithinPartitions(*ROW_KEY).write.mode(mode).parquet(path)
