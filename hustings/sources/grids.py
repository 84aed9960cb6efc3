"""Result grids: headerless sheets of text cells, one row per sheet row.

A grid is ``source string, sheet string, row_idx bigint, cells array<string>``.  Many files and sheets live in one
DataFrame; nothing here loops over files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hustings.functions.text import missing_to_null
from hustings.operators.skew import key_counts, lookup
from hustings.session import materialise
from hustings.sources.delimited import escaped, opens, records

GRID = ["source", "sheet", "row_idx", "cells"]
SHEET_KEY = ["source", "sheet"]
ROW_KEY = ["source", "sheet", "row_idx"]

# The first header cell of a result sheet and the names its columns get.
RESULT_MARKER = "STATE/UT NAME"
RESULT_COLUMNS = {
    "state": ["STATE/UT NAME"],
    "constituency_no": ["AC NO."],
    "constituency": ["AC NAME"],
    "candidate": ["CANDIDATE NAME"],
    "party": ["PARTY"],
    "total_votes_raw": ["TOTAL"],
}
# The column names a prediction template may use, first match wins, and its sheets.
TEMPLATE_COLUMNS = {
    "constituency": ["Constituency", "Constituency_Name"],
    "state": ["State/UT", "State"],
    "party": ["Party"],
}
TEMPLATE_SHEETS = ["Assam", "Kerala", "Puducherry", "Tamil Nadu", "West Bengal"]
FALLBACK_HEADER = 2


def file_filter(df: DataFrame, without_prefix: str | None = "~$", without_part: str | None = "Template") -> DataFrame:
    """Keep rows of files whose name has neither the prefix nor the part; files left out are never opened."""
    name = F.col("_metadata.file_name")
    if without_prefix:
        df = df.where(~F.startswith(name, F.lit(without_prefix)))
    if without_part:
        df = df.where(~F.contains(name, F.lit(without_part)))
    return df


def file_name(source: Column) -> Column:
    """The last part of a path; a source that is no path stays as it is."""
    return F.url_decode(F.regexp_replace(F.substring_index(source, "/", -1), r"\+", "%2B"))


def split_cells(line: Column, separator: str = ",") -> Column:
    """Cells of one delimited line, quotes honoured."""
    sep = escaped(separator)
    quoted = r'"[^"]*+(?:""[^"]*+)*+"'
    # With a separator in front every cell has one, an empty first cell too.
    found = F.regexp_extract_all(F.concat(F.lit(separator), line), F.lit(f"{sep}({quoted}|[^{sep}]*+)"), F.lit(1))
    return F.transform(
        found,
        lambda c: F.when(
            F.startswith(c, F.lit('"')), F.replace(F.regexp_replace(c, '^"|"$', ""), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )


def delimited_rows(
    spark: SparkSession,
    path: str,
    glob: str = "*.csv",
    separator: str = ",",
    without_prefix: str | None = "~$",
    without_part: str | None = "Template",
) -> DataFrame:
    """The grid of delimited files with ``reason``, what is wrong with a row's file from that row on, and ``is_row``.

    ``row_idx`` is the record's number within the file and ``source`` its whole path.  Files are read in splits, however large,
    in one pass that writes the lines with their split.  A record is a line, or several where a quoted cell spans them; see
    :func:`hustings.sources.delimited.records`.
    """
    tagged = file_filter(
        spark.read.option("pathGlobFilter", glob).text(path).select("value", "_metadata"), without_prefix, without_part
    ).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_seq"),
        "value",
        opens(F.col("value"), separator, False).alias("open0"),
        opens(F.col("value"), separator, True).alias("open1"),
    )
    return records(materialise(tagged)).select(
        "source",
        F.regexp_replace(file_name(F.col("source")), r"\.[^.]*$", "").alias("sheet"),
        "row_idx",
        F.transform(split_cells(F.col("value"), separator), missing_to_null).alias("cells"),
        F.when(F.col("loose"), F.lit("a quote is never closed")).alias("reason"),
        F.lit(True).alias("is_row"),
    )


def read_delimited(spark: SparkSession, path: str, **files: str | None) -> DataFrame:
    """Delimited files as a grid; ``files`` are the settings of :func:`delimited_rows`."""
    return delimited_rows(spark, path, **files).select(GRID)


@dataclass
class ReadFiles:
    """What one reading of a folder gives: the ``grid``, the ``problems`` (``source, sheet, reason``) and the observed
    ``counts`` of rows and of rows with a problem.  Both tables are views of one written table."""

    grid: DataFrame
    problems: DataFrame
    counts: dict[str, int]


def read_files(spark: SparkSession, path: str, kind: str = "xlsx", **files: str | None) -> ReadFiles:
    """A folder of workbooks (``xlsx``) or delimited files (``csv``), every file opened once."""
    if kind == "xlsx":
        from hustings.sources.workbooks import unpacked_workbooks, workbook_rows

        rows = workbook_rows(unpacked_workbooks(spark, path, **files))
    else:
        rows = delimited_rows(spark, path, **files)
    seen = Observation()
    counted = rows.observe(seen, F.count_if("is_row").alias("rows"), F.count("reason").alias("problems"))
    written = materialise(counted)
    problems = written.where(F.col("reason").isNotNull()).select(*SHEET_KEY, "reason").distinct()
    return ReadFiles(written.where("is_row").select(GRID), problems, dict(seen.get))


def select_sheets(grid: DataFrame, sheets: list[str]) -> DataFrame:
    """The named sheets; a name that does not occur adds nothing."""
    return grid.where(F.col("sheet").isin(sheets))


def find_headers(grid: DataFrame, marker: str = RESULT_MARKER, fallback: int | None = None) -> DataFrame:
    """One row per sheet: ``header_idx``, the ``header`` cells and the sheet's number of rows ``_n``.

    The header is the first row whose first cell equals ``marker`` exactly, else the row numbered ``fallback``;
    ``header_idx`` is null where neither exists.  The table is written once, as everything about a sheet hangs on it.
    """
    marked = F.get("cells", F.lit(0)) == marker
    wanted = marked if fallback is None else marked | (F.col("row_idx") == fallback)
    rank = F.when(marked, F.lit(0)).otherwise(F.lit(1))
    best = W.partitionBy(*SHEET_KEY).orderBy(rank, "row_idx")
    rows = (
        grid.where(wanted)
        .withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") == 1)
        .select(*SHEET_KEY, F.col("row_idx").alias("header_idx"), F.col("cells").alias("header"))
    )
    return materialise(key_counts(grid, SHEET_KEY).join(rows, SHEET_KEY, "left"))


def exact_position(names: list[str]) -> Column:
    """1-based place in ``header`` of the first of ``names`` that occurs there, else null."""
    places = [F.array_position("header", F.lit(n)) for n in names]
    return F.coalesce(*[F.when(p > 0, p) for p in places])


def promote(
    grid: DataFrame,
    headers: DataFrame,
    places: dict[str, Column],
    required: list[str] | None = None,
    keep_cells: bool = False,
) -> DataFrame:
    """Records: the rows below each sheet's header, with a named column per entry of ``places``.

    A name missing from a header gives null.  Sheets without a header, or without one of the ``required`` names,
    give no rows; see :func:`rejected`.
    """
    usable = headers.where(F.col("header_idx").isNotNull()).select(
        *SHEET_KEY, "_n", "header_idx", *[p.cast("int").alias(f"_at_{n}") for n, p in places.items()]
    )
    for name in required or []:
        usable = usable.where(F.col(f"_at_{name}").isNotNull())
    joined = lookup(grid, usable, SHEET_KEY, ["row_idx"], "inner")
    below = joined.where(F.col("row_idx") > F.col("header_idx"))
    cells = [F.get("cells", F.col(f"_at_{n}") - 1).alias(n) for n in places]
    return below.select(*ROW_KEY, *(["cells"] if keep_cells else []), *cells)


def rejected(headers: DataFrame, places: dict[str, Column], required: list[str] | None = None) -> DataFrame:
    """Sheets that :func:`promote` leaves out and why: ``source, sheet, reason``."""
    lacks = [F.when(places[n].isNull(), F.lit(f"no column {n}")) for n in required or []]
    reason = F.coalesce(F.when(F.col("header_idx").isNull(), F.lit("no header row")), *lacks)
    return headers.select(*SHEET_KEY, reason.alias("reason")).where(F.col("reason").isNotNull())


def require_headers(headers: DataFrame) -> DataFrame:
    """The strict form: the query fails when a sheet has no header."""
    message = F.concat(F.lit("no header row in "), "source", F.lit("/"), "sheet")
    checked = F.when(F.col("header_idx").isNull(), F.raise_error(message).cast("bigint")).otherwise(F.col("header_idx"))
    return headers.withColumn("header_idx", checked)


def exact_places(columns: dict[str, list[str]]) -> dict[str, Column]:
    return {name: exact_position(titles) for name, titles in columns.items()}


def result_sheets(grid: DataFrame, fallback: int | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Result sheets as records under their standard names, and the sheets left out with the reason.

    Sheets lacking one of the columns are left out.  With a ``fallback`` header row the constituency name alone is
    required and other absent columns are null.
    """
    headers = find_headers(grid, RESULT_MARKER, fallback)
    if strict:
        headers = require_headers(headers)
    required = list(RESULT_COLUMNS) if fallback is None else ["constituency"]
    places = exact_places(RESULT_COLUMNS)
    return promote(grid, headers, places, required), rejected(headers, places, required)


def result_records(grid: DataFrame, fallback: int | None = None, strict: bool = False) -> DataFrame:
    """The records of :func:`result_sheets`."""
    return result_sheets(grid, fallback, strict)[0]


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def source_state(source: Column) -> Column:
    """State name from a source key or the path of a file: folders, extension and year go, the case stays."""
    name = F.when(F.contains(source, F.lit("/")), F.regexp_replace(F.substring_index(source, "/", -1), r"\.[^.]*$", ""))
    return F.regexp_replace(F.coalesce(name, source), "2021", "")
