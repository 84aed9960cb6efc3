"""Excel workbooks as grids.

Python only unpacks the archives; the sheets' XML is read by Spark.  A workbook is the unit of reading, its size being
limited by the format (a sheet has at most 1,048,576 rows); any number of workbooks is read in parallel.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.functions.text import missing_to_null
from hustings.sources.grids import GRID, file_filter

TEXT = "struct<t: string, r: array<struct<t: string>>>"
SHEET_XML = f"sheetData struct<row: array<struct<_r: int, c: array<struct<_r: string, _t: string, v: string, `is`: {TEXT}>>>>>"
STRINGS_XML = f"si array<{TEXT}>"
BOOK_XML = "sheets struct<sheet: array<struct<_name: string, _id: string>>>"
LINKS_XML = "Relationship array<struct<_Id: string, _Target: string>>"
XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "nullValue": "\u0000"}

BOOK, LINKS, STRINGS = "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/sharedStrings.xml"


def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per sheet part, along with the workbook's own parts; unreadable archives give a row with a reason."""
    for batch in batches:
        for name, content in zip(batch["source"], batch["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    text = {n: archive.read(n).decode("utf-8") for n in archive.namelist() if n.startswith("xl/") and n.endswith((".xml", ".rels"))}
            except Exception as error:  # whatever is wrong with one file is its reason, the others go on
                yield pd.DataFrame([[name, None, None, None, None, None, f"{type(error).__name__}: {error}"]])
                continue
            common = [text.get(BOOK), text.get(LINKS), text.get(STRINGS)]
            for part in sorted(n for n in text if n.startswith("xl/worksheets/") and n.endswith(".xml")):
                yield pd.DataFrame([[name, part, text[part], *common, None]])


def inner_text(item: Column) -> Column:
    """Text of a string item, plain or made of runs."""
    runs = F.array_join(F.transform(item["r"], lambda r: r["t"]), "")
    return F.coalesce(item["t"], runs)


def column_number(reference: Column) -> Column:
    """1-based column of a cell reference such as ``AB12``."""
    letters = F.split(F.regexp_extract(reference, "^([A-Z]+)", 1), "")
    return F.aggregate(letters, F.lit(0), lambda n, x: n * 26 + F.when(x == "", 0).otherwise(F.ascii(x) - 64))


def unpacked_workbooks(
    spark: SparkSession,
    path: str,
    glob: str = "*.xlsx",
    without_prefix: str | None = "~$",
    without_part: str | None = "Template",
) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("content", "_metadata")
    named = file_filter(files, without_prefix, without_part).select(F.col("_metadata.file_path").alias("source"), "content")
    return named.mapInPandas(
        unpack, "source string, part string, xml string, book string, links string, strings string, reason string"
    )


def workbook_rows(unpacked: DataFrame) -> DataFrame:
    """The grid of all sheets with ``reason`` and ``is_row``; a file or sheet that cannot be read is one row with the reason.

    Numbers stay as written in the file, empty and missing cells are null.  The XML is parsed once.
    """
    sheet = F.from_xml("xml", f"{SHEET_XML}, broken string", {**XML_OPTIONS, "columnNameOfCorruptRecord": "broken"})
    parsed = unpacked.withColumn("_sheet", sheet).select(
        "source",
        "part",
        F.coalesce("reason", F.when(F.col("_sheet.broken").isNotNull(), F.concat(F.lit("malformed XML in "), "part"))).alias("reason"),
        F.col("_sheet.sheetData.row").alias("rows"),
        F.transform(F.from_xml("strings", STRINGS_XML, XML_OPTIONS)["si"], inner_text).alias("shared"),
        F.from_xml("book", BOOK_XML, XML_OPTIONS)["sheets"]["sheet"].alias("sheets"),
        F.from_xml("links", LINKS_XML, XML_OPTIONS)["Relationship"].alias("links"),
    )
    own = F.filter("links", lambda k: F.endswith(F.col("part"), F.regexp_replace(k["_Target"], "^/?(xl/)?", "")))
    named = parsed.withColumn("link", F.get(own, F.lit(0))["_Id"]).withColumn(
        "sheet", F.get(F.filter("sheets", lambda s: s["_id"] == F.col("link")), F.lit(0))["_name"]
    )

    def value(cell: Column) -> Column:
        kind = cell["_t"]
        return (
            F.when(kind == "s", F.get("shared", cell["v"].try_cast("int")))
            .when(kind == "inlineStr", inner_text(cell["is"]))
            .when(kind == "b", F.when(cell["v"] == "1", F.lit("True")).otherwise(F.lit("False")))
            .when(kind == "e", F.lit(None).cast("string"))
            .otherwise(cell["v"])
        )

    def resolved(row: Column) -> Column:
        cells = F.transform(row["c"], lambda c: F.struct(column_number(c["_r"]).alias("k"), value(c).alias("v")))
        return F.struct(row["_r"].alias("r"), cells.alias("c"))

    # Strings are put in before the rows come apart, so no row carries the string table.
    empty = F.struct(F.lit(None).cast("int").alias("r"), F.lit(None).cast("array<struct<k:int,v:string>>").alias("c"))
    entries = F.when(F.col("reason").isNotNull(), F.array(empty)).otherwise(F.transform("rows", resolved))
    rows = named.select("source", "sheet", "reason", F.explode(entries).alias("row"))
    placed = rows.select(
        "source", "sheet", "reason", (F.col("row.r") - 1).cast("bigint").alias("row_idx"), F.map_from_entries("row.c").alias("at")
    )
    width = F.coalesce(F.array_max(F.map_keys("at")), F.lit(0))
    filled = F.transform(
        F.slice(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), 1, width), lambda i: missing_to_null(F.try_element_at("at", i))
    )
    cells = F.coalesce(filled, F.array().cast("array<string>")).alias("cells")
    return placed.select("source", "sheet", "row_idx", cells, "reason", F.col("reason").isNull().alias("is_row"))


def workbook_grid(unpacked: DataFrame) -> DataFrame:
    """The rows of all sheets that can be read."""
    return workbook_rows(unpacked).where("is_row").select(GRID)


def read_workbooks(spark: SparkSession, path: str, **files: str | None) -> DataFrame:
    """All sheets of all workbooks in a folder as one grid."""
    return workbook_grid(unpacked_workbooks(spark, path, **files))


def unreadable_workbooks(unpacked: DataFrame) -> DataFrame:
    """Files that are no workbooks and sheets whose XML cannot be read: ``source, reason``."""
    return workbook_rows(unpacked).where(F.col("reason").isNotNull()).select("source", "reason")
