"""Candidate tables inside stored web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.text import ATTRIBUTES, plain_text

# What a lower-cased column title must contain to get each standard name, in order of preference.
WEB_COLUMNS = {
    "candidate": "candidate",
    "constituency": "constituency",
    "party": "party",
    "criminal": "criminal_cases",
    "educat": "education",
    "asset": "total_assets",
}
TABLE_ID = "table1"


def elements(html: Column, tag: str) -> Column:
    """Inner markup of every ``tag`` element that holds no element of the same tag."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b{ATTRIBUTES}>(.*?)</{tag}\s*>"), F.lit(1))


def open_elements(html: Column, tag: str, ends: list[str]) -> Column:
    """Like :func:`elements`, for tags whose end may be left out: an element also ends before any of ``ends``."""
    stop = "|".join([rf"</{tag}\b", *[rf"<{e}\b" for e in ends], r"\z"])
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b{ATTRIBUTES}>(.*?)(?={stop})"), F.lit(1))


def table_markup(html: Column, table_id: str = TABLE_ID) -> Column:
    """Inner markup of the first table with the given id, empty when the page has none.

    Tags are matched by depth, so tables inside its cells do not end it; of those the text stays, as part of the cell.
    """
    tag = rf"(?is)<table\b{ATTRIBUTES}>|</table\s*>"
    name = r"(?<![\w-])id\s*="
    wanted = rf"""(?is)^<table\b(?:(?!{name})(?:"[^"]*+"|'[^']*+'|[^>"']))*+{name}\s*["']?{table_id}["'\s>]"""
    pieces = F.split(html, tag, F.lit(-1))
    pairs = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(tag), F.lit(0)).alias("tag"),
        F.slice(pieces, F.lit(2), F.size(pieces) - 1).alias("after"),
    )

    def step(state: Column, pair: Column) -> Column:
        opens = ~F.startswith(pair["tag"], F.lit("</"))
        starts = (state["depth"] == 0) & ~state["done"] & pair["tag"].rlike(wanted)
        inside = state["depth"] > 0
        depth = (
            F.when(starts, F.lit(1))
            .when(inside & opens, state["depth"] + 1)
            .when(inside, state["depth"] - 1)
            .otherwise(F.lit(0))
        )
        kept = F.when(depth == 1, pair["after"]).when(depth > 1, F.regexp_replace(pair["after"], f"<{ATTRIBUTES}>", " ")).otherwise("")
        return F.struct(
            depth.alias("depth"), (state["done"] | (inside & (depth == 0))).alias("done"), F.concat(state["text"], kept).alias("text")
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("text"))
    return F.coalesce(F.aggregate(pairs, start, step, lambda state: state["text"]), F.lit(""))


def standard_name(title: Column) -> Column:
    lowered = F.lower(title)
    name = title
    for part, standard in reversed(list(WEB_COLUMNS.items())):
        name = F.when(F.contains(lowered, F.lit(part)), F.lit(standard)).otherwise(name)
    return name


def page_tables(pages: DataFrame, source: str = "source", html: str = "html", table_id: str = TABLE_ID) -> DataFrame:
    """One row per page: ``source``, a ``page`` key, the ``header`` titles and the markup of the table's ``rows``; ``lacking``
    tells that the page has no such table.

    A page is its source and its text: a page that a source holds several times counts once, so that source, page and row
    tell all rows apart.
    """
    tables = pages.select(
        F.col(source).alias("source"), F.md5(F.col(html)).alias("page"), table_markup(F.col(html), table_id).alias("_table")
    ).dropDuplicates(["source", "page"])
    return tables.select(
        "source",
        "page",
        F.transform(open_elements(F.col("_table"), "th", ["th", "td", "tr", "/tr"]), plain_text).alias("header"),
        open_elements(F.col("_table"), "tr", ["tr"]).alias("rows"),
        (F.col("_table") == "").alias("lacking"),
    )


def row_cells(tables: DataFrame, keep: list[str]) -> DataFrame:
    """Rows below the first with their ``row_idx`` and ``cells``; rows without cells are dropped."""
    # The outer form asks nothing of the array first, for which Spark would cut the table into rows twice.
    return (
        tables.select(*keep, F.posexplode_outer("rows").alias("row_idx", "_row"))
        .where((F.col("row_idx") > 0) & F.col("_row").rlike(rf"(?i)<td\b{ATTRIBUTES}>"))
        .select(
            *keep,
            F.col("row_idx").cast("bigint").alias("row_idx"),
            F.transform(open_elements(F.col("_row"), "td", ["td", "th", "tr", "/tr"]), plain_text).alias("cells"),
        )
    )


def page_rows(pages: DataFrame, source: str = "source", html: str = "html", table_id: str = TABLE_ID) -> DataFrame:
    """Table rows of every page: ``source, header, row_idx, cells``; a page without the table gives none."""
    return row_cells(page_tables(pages, source, html, table_id), ["source", "page", "header"])


def candidate_rows(tables: DataFrame) -> DataFrame:
    """Candidate rows of :func:`page_tables` under standard column names, the first title that matches a name wins; null where
    none does.  Titles are matched once per page, before its rows are taken apart."""
    named = tables.withColumn("_named", F.transform("header", standard_name))
    places = [F.array_position("_named", F.lit(n)).cast("int").alias(f"_at_{n}") for n in WEB_COLUMNS.values()]
    placed = named.select("source", "page", "rows", *places)
    found = row_cells(placed, ["source", "page", *[f"_at_{n}" for n in WEB_COLUMNS.values()]])
    return found.select("source", "page", "row_idx", *[F.get("cells", F.col(f"_at_{n}") - 1).alias(n) for n in WEB_COLUMNS.values()])


def page_candidates(
    pages: DataFrame, source: str = "source", html: str = "html", table_id: str = TABLE_ID
) -> DataFrame:
    """Candidate rows of all pages under standard column names."""
    return candidate_rows(page_tables(pages, source, html, table_id))


def tables_lacking(tables: DataFrame) -> DataFrame:
    """Pages of :func:`page_tables` that give no rows, with the reason: ``source, page, reason``."""
    return tables.where("lacking").select("source", "page", F.lit("candidate table not found").alias("reason"))


def pages_without_table(
    pages: DataFrame, source: str = "source", html: str = "html", table_id: str = TABLE_ID
) -> DataFrame:
    """Pages that give no rows, with the reason."""
    lacking = pages.where(table_markup(F.col(html), table_id) == "")
    return lacking.select(F.col(source).alias("source"), F.lit("candidate table not found").alias("reason"))
