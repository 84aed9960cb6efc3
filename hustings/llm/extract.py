"""Main text of web pages: differences to the page with the nearest address on the same host, checked by the structure.

A page is parsed into lines with the part of the page they stand in, once for the hashes of the lines, which are written, and
once for their text, which travels only to the result of the comparison.  Every page is compared: pages of a host are paired
along the order of their paths, with the neighbour whose path has the longer common beginning (pages of a host with equal
lines stand there once), their lines are aligned by a longest common subsequence of line hashes, and shared lines are deleted.
The structure is an exact check after that: it takes back the lines of an article or main element, which neighbours may share
too, and drops what differs from page to page without belonging to the text.
"""

from __future__ import annotations

import bz2
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.page_lines import CHROME, MAIN, OPEN, main_text, page_lines, shared
from hustings.llm.tables import own_columns, slices, stored, text_of
from hustings.operators.ordering import positions
from hustings.operators.skew import spread_join

OUTPUT = 8 << 20


def line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages, html last, to the hashes of their lines."""
    for batch in batches:
        hashed = [[line_hash(t) for _, t in page_lines(html.as_py() or "")] for html in batch.columns[-1]]
        for a, b in slices([8 * len(h) for h in hashed], OUTPUT):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(hashed[a:b], pa.list_(pa.int64()))], names=[*batch.schema.names[:-1], "lines"])


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages, html last, to the hashes of their lines and, compressed, the lines with their parts; the text is kept of lines
    that the check after the comparison may leave.  No line holds a line feed."""
    for batch in batches:
        hashed, packed = [], []
        for html in batch.columns[-1]:
            lines = page_lines(html.as_py() or "")
            hashed.append([line_hash(t) for _, t in lines])
            left = MAIN if any(part == MAIN for part, _ in lines) else OPEN
            joined = "\n".join(part[0] + (text if part == left else "") for part, text in lines)
            packed.append(bz2.compress(joined.encode("utf-8", "surrogatepass")))
        for a, b in slices([8 * len(h) + len(p) for h, p in zip(hashed, packed)], OUTPUT):
            part = batch.slice(a, b - a)
            found = [pa.array(hashed[a:b], pa.list_(pa.int64())), pa.array(packed[a:b], pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *found], names=[*batch.schema.names[:-1], "lines", "packed"])


def unpack(packed: bytes) -> list[tuple[str, str]]:
    parts = {part[0]: part for part in (MAIN, OPEN, CHROME)}
    text = bz2.decompress(packed).decode("utf-8", "surrogatepass")
    return [(parts[line[0]], line[1:]) for line in text.split("\n") if line]


def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sum, lines, others`` to the places of the lines that stand in a longest common subsequence with the others."""
    for batch in batches:
        same = [shared(lines.as_py(), others.as_py()) for lines, others in zip(batch.column(1), batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.list_(pa.int32()))], names=["sum", "same"])


def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with the places of their shared lines: those are deleted, then the structure of the page is checked."""
    for batch in batches:
        same = [places.as_py() or [] for places in batch.column(3)]
        texts = [main_text(unpack(packed.as_py()), set(places)) for packed, places in zip(batch.column(2), same)]
        for a, b in slices([len(t) for t in texts], OUTPUT):
            part = batch.slice(a, b - a)
            counts = [pa.array([len(x) for x in found[a:b]], pa.int64()) for found in (texts, same)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts[a:b], pa.string()), *counts],
                names=["page_id", "url", "text", "n_chars", "n_shared"],
            )


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common beginning of two texts."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1)


def nearest(lists: DataFrame) -> DataFrame:
    """``sum, other``: for every list of lines the one next to it in the order of host, path and key, if that is on the same host.

    Of the two neighbours the one whose path has the longer common beginning, else the one before.
    """
    order = lists.select("sum", F.struct("host", "path", "key").alias("place"))
    placed = stored(positions(order, "place").select("sum", "place.host", "place.path", F.col("before").alias("at")), "page-order")
    following = placed.select((F.col("at") - 1).alias("at"), F.struct("sum", "host", "path").alias("after"))
    steps = placed.join(following, "at").where(F.col("host") == F.col("after.host"))
    steps = steps.select("sum", F.col("after.sum").alias("after"), common_prefix(F.col("path"), F.col("after.path")).alias("alike"))
    # Every step is a choice for both of its ends.
    ends = [
        F.struct(F.col(own).alias("sum"), F.struct("alike", F.lit(back).alias("back"), F.col(other).alias("other")).alias("choice"))
        for own, other, back in (("sum", "after", 0), ("after", "sum", 1))
    ]
    choices = steps.select(F.explode(F.array(*ends)).alias("end")).select("end.*")
    return choices.groupBy("sum").agg(F.max("choice").alias("choice")).select("sum", "choice.other")


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``, and ``n_shared``, the lines shared with the neighbour.

    Blocks of the main text are joined by one line feed; a null or empty page and one without text give an empty text.
    Pages without an address count as one host.  Pages of a host with equal lines share one place in the order, that of
    their first path, and are compared with the same page of other lines, never with each other.  No rows give no rows;
    further columns are not looked at.
    """
    rows = own_columns(pages, page_id=page_id, url=url, html=html)
    name = F.unhex(F.md5(F.to_json(F.struct("page_id", "url", F.md5(text_of("html")).alias("h")), {"ignoreNullFields": "false"})))
    address = text_of("url")
    host = F.lower(F.regexp_extract(address, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(address, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    kind = rows.schema["page_id"].dataType.simpleString()
    named = rows.select("page_id", "url", name.alias("key"), "html")
    # Written are the hashes only: written texts would lie on the disk twice, as they are dealt to the results as well.
    hashed = named.select("url", "key", "html").mapInArrow(hash_lines, "url string, key binary, lines array<bigint>")
    hashed = stored(hashed.withColumn("sum", F.xxhash64(host, "lines")), "page-lines").select("*", host.alias("host"), path.alias("path"))
    # Equal rows have equal keys, so the smallest place of a list of lines is one of its rows.
    first = F.min(F.struct("path", "key", "host", "lines")).alias("p")
    once = hashed.groupBy("sum").agg(first, F.count(F.lit(1)).alias("_n"))
    alike = stored(once.select("sum", "p.*", "_n"), "line-lists")
    others = alike.select(F.col("sum").alias("other"), F.col("lines").alias("others"))
    compared = nearest(alike).join(others, "other").join(alike.select("sum", "lines"), "sum").select("sum", "lines", "others")
    found = compared.mapInArrow(align, "sum bigint, same array<int>")
    of_list = alike.select("sum", "_n").join(found, "sum", "left")
    parsed = named.mapInArrow(parse, f"page_id {kind}, url string, key binary, lines array<bigint>, packed binary")
    parsed = parsed.select("page_id", "url", "key", "packed", F.xxhash64(host, "lines").alias("sum"))
    joined = spread_join(parsed, of_list, ["sum"], ["key"])
    return joined.select("page_id", "url", "packed", "same").mapInArrow(
        extract, f"page_id {kind}, url string, text string, n_chars bigint, n_shared bigint"
    )
