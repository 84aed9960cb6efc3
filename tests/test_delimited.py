"""Records over several lines against a reader that goes character by character."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from hustings.sources.delimited import opens, records
from hustings.sources.grids import read_delimited

LINES = "source string, _split bigint, _seq bigint, value string"


def plain_records(lines, separator=","):
    """Joined lines, by a walk over the characters; a quote opens only at the beginning of a cell."""
    text, out, start, inside, fresh, i = "\n".join(lines), [], 0, False, True, 0
    while i < len(text):
        c = text[i]
        if inside and c == '"':
            if text[i + 1 : i + 2] == '"':
                i += 1
            else:
                inside = False
        elif not inside and c == '"' and fresh:
            inside = True
        elif not inside and c == "\n":
            out.append(text[start:i])
            start = i + 1
        fresh = not inside and (c == separator or c == "\n")
        i += 1
    return [*out, *(text[start:].split("\n") if inside else [text[start:]])]


def some_files(seed, files, letters, separator=","):
    rng = random.Random(seed)
    rows, want, seq = [], {}, 0
    for f in range(files):
        lines = ["".join(rng.choices(letters, k=rng.randrange(7))) for _ in range(rng.randrange(1, 25))]
        want |= {(f"f{f}", i): r for i, r in enumerate(plain_records(lines, separator))}
        split = 0
        for line in lines:
            if rng.random() < 0.3:
                split, seq = split + 100, seq + 1000
            rows.append((f"f{f}", split, seq, line))
            seq += 1
        seq += 1000
    return rows, want


@pytest.mark.parametrize("letters, separator", [('a",', ","), ('"', ","), ('ab" ,,', ","), ('a"";', ";"), ('"|x', "|")])
def test_records_of_random_files(spark, frame, letters, separator):
    rows, want = some_files(letters, 150, letters, separator)
    lines = frame(rows, LINES).withColumns({"open0": opens(F.col("value"), separator, False), "open1": opens(F.col("value"), separator, True)})
    got = records(lines).collect()
    assert {(r.source, r.row_idx): r.value for r in got} == want and len(got) == len(want)


def test_well_formed_files_read_as_the_standard_library_does(spark, tmp_path):
    rng = random.Random(3)
    want = [["".join(rng.choices('ab," \né', k=rng.randrange(1, 9))) + "." for _ in range(3)] for _ in range(3000)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(want)
    (tmp_path / "one.csv").write_text(out.getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.row_idx for r in got] == list(range(3000)) and [r.cells for r in got] == want


def test_a_quote_that_is_never_closed_joins_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,"1\n2",y\n"open,z\nmore,q\nlast\n')
    got = read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [(r.row_idx, r.cells[0]) for r in got] == [(0, "x"), (1, "open"), (2, "more"), (3, "last")]
    assert got[0].cells == ["x", "1\n2", "y"]


def test_very_long_lines(column):
    values = ['"a",' * 100_000, "b," * 100_000 + '"', '"' + '""' * 100_000, "x" * 400_000 + '",']
    assert column(lambda c: opens(c, ",", False), values) == [False, True, True, False]
    assert column(lambda c: opens(c, ",", True), values[1:]) == [False, False, False]
