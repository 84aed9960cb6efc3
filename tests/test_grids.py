import pytest
from pyspark.errors import PySparkException

from hustings.plans.history import labelled_results
from hustings.sources.grids import (
    RESULT_COLUMNS,
    exact_places,
    exact_position,
    find_headers,
    promote,
    read_delimited,
    rejected,
    result_records,
    select_sheets,
    source_state,
    union_sources,
)

GRID = "source string, sheet string, row_idx bigint, cells array<string>"
HEADER = ["STATE/UT NAME", "AC NO.", "AC NAME", "CANDIDATE NAME", "PARTY", "TOTAL"]
BODY = [
    ["kerala", "1", "P", "A ONE", "BJP", "100"],
    ["kerala", "1", "P", "A TWO", "INC", "100"],
    ["kerala", "1", "P", "A THREE", "IND", "1,234"],
    ["kerala", "1", "P", "NOTA", "NOTA", "5"],
    ["kerala", "1", "P", None, None, "705"],
    ["kerala", "2", "Q", "B ONE", "AGP", None],
    ["kerala", "3", "R", "C ONE", "X", "abc"],
    ["kerala", "3", "R", "C TWO", "Y", "n.a"],
    ["kerala", None, "S", "D ONE", "X", "9"],
]
BROAD = ["kerala", "1", "P", "None of the Above", None, "500"]


def sheet(source, rows, first=0):
    return [(source, "s", first + i, r) for i, r in enumerate(rows)]


def two_files(frame, *extra):
    """The second file has its header in row 0 and its columns in another order."""
    other = [[HEADER[i] for i in (0, 5, 3, 1, 2, 4)], ["ASSAM", "7", "E ONE", "1", "Z", "AGP"]]
    k = sheet("k", [["Title"], [None], HEADER, *BODY, *extra])
    return frame(k + sheet("a", other), GRID)


def wins(df):
    return {(r.source, r.candidate): r.win for r in df.collect()}


def test_winners_without_the_broad_row(frame):
    for broad in (True, False):
        got = wins(labelled_results(two_files(frame), broad))
        assert got == {
            ("k", "A ONE"): 1, ("k", "A TWO"): 1, ("k", "A THREE"): 0, ("k", "C ONE"): 1, ("k", "C TWO"): 1,
            ("k", "D ONE"): None, ("a", "E ONE"): 1,
        }


def test_none_of_the_above_wins_only_under_the_exact_filter(frame):
    grid = two_files(frame, BROAD)
    exact, broad = wins(labelled_results(grid, broad=False)), wins(labelled_results(grid))
    assert exact[("k", "None of the Above")] == 1 and exact[("k", "A ONE")] == 0
    assert ("k", "None of the Above") not in broad and broad[("k", "A ONE")] == 1


def test_state_names_are_tidied(frame):
    states = {r.state for r in labelled_results(two_files(frame)).collect()}
    assert states == {"Kerala", "Assam"}


def test_header_is_the_first_exact_match(frame):
    rows = [["STATE/UT NAME "], ["x", "STATE/UT NAME"], HEADER, HEADER, BODY[0]]
    head = find_headers(frame(sheet("k", rows), GRID)).collect()[0]
    assert head.header_idx == 2 and head._n == 5


def test_missing_header_skips_falls_back_or_fails(frame):
    grid = frame(sheet("k", [["t"], [None], ["State", *HEADER[1:]], BODY[0]]), GRID)
    assert result_records(grid).count() == 0
    rows = result_records(grid, fallback=2).collect()
    assert [(r.candidate, r.state) for r in rows] == [("A ONE", None)]
    with pytest.raises(PySparkException, match="no header row in k/s"):
        result_records(grid, strict=True).collect()


def test_marker_beats_fallback(frame):
    grid = frame(sheet("k", [["t"], [None], ["other"], ["u"], HEADER, BODY[0]]), GRID)
    assert find_headers(grid, fallback=2).collect()[0].header_idx == 4


def test_sources_lacking_the_key_column_are_reported(frame):
    grid = frame(sheet("k", [HEADER, BODY[0]]) + sheet("x", [["STATE/UT NAME", "TOTAL"], ["a", "1"]]) + sheet("y", [["q"]]), GRID)
    headers = find_headers(grid)
    reasons = {r.source: r.reason for r in rejected(headers, exact_places(RESULT_COLUMNS), ["constituency"]).collect()}
    assert reasons == {"x": "no column constituency", "y": "no header row"}
    assert {r.source for r in result_records(grid).collect()} == {"k"}


def test_first_existing_alias_wins_even_if_its_cells_are_null(frame):
    grid = frame(sheet("k", [["M", "State", "State/UT"], ["m", "b", None], ["m", "c", "d"]]), GRID)
    records = promote(grid, find_headers(grid, "M"), {"state": exact_position(["State/UT", "State"])})
    assert sorted((r.state for r in records.collect()), key=str) == [None, "d"]


def test_absent_sheets_add_nothing(frame):
    grid = frame([("f", "A", 0, ["x"]), ("f", "B", 0, ["y"])], GRID)
    assert {r.sheet for r in select_sheets(grid, ["A", "Z"]).collect()} == {"A"}


def test_union_by_name_and_source_state(frame, spark):
    one, two = frame([(1, "x")], "a int, b string"), frame([("y", 2.0)], "b string, c double")
    assert sorted((tuple(r) for r in union_sources([one, two]).collect()), key=str) == [(1, "x", None), (None, "y", 2.0)]
    from pyspark.sql import functions as F

    df = frame([("westbengal2021",), ("Puducherry2021",), ("file:/a.b/Goa2021.csv",)], "s string").select(source_state(F.col("s")))
    assert [r[0] for r in df.collect()] == ["westbengal", "Puducherry", "Goa"]


@pytest.fixture
def files(tmp_path):
    def write(name, lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    write("kerala.csv", ["Results,,", '"STATE/UT NAME",AC NO.,"AC ""NAME"""', 'Kerala,1,"a, b"', "Kerala,,NA"])
    write("assam.csv", [f"r{i},{i}" for i in range(20_000)])
    write("~$lock.csv", ["lock"])
    write("Submission Template.csv", ["template"])
    write("notes.txt", ["note"])
    return str(tmp_path)


def test_delimited_files(spark, files):
    grid = read_delimited(spark, files)
    assert {r.source.rpartition("/")[2] for r in grid.select("source").distinct().collect()} == {"kerala.csv", "assam.csv"}
    rows = grid.where("sheet = 'kerala'").orderBy("row_idx").collect()
    assert [r.cells for r in rows] == [
        ["Results", None, None], ["STATE/UT NAME", "AC NO.", 'AC "NAME"'], ["Kerala", "1", "a, b"], ["Kerala", None, None],
    ]
    assert rows[0].sheet == "kerala"
    everything = read_delimited(spark, files, without_prefix=None, without_part=None)
    assert everything.select("source").distinct().count() == 4


def test_row_numbers_hold_across_file_splits(spark, files):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        grid = read_delimited(spark, files).where("sheet = 'assam'")
        assert grid.rdd.getNumPartitions() > 1
        wrong = grid.where("cells[1] <> cast(row_idx as string) or cells[0] <> concat('r', row_idx)")
        assert wrong.count() == 0 and grid.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_survive_a_change_of_splits(spark, files):
    """Settings that cut files elsewhere, changed between building and running, change nothing."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")}
    grid = read_delimited(spark, files)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        spark.conf.set("spark.sql.files.minPartitionNum", "64")
        assert grid.where("sheet = 'assam'").count() == 20_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)


def test_empty_cells_stay_in_their_column(column):
    from hustings.sources.grids import split_cells

    lines = [",a,b", ",,x", "", "a,", ",", ',"b, c",', '"",x', '"a ""q""",,"z"']
    want = [["", "a", "b"], ["", "", "x"], [""], ["a", ""], ["", ""], ["", "b, c", ""], ["", "x"], ['a "q"', "", "z"]]
    assert column(split_cells, lines) == want
    assert column(lambda c: split_cells(c, "|"), ["|a||b"]) == [["", "a", "", "b"]]


def test_files_of_one_name_in_different_folders_are_different_sheets(spark, tmp_path):
    for state, winner in (("Kerala", "K"), ("Assam", "A")):
        (tmp_path / state).mkdir()
        rows = [HEADER, [state, "1", "P", f"{winner} one", "X", "10"], [state, "1", "P", f"{winner} two", "Y", "9"]]
        (tmp_path / state / "results.csv").write_text("\n".join(",".join(r) for r in rows) + "\n")
    got = labelled_results(read_delimited(spark, f"{tmp_path}/*"))
    assert {r.candidate: r.win for r in got.collect()} == {"K one": 1, "K two": 0, "A one": 1, "A two": 0}
