import pytest

from hustings.plans.template import template_records
from hustings.sources.sinks import OUTCOME_TITLE, fill_template, outcome_places, project_existing, write_by_state, write_grid, write_submission

GRID = "source string, sheet string, row_idx bigint, cells array<string>"


def test_submission_round_trip(frame, spark, tmp_path):
    df = frame([("K", "P", "a", "WIN", 1)], "state string, constituency string, candidate string, outcome string, extra int")
    assert project_existing(df, ["outcome", "party", "state"]).columns == ["outcome", "state"]
    for fmt in ("parquet", "csv"):
        write_submission(df, str(tmp_path / fmt), fmt)
        back = spark.read.format(fmt).option("header", True).load(str(tmp_path / fmt))
        assert [r.asDict() for r in back.collect()] == [{"state": "K", "constituency": "P", "candidate": "a", "outcome": "WIN"}]


def test_one_folder_per_state_in_order(frame, spark, tmp_path):
    rows = [("West Bengal" if i % 3 else "Tamil/Nadu", i) for i in range(500)]
    path = str(tmp_path / "out")
    write_by_state(frame(rows, "state string, row_idx int").repartition(3), path, ["row_idx"], rows_per_file=100)
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["part_state=Tamil%2FNadu", "part_state=West Bengal"]
    back = spark.read.option("header", True).csv(path)
    assert sorted((r.state, int(r.row_idx)) for r in back.collect()) == sorted(rows)
    for file in (tmp_path / "out" / folders[1]).glob("*.csv"):
        numbers = [int(line.split(",")[1]) for line in file.read_text().splitlines()[1:]]
        assert numbers == sorted(numbers) and len(numbers) <= 100
    with pytest.raises(Exception, match="already exists"):
        write_by_state(frame(rows, "state string, row_idx int"), path, ["row_idx"])


def test_template_fill_touches_only_the_outcome_column(frame):
    rows = [
        ("f", "named", 0, ["Title", None, None]),
        ("f", "named", 1, ["Constituency", OUTCOME_TITLE, "Note"]),
        ("f", "named", 2, ["P", "?", "n1"]),
        ("f", "named", 3, ["P", None, "n2"]),
        ("f", "plain", 0, ["Constituency", "Party"]),
        ("f", "plain", 1, ["Q", "X"]),
        ("f", "other", 0, ["left", "alone"]),
    ]
    grid = frame(rows, GRID)
    places = {r.sheet: (r.outcome_row, r.outcome_column) for r in outcome_places(grid).collect()}
    assert places == {"named": (1, 2), "plain": (0, 6), "other": (0, 6)}
    outcomes = frame([("f", "named", 2, "W"), ("f", "named", 3, "L"), ("f", "plain", 1, "W")], "source string, sheet string, row_idx bigint, outcome string")
    got = {(r.sheet, r.row_idx): r.cells for r in fill_template(grid, outcomes).collect()}
    assert got == {
        ("named", 0): ["Title", None, None], ("named", 1): ["Constituency", OUTCOME_TITLE, "Note"],
        ("named", 2): ["P", "W", "n1"], ("named", 3): ["P", "L", "n2"],
        ("plain", 0): ["Constituency", "Party"], ("plain", 1): ["Q", "X", None, None, None, "W"],
        ("other", 0): ["left", "alone"],
    }


def test_template_records_use_the_row_naming_the_outcome(frame):
    rows = [
        ("f", "Kerala", 0, ["Title"]), ("f", "Kerala", 1, ["Constituency", "State/UT", "Party", OUTCOME_TITLE]),
        ("f", "Kerala", 2, ["P", "Kerala", "X", None]), ("f", "Assam", 0, ["Constituency_Name", "State", "Party"]),
        ("f", "Assam", 1, ["Q", "Assam", "Y"]), ("f", "Notes", 0, ["x"]), ("f", "Notes", 1, ["y"]),
    ]
    got = {(r.sheet, r.row_idx, r.constituency, r.state, r.party) for r in template_records(frame(rows, GRID)).collect()}
    assert got == {("Kerala", 2, "P", "Kerala", "X"), ("Assam", 1, "Q", "Assam", "Y")}


def test_grids_are_written_in_row_order(frame, spark, tmp_path):
    rows = [("f", "s", i, [str(i)]) for i in range(50)]
    write_grid(frame(rows[::-1], GRID), str(tmp_path / "g"))
    assert sorted(r.row_idx for r in spark.read.parquet(str(tmp_path / "g")).collect()) == list(range(50))
