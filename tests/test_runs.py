"""Workflows from files to files: run again, told what was left out, every source opened once, models kept."""

import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from hustings.operators import models
from hustings.operators.features import RESULT_FEATURES
from hustings.plans import history, template, web
from hustings.sources.grids import read_files
from hustings.sources.sinks import check_target, write_by_state
from test_workbooks import write_book

SMALL = {"maxIter": 2, "maxDepth": 3}
HEAD = ["STATE/UT NAME", "AC NO.", "AC NAME", "CANDIDATE NAME", "PARTY", "TOTAL"]
TITLES = ["Sno", "Constituency", "State/UT", "Party", "Candidate", "Predicted Outcome (W/L/O)"]


def results(state, n=20, seed=8):
    draw = random.Random(seed)
    return [[state, ac, f"AC {ac}", f"C{ac}-{p}", p, draw.randrange(1, 900)] for ac in range(1, n + 1) for p in ("BJP", "INC", "IND")]


def future(state, n=12):
    return [TITLES, *[[i, f"AC {i // 2}", state, ["BJP", "NEW"][i % 2], f"F{i}", None] for i in range(2, n)]]


@pytest.fixture
def folder(tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    write_book(data / "kerala.xlsx", {"Results": [["Title"], HEAD, *results("KERALA")], "Notes": [["nothing"]]})
    write_book(data / "assam.xlsx", {"Results": [HEAD[:5], *[r[:5] for r in results("ASSAM", 4)]]})
    (data / "broken.xlsx").write_bytes(b"no archive")
    write_book(data / "Submission Template.xlsx", {"Kerala": future("Kerala"), "Assam": [["Sno", "State"], [1, "Assam"]]})
    return data


def reasons(df):
    found = [(r.source and r.source.rpartition("/")[2].replace("%20", " "), r.sheet, r.reason) for r in df.collect()]
    return sorted(found, key=lambda f: [x or "" for x in f])


def test_history_tells_what_it_left_out(spark, folder, tmp_path):
    done = history.process(spark, str(folder), str(tmp_path / "out"), mode="argmax", **SMALL)
    found = reasons(done.left_out)
    assert [f[:2] for f in found] == [("assam.xlsx", "Results"), ("broken.xlsx", None), ("kerala.xlsx", "Notes")]
    assert found[0][2] == "no column total_votes_raw" and "BadZipFile" in found[1][2] and found[2][2] == "no header row"
    assert done.counts == {"rows": 62 + 1 + 13, "problems": 1}
    assert {(r.win, r.n) for r in done.balance.collect()} == {(1, 20), (0, 40)} and done.accuracy.count() == 5
    assert {r.feature for r in done.splits.collect()} == set(RESULT_FEATURES)
    assert spark.read.parquet(str(tmp_path / "out")).where("outcome = 'WIN'").count() == 20


def test_sources_are_opened_once(spark, folder):
    """Whatever follows the reading works without the files."""
    labelled, left_out, counts = history.read_results(spark, str(folder))
    read = read_files(spark, str(folder), glob="*", without_part=None)
    shutil.rmtree(folder)
    assert labelled.count() == 60 and left_out.count() == 3 and counts["problems"] == 1
    assert read.problems.count() == 1 and read.grid.where("sheet = 'Kerala'").count() == 11


EVENTS = """
import sys
from hustings.session import local_session
from hustings.plans import history
from pyspark.sql import SparkSession
folder, work = sys.argv[1:]
spark = SparkSession.builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", work).config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setCheckpointDir(work + "/shared")
history.process(spark, folder, work + "/out", "csv", maxIter=1, maxDepth=2)
spark.stop()
"""


def test_event_log_shows_one_scan_of_the_folder(tmp_path):
    import json

    data, work = tmp_path / "data", tmp_path / "work"
    data.mkdir()
    work.mkdir()
    for state in ("Kerala", "Assam"):
        lines = [",".join(map(str, r)) for r in [HEAD, *results(state)]]
        (data / f"{state}.csv").write_text("\n".join(lines) + "\n")
    root = str(Path(__file__).parents[1])
    subprocess.run([sys.executable, "-c", EVENTS, str(data), str(work)], cwd=root, check=True, timeout=300, capture_output=True)
    scans = set()
    for log in work.glob("*local-*"):
        for line in log.open():
            event = json.loads(line)
            plan = event.get("physicalPlanDescription", "")
            if event["Event"].endswith("SQLExecutionStart") and str(data) in plan and "Scan text" in plan:
                scans.add(event["executionId"])
    assert len(scans) == 1


def test_template_tells_what_it_left_out_and_runs_again(spark, folder, tmp_path):
    book, out = str(folder / "Submission Template.xlsx"), str(tmp_path / "out")
    done = template.process(spark, str(folder), book, out, sheets=["Kerala", "Assam", "Punjab"], **SMALL)
    found = reasons(done.left_out)
    assert ("Submission Template.xlsx", "Assam", "no column constituency") in found
    assert (None, "Punjab", "no such sheet") in found and any("BadZipFile" in f[2] for f in found)
    with pytest.raises(FileExistsError, match="already exists"):
        template.process(spark, "/nowhere", "/nowhere/too", out)
    # The second run has another state and replaces only what it holds.
    write_book(folder / "Submission Template.xlsx", {"Tamil Nadu": future("Tamil Nadu", 6)})
    template.process(spark, None, book, out, sheets=["Tamil Nadu"], overwrite=True, model=done.model)
    states = {r.part_state: r["count"] for r in spark.read.option("header", True).csv(f"{out}/states").groupBy("part_state").count().collect()}
    assert states == {"Kerala": 10, "Assam": 1, "Tamil Nadu": 4}
    assert spark.read.parquet(f"{out}/filled").count() == 5


def test_states_are_replaced_one_by_one(frame, spark, tmp_path):
    path = str(tmp_path / "out")
    write_by_state(frame([("K", 1), ("K", 2), ("L", 3)], "state string, n int"), path, ["n"], mode=check_target(spark, path))
    with pytest.raises(FileExistsError):
        check_target(spark, path)
    write_by_state(frame([("K", 9)], "state string, n int"), path, ["n"], mode=check_target(spark, path, True))
    got = spark.read.option("header", True).csv(path).collect()
    assert sorted((r.state, r.n) for r in got) == [("K", "9"), ("L", "3")]


def test_target_is_checked_before_the_fits(spark, folder, tmp_path, monkeypatch):
    (tmp_path / "out").mkdir()
    monkeypatch.setattr(history, "read_results", lambda *a, **k: pytest.fail("read before the check"))
    with pytest.raises(FileExistsError):
        history.process(spark, str(folder), str(tmp_path / "out"))
    with pytest.raises(FileExistsError):
        web.process(spark.createDataFrame([("a", "b")], "source string, html string"), str(tmp_path / "out"))


PAGE = '<table id="table1"><tr><th>Candidate</th><th>Constituency</th><th>Party</th><th>Assets</th></tr>{}</table>'
CELLS = "<tr><td>c{0}</td><td>AC {1}</td><td>{2}</td><td>Rs {0}</td></tr>"


def test_equal_pages_of_a_source_give_one_winner(spark, frame, tmp_path):
    html = PAGE.format("".join(CELLS.format(i, i % 4, ["BJP", "IND"][i % 2]) for i in range(60)))
    pages = frame([("kerala2021", html), ("kerala2021", html), ("assam2021", html), ("x", "<p>none</p>")], "source string, html string")
    done = web.process(pages, str(tmp_path / "out"), "argmax", **SMALL)
    got = done.predicted.collect()
    assert len(got) == 120 and len({(r.source, r.page, r.row_idx) for r in got}) == 120
    wins = [(r.state, r.constituency) for r in got if r.outcome == "WIN"]
    assert len(wins) == len(set(wins)) == 8
    assert [(r.source, r.reason) for r in done.left_out.collect()] == [("x", "candidate table not found")]
    assert sum(r.n for r in done.balance.collect()) == 120


def test_command_line_keeps_and_uses_a_model(spark, folder, tmp_path, monkeypatch, capsys):
    from hustings.__main__ import main

    monkeypatch.setitem(models.PRESETS, "history", {**models.PRESETS["history"], **SMALL})
    command = ["hustings", "--mode", "argmax", "--save-model", str(tmp_path / "model"), "history", str(folder), str(tmp_path / "out")]
    monkeypatch.setattr(sys, "argv", command)
    main()
    told = capsys.readouterr().out
    assert "no header row" in told and "mean_accuracy" in told and "n_splits" in told and "76 rows" in told
    first = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    monkeypatch.setattr(sys, "argv", ["hustings", "--overwrite", "--load-model", str(tmp_path / "model"), "history", str(folder), str(tmp_path / "out")])
    main()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == first and len(first) == 60
