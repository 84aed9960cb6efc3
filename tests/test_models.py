import random

import pytest
from pyspark.sql import functions as F

from hustings.operators import models
from hustings.operators.ordering import balanced_folds
from hustings.plans import history, template, web
from test_workbooks import write_book

SMALL = {"maxIter": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(4)
    data = [(i, "en" if i % 3 else "de", draw.random(), draw.randrange(5)) for i in range(400)]
    df = spark.createDataFrame([(i, s, x, c, int(x > 0.6)) for i, s, x, c in data], "i int, state string, x double, c int, label int")
    return models.training_rows(balanced_folds(df, ["label"], ["i"]), ["x", "c"], "label", ["i"], partitions=2)


def test_presets(spark):
    main = models.boosted_trees("history")
    assert (main.getMaxIter(), main.getStepSize(), main.getMaxDepth(), main.getSubsamplingRate(), main.getSeed()) == (200, 0.05, 6, 0.8, 42)
    web_trees, template_trees = models.boosted_trees("web"), models.boosted_trees("template", maxIter=9)
    assert (web_trees.getMaxIter(), web_trees.getStepSize(), web_trees.getMaxDepth(), web_trees.getFeatureSubsetStrategy()) == (150, 0.08, 5, "0.8")
    assert (template_trees.getMaxIter(), template_trees.getFeatureSubsetStrategy()) == (9, "all")


def test_fit_score_and_split_counts(rows, spark):
    model = models.fit(rows, models.boosted_trees("web", **SMALL))
    scored = models.score(model, rows)
    assert scored.where((F.col("p_win") < 0) | (F.col("p_win") > 1)).count() == 0 and scored.count() == 400
    right = scored.where(F.col("label") == F.col("prediction")).count()
    assert right > 360
    counts = {r.feature: r.n_splits for r in models.split_counts(model, spark, ["x", "c"]).collect()}
    nodes = sum(t.numNodes for t in model.trees)
    assert sum(counts.values()) == (nodes - len(model.trees)) // 2 and counts["x"] > 0
    labels = {r.outcome for r in scored.select(models.outcome_label().alias("outcome")).collect()}
    assert labels == {"WIN", "LOSS"}


def test_cross_validation_scores_every_row_once(rows):
    scored = models.cross_validate(rows, lambda: models.boosted_trees("history", **SMALL), parallelism=3)
    assert sorted(r.i for r in scored.select("i").collect()) == list(range(400))
    per_fold = models.fold_accuracy(scored)
    values = {r.fold: (r.n_rows, r.accuracy) for r in per_fold.collect()}
    assert sorted(values) == [0, 1, 2, 3, 4] and all(78 <= n <= 82 for n, _ in values.values())
    mean = models.mean_accuracy(per_fold).collect()[0]
    assert mean.mean_accuracy == pytest.approx(sum(a for _, a in values.values()) / 5) and mean.mean_accuracy > 0.9
    curve = models.precision_recall(scored, ["state"]).collect()
    for state in ("en", "de"):
        whole = [r for r in curve if r.state == state]
        lowest = min(whole, key=lambda r: r.threshold)
        hits = scored.where((F.col("state") == state) & (F.col("label") == 1)).count()
        total = scored.where(F.col("state") == state).count()
        assert lowest.recall == 1.0 and lowest.precision == pytest.approx(hits / total)


def test_comparison_and_tuning(rows):
    compared = models.compare_models(rows, models.rival_models(trees=4, **SMALL), "label", folds=2)
    assert {r.model for r in compared.collect()} == {"boosted trees", "random forest", "logistic regression"}
    tuned = models.tune(rows.where(F.col("state") == "en"), [{**SMALL, "stepSize": s} for s in (0.05, 0.1)], "label", folds=2)
    assert len(tuned.collect()) == 2 and "settings" in tuned.columns


@pytest.fixture(scope="module")
def grid(spark):
    draw = random.Random(6)
    head = ["STATE/UT NAME", "AC NO.", "AC NAME", "CANDIDATE NAME", "PARTY", "TOTAL"]
    rows = [("f", "s", 0, head)]
    for ac in range(40):
        for k, party in enumerate(["BJP", "INC", "IND"]):
            votes = str(draw.randrange(1000) + (500 if party == "BJP" else 0))
            rows.append(("f", "s", len(rows), ["KERALA", str(ac), f"AC {ac}", f"C{ac}-{k}", party, votes]))
    return spark.createDataFrame(rows, "source string, sheet string, row_idx bigint, cells array<string>")


def test_history_workflow(grid):
    rows = history.training_table(history.labelled_results(grid))
    assert history.validate(rows, **SMALL).count() == 5
    model, outcomes = history.outcomes(rows, **SMALL)
    assert outcomes.count() == 120 and model.getNumTrees == 3
    assert {r.outcome for r in outcomes.collect()} <= {"WIN", "LOSS"}
    _, single = history.outcomes(rows, mode="argmax", **SMALL)
    wins = single.where(F.col("outcome") == "WIN").groupBy("constituency_no").count().collect()
    assert len(wins) == 40 and {r["count"] for r in wins} == {1}


def test_template_workflow(grid, spark):
    head = ["Constituency", "State/UT", "Party", "Predicted Outcome (W/L/O)"]
    rows = [("t", "Kerala", 0, head)]
    for ac in range(12):
        for party in ("BJP", None, "NEW"):
            rows.append(("t", "Kerala", len(rows), [f"AC {ac}" if ac else None, "kerala", party, None]))
    sheet = spark.createDataFrame(rows, "source string, sheet string, row_idx bigint, cells array<string>")
    predicted = template.predict_template(history.labelled_results(grid), template.template_records(sheet), partitions=2, **SMALL)
    got = predicted.collect()
    assert len(got) == 36 and all(0 <= r.p_win <= 1 for r in got)
    winners = [r.constituency for r in got if r.outcome == "W"]
    assert sorted(winners) == sorted(f"AC {ac}" for ac in range(1, 12))
    cells = {r.row_idx: r.cells for r in template.filled_template(sheet, predicted).collect()}
    assert cells[0] == head and all(cells[r.row_idx][3] == r.outcome for r in got)


def test_web_workflow(spark):
    page = (
        '<table id="table1"><tr><th>Candidate</th><th>Constituency</th><th>Party</th><th>Criminal Case</th>'
        "<th>Education</th><th>Total Assets</th></tr>{}</table>"
    )
    row = "<tr><td>c{0}</td><td>AC {1}</td><td>{2}</td><td>{3}</td><td>E{3}</td><td>Rs {4}</td></tr>"
    pages = [
        (f"s{p}2021", page.format("".join(row.format(i, i % 9, ["BJP", "IND"][i % 2], i % 3, 100 * i + p) for i in range(40))))
        for p in range(4)
    ]
    rows = web.training_table(web.candidates_from_pages(spark.createDataFrame(pages, "source string, html string")))
    assert rows.count() == 160 and web.validate(rows, **SMALL).count() == 5
    assert {r.outcome for r in web.outcomes(rows, **SMALL).collect()} == {"WIN", "LOSS"}
    single = web.outcomes(rows, mode="argmax", **SMALL).where(F.col("outcome") == "WIN")
    assert {r["count"] for r in single.groupBy("state", "constituency").count().collect()} == {1} and single.count() == 36


def test_runs_from_files_to_files(spark, tmp_path):
    draw = random.Random(8)
    head = ["STATE/UT NAME", "AC NO.", "AC NAME", "CANDIDATE NAME", "PARTY", "TOTAL"]
    body = [["KERALA", ac, f"AC {ac}", f"C{ac}-{p}", p, draw.randrange(1, 900)] for ac in range(1, 21) for p in ("BJP", "INC", "IND")]
    (tmp_path / "data").mkdir()
    write_book(tmp_path / "data" / "kerala.xlsx", {"Results": [["Title"], head, *body]})
    titles = ["Sno", "Constituency", "State/UT", "Party", "Candidate", "Predicted Outcome (W/L/O)"]
    future = [[i, f"AC {i // 2}", "Kerala", ["BJP", "NEW"][i % 2], f"F{i}", None] for i in range(2, 22)]
    write_book(tmp_path / "data" / "Submission Template.xlsx", {"Kerala": [titles, *future], "Notes": [["n"]]})
    accuracy = history.run(spark, str(tmp_path / "data"), str(tmp_path / "submission"), **SMALL)
    assert accuracy.count() == 5
    written = spark.read.parquet(str(tmp_path / "submission"))
    assert written.columns == ["state", "constituency", "candidate", "party", "outcome"] and written.count() == 60
    template.run(spark, str(tmp_path / "data"), str(tmp_path / "data" / "Submission Template.xlsx"), str(tmp_path / "out"), **SMALL)
    filled = spark.read.parquet(str(tmp_path / "out" / "filled")).collect()
    wins = [r.cells[1] for r in filled if r.cells[5] == "W"]
    assert len(filled) == 21 and sorted(wins) == sorted({r[1] for r in future})
    states = spark.read.option("header", True).csv(str(tmp_path / "out" / "states"))
    assert {r.part_state for r in states.select("part_state").distinct().collect()} == {"Kerala"} and states.count() == 20
    assert states.columns == [*titles, "part_state"]
    assert {r.Candidate for r in states.collect()} == {f[4] for f in future}
    best = [r for r in states.collect() if r[titles[5]] == "W"]
    assert len(best) == len({r.Constituency for r in best}) == len({f[1] for f in future})
    reasons = history.left_out(spark, str(tmp_path / "data")).collect()
    assert [r.reason for r in reasons] == []


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    import sys

    from hustings.__main__ import main

    page = '<table id="table1"><tr><th>Candidate</th><th>Constituency</th><th>Party</th><th>Assets</th></tr>{}</table>'
    cells = "<tr><td>c{0}</td><td>AC {1}</td><td>{2}</td><td>Rs {0}</td></tr>"
    html = page.format("".join(cells.format(i, i % 4, ["BJP", "IND"][i % 2]) for i in range(60)))
    spark.createDataFrame([("kerala2021", html)], "source string, html string").write.parquet(str(tmp_path / "pages"))
    monkeypatch.setitem(models.PRESETS, "web", {**models.PRESETS["web"], **SMALL})
    monkeypatch.setattr(sys, "argv", ["hustings", "--mode", "argmax", "web", str(tmp_path / "pages"), str(tmp_path / "out")])
    main()
    assert "accuracy" in capsys.readouterr().out
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 60 and written.where("outcome = 'WIN'").count() == 4


def test_the_chosen_model_is_fitted_on_all_rows(rows):
    grid = models.parameter_grid(maxDepth=[1, 3], stepSize=[0.05, 0.1])
    assert grid == [{"maxDepth": d, "stepSize": s} for d in (1, 3) for s in (0.05, 0.1)]
    best, table = models.select_model(rows, models.boosted_trees("history", maxIter=2), grid, "label", parallelism=4)
    found = {r.settings: r for r in table.collect()}
    assert list(found) == [f"maxDepth={d}, stepSize={s}" for d in (1, 3) for s in (0.05, 0.1)]
    chosen = [r for r in found.values() if r.chosen]
    assert len(chosen) == 1 and chosen[0].mean_accuracy == max(r.mean_accuracy for r in found.values())
    assert chosen[0].settings == f"maxDepth={best.getOrDefault('maxDepth')}, stepSize={best.getOrDefault('stepSize')}"
    again = models.fit(rows, models.boosted_trees("history", maxIter=2, maxDepth=best.getOrDefault("maxDepth"), stepSize=best.getOrDefault("stepSize")))
    assert [r.p_win for r in models.score(best, rows).orderBy("i").collect()] == [r.p_win for r in models.score(again, rows).orderBy("i").collect()]
    assert all(r.deviation >= 0 for r in found.values())


def average_precision(pairs):
    """Over distinct scores from the top, by definition."""
    area, taken, right, hits = 0.0, 0, 0, sum(h for _, h in pairs)
    for score in sorted({s for s, _ in pairs}, reverse=True):
        here = [h for s, h in pairs if s == score]
        taken, right = taken + len(here), right + sum(here)
        area += right / taken * sum(here) / hits if hits else 0
    return area if hits else None


def test_exact_precision_recall(frame):
    draw = random.Random(9)
    data = [(draw.choice(["big", "big", "big", "a", None, "none"]), round(draw.random(), draw.choice([1, 2, 5])), int(draw.random() < 0.4)) for _ in range(3000)]
    data = [(s, x, 0 if s == "none" else h) for s, x, h in data] + [("a", 0.0, 1), ("a", -0.0, 0)]
    rows = data + [("a", None, 1), ("a", float("nan"), 1), ("a", 0.5, None), ("gone", None, 1)]
    df = frame(rows, "state string, p_win double, label int")
    got = {r.state: r for r in models.precision_recall_area(df, ["state"]).collect()}
    assert set(got) == {"big", "a", None, "none"}
    for state, r in got.items():
        own = [(x, h) for s, x, h in data if s == state]
        assert (r.n_rows, r.n_hits) == (len(own), sum(h for _, h in own))
        want = average_precision(own)
        assert r.area == (want if want is None else pytest.approx(want, abs=1e-9))
    for r in models.precision_recall_points(df, ["state"]).collect():
        taken = [h for s, x, h in data if s == r.state and x >= r.threshold]
        assert r.precision == sum(taken) / len(taken)
        assert r.recall is None if r.state == "none" else r.recall == sum(taken) / got[r.state].n_hits
    whole = models.precision_recall_area(df, []).collect()
    assert len(whole) == 1 and whole[0].area == pytest.approx(average_precision([(x, h) for _, x, h in data]), abs=1e-9)
    assert models.precision_recall_area(df.limit(0), ["state"]).collect() == []
