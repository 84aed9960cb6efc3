"""Encoders and whole pipelines that are saved and loaded."""

import json
import subprocess
import sys
from pathlib import Path

from pyspark.ml import Pipeline, PipelineModel

from hustings.operators.encoding import SafeEncoder, SafeEncoderModel, closed_encoder
from hustings.operators.stages import CleanCandidates, MajorFlag, Outcomes, StandInLabel
from hustings.plans import template, web

SMALL = {"maxIter": 2, "maxDepth": 3}
ELSEWHERE = """
import json, sys
from hustings.session import local_session
from hustings.operators.encoding import SafeEncoderModel
spark = local_session(2, 2)
spark.sparkContext.setCheckpointDir(sys.argv[2])
model = SafeEncoderModel.load(sys.argv[1])
rows = model.transform(spark.createDataFrame([("a",), (None,), ("new",), ("b",), ("Z",)], "party string")).collect()
print(json.dumps({str(r.party): r.code for r in rows}))
"""


def test_an_encoder_is_loaded_in_another_session(frame, tmp_path):
    train, more = frame([("b",), ("a",), (None,)], "party string"), frame([("Z",)], "party string")
    encoder = SafeEncoder(inputCols=["party"], outputCols=["code"], template=more, rowId=["i"], broadcastRows=7)
    encoder.save(f"{tmp_path}/encoder")
    again = SafeEncoder.load(f"{tmp_path}/encoder")
    assert again.uid == encoder.uid and (again.row_id, again.broadcast_rows, again.getInputCols()) == (["i"], 7, ["party"])
    model = again.fit(train)
    model.save(f"{tmp_path}/model")
    assert SafeEncoderModel.load(f"{tmp_path}/model").row_id == ["i"]
    root = str(Path(__file__).parents[1])
    out = subprocess.run(
        [sys.executable, "-c", ELSEWHERE, f"{tmp_path}/model", f"{tmp_path}/work"], cwd=root, capture_output=True, text=True, timeout=120, check=True
    )
    assert json.loads(out.stdout.splitlines()[-1]) == {"a": 2, "None": 0, "new": 0, "b": 3, "Z": 1}


def test_a_closed_encoder_gives_unseen_values_a_code_of_their_own(frame, tmp_path):
    model = closed_encoder({"e": "code"}, ["i"]).fit(frame([("x", 1), (None, 2), ("a", 3)], "e string, i int"))
    model.save(f"{tmp_path}/closed")
    got = SafeEncoderModel.load(f"{tmp_path}/closed").transform(frame([("new", 1), (None, 2), ("a", 3)], "e string, i int"))
    assert {r.i: r.code for r in got.collect()} == {1: 3, 2: 1, 3: 0}


def test_stages_keep_their_parameters(frame, tmp_path):
    stages = [CleanCandidates(), MajorFlag(names=["BJP"], anyCase=False), StandInLabel(rowId=["i"])]
    df = frame([(i, "c", f"Rs {i}", ["BJP", "bjp"][i % 2]) for i in range(9)], "i int, candidate string, total_assets string, party string")
    model = Pipeline(stages=stages).fit(df)
    model.save(f"{tmp_path}/stages")
    kept = PipelineModel.load(f"{tmp_path}/stages")
    assert kept.transform(df).orderBy("i").collect() == model.transform(df).orderBy("i").collect()
    assert kept.stages[2].getOrDefault("median") == 4.0
    rich = kept.transform(frame([(1, "c", "Rs 5", "BJP"), (2, "c", "Rs 4", "x")], df.schema.simpleString()[7:-1].replace(":", " "))).collect()
    assert [(r.is_major_party, r.proxy) for r in rich] == [(1, 1), (0, 0)]
    nothing = StandInLabel(rowId=["i"]).fit(frame([], "i int, assets_numeric double"))
    assert not nothing.isDefined("median")
    outcome = Outcomes(contest=["k"], rowId=["i"], win="W", lose="L")
    outcome.save(f"{tmp_path}/outcome")
    assert Outcomes.load(f"{tmp_path}/outcome").getOrDefault("contest") == ["k"]


def test_a_kept_web_pipeline_scores_other_pages(spark, frame, tmp_path):
    def rows(first, n):
        return [("p", "h", i, f"c{i}", f"AC {i % 7}", ["BJP", "IND", None][i % 3], str(i % 2), "E", f"Rs {10 * i}", "K") for i in range(first, first + n)]

    ddl = "source string, page string, row_idx bigint, candidate string, constituency string, party string, criminal_cases string, education string, total_assets string, state string"
    model = web.fit_pipeline(frame(rows(0, 60), ddl), "argmax", **SMALL)
    model.save(f"{tmp_path}/web")
    new = frame(rows(100, 21) + [("p", "h", 999, "x", "AC new", "NEW", None, None, None, "Elsewhere")], ddl)
    want = {r.row_idx: (r.p_win, r.outcome) for r in model.transform(new).collect()}
    got = {r.row_idx: (r.p_win, r.outcome) for r in PipelineModel.load(f"{tmp_path}/web").transform(new).collect()}
    assert got == want and len(got) == 22 and sum(o == "WIN" for _, o in got.values()) == 8


def test_a_kept_template_pipeline(spark, frame, tmp_path):
    past = [("f", "s", i, ["Kerala", "ASSAM"][i % 2], str(i % 9), f"AC {i % 9}", f"c{i}", ["BJP", "INC", None][i % 3], float(i), int(i % 5 == 0)) for i in range(80)]
    ddl = "source string, sheet string, row_idx bigint, state string, constituency_no string, constituency string, candidate string, party string, total_votes double, win int"
    future = frame([("t", "Kerala", i, f"AC {i % 4}", " kerala", ["BJP", "NEW"][i % 2]) for i in range(20)], "source string, sheet string, row_idx bigint, constituency string, state string, party string")
    model, rows = template.fit_pipeline(frame(past, ddl), future, 2, **SMALL)
    model.save(f"{tmp_path}/template")
    want = sorted(tuple(r) for r in template.predict(model, rows).collect())
    got = sorted(tuple(r) for r in template.predict(PipelineModel.load(f"{tmp_path}/template"), rows).collect())
    assert got == want and sum(r[-1] == "W" for r in got) == 4
