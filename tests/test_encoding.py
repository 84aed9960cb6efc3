import random
import statistics

import pytest
from pyspark.sql import functions as F

from hustings.operators.encoding import SafeEncoder, encode_closed, field_values, sorted_codes, with_sentinel
from hustings.operators.features import above_median, proxy_label, risk_band, risk_flag
from hustings.operators.ordering import balanced_folds, exact_median, positions


def test_vocabulary_of_both_datasets_sorts_with_the_sentinel(frame):
    train, template = frame([("b",), ("a",), ("Z",), (None,)], "party string"), frame([("b",)], "party string")
    model = SafeEncoder(inputCols=["party"], outputCols=["code"], template=template).fit(train)
    codes = {r.value: r.code for r in model.vocabulary.collect()}
    assert codes == {"UNKNOWN": 0, "Z": 1, "a": 2, "b": 3}
    got = model.transform(frame([("a",), (None,), ("new",), ("b",)], "party string")).collect()
    assert {r.party: r.code for r in got} == {"a": 2, None: 0, "new": 0, "b": 3}


def test_large_vocabularies_give_the_same_codes(frame):
    rows = [(f"p{i % 37}" if i % 3 else "IND", i % 11, i) for i in range(600)]
    train = frame(rows, "party string, state int, i int")
    model = SafeEncoder(inputCols=["party", "state"], outputCols=["pc", "sc"]).fit(train)
    small = sorted((r.i, r.pc, r.sc) for r in model.transform(train).collect())
    model.broadcast_rows, model.row_id = 2, ["i"]
    large = sorted((r.i, r.pc, r.sc) for r in model.transform(train).collect())
    names = sorted({r[0] for r in rows} | {"UNKNOWN"})
    states = sorted({str(r[1]) for r in rows} | {"UNKNOWN"})
    assert small == large == [(i, names.index(p), states.index(str(s))) for p, s, i in rows]


def test_closed_codes_make_missing_a_category(frame):
    df = frame([("x", 1), (None, 2), ("a", 3)], "e string, i int")
    assert {r.i: r.code for r in encode_closed(df, {"e": "code"}, ["i"]).collect()} == {3: 0, 2: 1, 1: 2}


def test_codes_of_several_fields_are_dense(frame):
    draw = random.Random(3)
    rows = [(str(draw.randrange(500)), chr(65 + draw.randrange(26))) for _ in range(900)]
    values = with_sentinel(field_values(frame(rows, "n string, l string"), {"n": "n", "l": "l"}), ["n", "l"])
    got = {(r.field, r.value): r.code for r in sorted_codes(values).collect()}
    expected = {}
    for field, at in (("n", 0), ("l", 1)):
        for code, value in enumerate(sorted({r[at] for r in rows} | {"UNKNOWN"})):
            expected[(field, value)] = code
    assert got == expected


@pytest.mark.parametrize("ranges", [1, 7])
def test_positions(frame, ranges):
    draw = random.Random(2)
    rows = [(k, draw.randrange(1, 9)) for k in draw.sample(range(10_000), 700)]
    placed = positions(frame(rows, "k int, w bigint"), "k", F.col("w"), ranges).collect()
    before, total = {}, 0
    for k, w in sorted(rows):
        before[k], total = total, total + w
    assert {r.k: r.before for r in placed} == before


@pytest.mark.parametrize("n", [1, 2, 5, 300, 4001])
def test_exact_median(frame, n):
    draw = random.Random(n)
    values = [float(draw.choice([draw.randrange(30), draw.uniform(0, 1000)])) for _ in range(n)]
    df = frame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    assert exact_median(df, "x").collect()[0].median == pytest.approx(statistics.median(values), rel=1e-12)


def test_median_of_a_value_held_by_a_third_of_the_rows(frame):
    values = [7.0] * 400 + [float(i) for i in range(800)]
    got = exact_median(frame([(v,) for v in values], "x double"), "x").collect()[0].median
    assert got == statistics.median(values)


def test_folds_are_balanced_per_class_and_repeatable(frame):
    rows = [(i, "win" if i % 13 == 0 else "loss") for i in range(1000)]
    df = frame(rows, "i int, label string")
    once = {r.i: r.fold for r in balanced_folds(df, ["label"], ["i"]).collect()}
    again = {r.i: r.fold for r in balanced_folds(df.repartition(7), ["label"], ["i"], digits=1).collect()}
    assert once == again and sorted(once) == list(range(1000))
    for name in ("win", "loss"):
        members = [once[i] for i, label in rows if label == name]
        sizes = [members.count(f) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert {r.i: r.fold for r in balanced_folds(df, ["label"], ["i"], seed=7).collect()} != once


def test_stand_in_label(frame):
    rows = [(i, float(i), i % 2) for i in range(400)]
    got = proxy_label(frame(rows, "i int, assets_numeric double, is_major_party int"), F.col("i")).collect()
    for r in got:
        if not r.is_major_party:
            assert r.proxy == 0
        elif r.assets_numeric > 199.5:
            assert r.proxy == 1
    poor = [r.proxy for r in got if r.is_major_party and r.assets_numeric <= 199.5]
    assert 0.1 < sum(poor) / len(poor) < 0.4


def test_above_median_is_strict(frame):
    got = above_median(frame([(1.0,), (2.0,), (3.0,)], "x double"), "x")
    assert {r.x: r.above for r in got.collect()} == {1.0: False, 2.0: False, 3.0: True}


def test_risk(frame):
    df = frame([(0,), (1,), (3,), (9,), (None,)], "n int").select("n", risk_flag(F.col("n")).alias("f"), risk_band(F.col("n")).alias("b"))
    assert [(r.f, r.b) for r in df.collect()] == [(0, "none"), (1, "low"), (1, "medium"), (1, "high"), (0, "none")]
