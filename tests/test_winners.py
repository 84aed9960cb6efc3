import random

import pytest
from pyspark.sql import functions as F

from hustings.operators.profiles import flag_incumbents, merge_profiles, wealth_to_margin
from hustings.operators.skew import HOT_KEYS, fits_broadcast, hot_keys, key_counts, lookup, spread_join
from hustings.operators.winners import label_winners, margins, pick_winners, turnout

NAN = float("nan")


def test_every_tied_top_wins_and_null_keys_get_no_label(frame):
    df = frame([(1, "a", 5.0), (1, "b", 5.0), (1, "c", 1.0), (2, "d", 0.0), (None, "e", 9.0)], "k int, c string, v double")
    got = {r.c: r.win for r in label_winners(df, ["k"], "v", ["c"]).collect()}
    assert got == {"a": 1, "b": 1, "c": 0, "d": 1, "e": None}


def test_missing_votes_are_never_the_top(frame):
    df = frame([(1, "a", NAN), (1, "b", 2.0), (1, "c", None), (2, "d", None)], "k int, c string, v double")
    assert {r.c: r.win for r in label_winners(df, ["k"], "v", ["c"]).collect()} == {"a": 0, "b": 1, "c": 0, "d": 0}


def test_turnout(frame):
    df = frame([(1, 3.0, 10), (1, 4.0, 10), (2, 5.0, 0), (None, 1.0, 5)], "k int, v double, e int")
    assert {r.k: r.turnout for r in turnout(df, ["k"], "v", "e").collect()} == {1: 0.7, 2: None}


def test_a_contest_with_a_third_of_the_rows_gives_the_same_labels_when_cut(frame):
    draw = random.Random(5)
    rows = [(0 if i % 3 == 0 else i % 50 or None, i, float(draw.randrange(40))) for i in range(3000)]
    df = frame(rows, "k int, i int, v double").repartition(4)
    best = {}
    for k, _, v in rows:
        best[k] = max(best.get(k, v), v)
    expected = {i: None if k is None else int(v == best[k]) for k, i, v in rows}
    cut = label_winners(df, ["k"], "v", ["i"], rows_per_task=20)
    assert {r.i: r.win for r in cut.collect()} == expected and cut.count() == len(rows)


def test_one_winner_per_contest(frame):
    rows = [("k1", 0.5, 0), ("k1", 0.5, 1), ("k2", NAN, 2), ("k2", 0.1, 3), (None, 0.9, 4), ("k3", NAN, 5), ("k3", None, 6)]
    df = frame(rows, "c string, p double, row_idx int")
    got = {r.row_idx: r.outcome for r in pick_winners(df, ["c"], "p", ["row_idx"]).collect()}
    assert got == {0: "W", 1: "L", 2: "L", 3: "W", 4: "L", 5: "L", 6: "L"}


def test_winners_do_not_depend_on_the_order_of_rows(frame):
    draw = random.Random(1)
    rows = [(i % 7, draw.choice([0.1, 0.2, 0.3]), i) for i in range(200)]
    picks = []
    for _ in range(2):
        draw.shuffle(rows)
        df = frame(rows, "c int, p double, row_idx int").repartition(5)
        picks.append({r.row_idx for r in pick_winners(df, ["c"], "p", ["row_idx"]).collect() if r.outcome == "W"})
    assert picks[0] == picks[1] and len(picks[0]) == 7


def test_contests_are_cut_down_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 7 as c", "cast(id as double) as p", "id as i")
    plan = pick_winners(rows, ["c"], "p", ["i"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_margins(frame):
    df = frame([(1, "a", 9.0), (1, "b", 4.0), (1, "c", 1.0), (2, "d", 3.0), (3, "e", 5.0), (3, "f", 5.0)], "k int, c string, v double")
    got = {r.k: (r.winner_votes, r.runner_up_votes, r.margin, r.c) for r in margins(df, ["k"], "v", ["c"], "c").collect()}
    assert got == {1: (9, 4, 5, "a"), 2: (3, None, 3, "d"), 3: (5, 5, 0, "e")}


def test_profiles_incumbents_and_ratio(frame):
    results = frame([(1, "A. B RAO", 10), (1, "X", 11), (2, "a b rao", 12)], "ac int, candidate string, i int")
    profiles = frame([(1, "a b rao", 5.0)], "ac int, candidate string, assets double")
    merged = {r.i: r.assets for r in merge_profiles(results, profiles, ["ac"], ["i"]).collect()}
    assert merged == {10: 5.0, 11: None, 12: None}
    past = frame(
        [(1, "p", 2011, 5.0, 0), (1, "q", 2011, 5.0, 1), (1, "r", 2011, 2.0, 2), (1, "p", 2012, 1.0, 3), (1, "r", 2012, 9.0, 4), (1, "q", 2013, 1.0, 5)],
        "ac int, who string, term int, v double, i int",
    )
    flags = {r.i: r.incumbent for r in flag_incumbents(past, ["ac"], "who", "term", "v", ["i"]).collect()}
    assert flags == {0: 0, 1: 0, 2: 0, 3: 1, 4: 0, 5: 0}
    ratios = wealth_to_margin(frame([(6.0, 3.0), (6.0, 0.0)], "assets double, margin double"), "assets").collect()
    assert [r.wealth_ratio for r in ratios] == [2.0, None]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("counted", [False, True])
def test_spread_join_equals_the_plain_join(frame, how, counted):
    left = frame([(None if i % 5 == 4 else (0 if i % 3 == 0 else i % 40), i) for i in range(900)], "k int, i int").repartition(3)
    right = frame([(k, f"v{k}") for k in range(0, 30)], "k int, v string")
    plain = left.join(right, "k", how)
    if counted:
        right = right.join(key_counts(left, ["k"]), "k", "left").fillna(0, ["_n"])
    spread = spread_join(left, right, ["k"], ["i"], how, rows_per_task=10)
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_spread_join_keeps_repeated_right_rows(frame):
    left, right = frame([(1, i) for i in range(50)], "k int, i int"), frame([(1, "a"), (1, "b")], "k int, v string")
    assert spread_join(left, right, ["k"], ["i"], "inner", rows_per_task=7).count() == 100


def test_hot_keys_are_bounded_and_sized(frame):
    df = frame([(0, i) for i in range(90)] + [(1, i) for i in range(5)], "k int, i int")
    assert [tuple(r) for r in hot_keys(key_counts(df, ["k"]), ["k"], 20).collect()] == [(0, 5)]
    assert HOT_KEYS <= 100_000


def test_lookup_broadcasts_only_what_was_counted(frame):
    left, right = frame([(i % 9, i) for i in range(50)], "k int, i int"), frame([(k, str(k)) for k in range(9)], "k int, v string")
    assert fits_broadcast(right, 9) and not fits_broadcast(right, 8)
    small, big = lookup(left, right, ["k"], ["i"]), lookup(left, right, ["k"], ["i"], broadcast_rows=3)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(small) and "_part" in plan(big)


def test_conditional_and_constant_columns(frame):
    df = frame([(1, 0.5, 0)], "c int, p double, i int").withColumn("outcome", F.lit("L"))
    assert pick_winners(df, ["c"], "p", ["i"]).collect()[0].outcome == "W"
