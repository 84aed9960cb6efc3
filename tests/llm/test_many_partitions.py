"""Many shuffle partitions and little data: no further job, join or pass for each of them."""

import pytest
from pyspark.sql import functions as F

from hustings.llm import decontaminate, mixing, near, tables
from hustings.operators import ordering
from hustings.operators.skew import spread_join


@pytest.fixture
def many(spark):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_benchmark_comes_in_few_partitions(frame, many, monkeypatch):
    asked = []
    given = decontaminate.blocks

    def blocks(items):
        asked.append(items.rdd.getNumPartitions())
        return given(items)

    monkeypatch.setattr(decontaminate, "blocks", blocks)
    passage = "the quick brown fox jumps over the lazy dog near the river"
    docs = frame([("d1", f"so {passage} again"), ("d2", "nothing of the kind"), ("d3", None)], "doc_id string, text string")
    items = [("i1", passage), ("i1", passage), *[(f"i{n}", f"entirely different item number {n} of many") for n in range(2, 40)]]
    found = decontaminate.find_passages(docs, frame(items, "item_id string, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [("d1", "i1")]
    assert asked[0] < 32


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("counted", [True, False])
def test_join_without_hot_keys(frame, how, counted):
    left = frame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c"), (5, "c")], "i int, k string")
    right = frame([("a", 10, 2), ("b", 20, 1), ("d", 30, 0), (None, 40, 1)], "k string, v int, _n bigint")
    right = right if counted else right.drop("_n")
    usual = spread_join(left, right, ["k"], ["i"], how)
    known = spread_join(left, right, ["k"], ["i"], how, at_most=6)
    assert known.columns == usual.columns
    assert sorted(known.collect(), key=str) == sorted(usual.collect(), key=str)
    joins = lambda df: df._jdf.queryExecution().analyzed().toString().count("Join ")
    assert joins(known) == 1 < joins(usual)
    # More rows than a task takes: hot keys are looked for.
    assert joins(spread_join(left, right, ["k"], ["i"], how, rows_per_task=5, at_most=6)) > 1


def test_candidates_meet_their_texts_together(frame, monkeypatch):
    calls = []
    given = near.confirmed
    monkeypatch.setattr(near, "confirmed", lambda *a: calls.append(1) or given(*a))
    words = [f"w{i}" for i in range(60)]
    family = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1 :]])) for i in range(40)]
    alone = [(100 + i, " ".join(f"v{i}x{j}" for j in range(30))) for i in range(5)]
    docs = frame(family + alone, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    assert {found[i] for i in range(40)} == {0} and all(found[100 + i] == 100 + i for i in range(5))
    assert len(calls) == 2


def test_the_mixture_writes_few_tables(frame, monkeypatch):
    written = []
    for module, name in ((mixing, "stored"), (tables, "stored"), (ordering, "materialise")):
        given = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a, given=given: written.append(df.columns) or given(df, *a))
    rows = [(i % 7, "a b c" if i % 2 else "d e", source) for i, source in enumerate(["x", "y", None, "z"] * 10)]
    docs = frame(rows, "doc_id bigint, text string, source string")
    sizes = [F.regexp_count("text", F.lit(r"\S+")).alias("size")]
    copies = mixing.mixture(docs).select("source", *sizes).groupBy("source").agg(F.sum("size").alias("taken"))
    assert len(written) <= 4
    want = {r.source: r.taken for r in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    assert {r.source: r.taken for r in copies.collect()} == {k: v for k, v in want.items() if v}
    # Texts are written once, with their numbers.
    assert sum("text" in columns for columns in written) == 1


def test_positions_of_several_weights(frame):
    rows = [(k, k % 5) for k in range(100)]
    placed = ordering.positions(frame(rows, "k int, w bigint"), "k", _sum=F.col("w"))
    assert placed.columns == ["k", "w", "before", "_sum"]
    assert sorted(placed.collect()) == [(k, w, k, sum(x for _, x in rows[:k])) for k, w in rows]
