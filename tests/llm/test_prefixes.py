"""The trie against a plain one built from dictionaries, in one range and in many."""

import hashlib
import math
import random
import zlib

import pyarrow as pa
import pytest
from compare import difference, open_tables

from hustings.llm import prefixes
from hustings.llm.queries import QUERIES, SQL

DDL = "conv_id bigint, turn bigint, role string, text string, ids string, shard int, key int, depth string"


def plain_sequences(turns):
    """The turns of each conversation in order, as ``(id, bytes of the text)``."""
    out = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            out.setdefault(conv, []).append((turn is not None, turn or 0, role, key, len(text.encode())))
    return {c: [(t[3], t[4]) for t in sorted(ts)] for c, ts in out.items()}


def plain_rebuilt(given):
    out = {}
    for c, own in given.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = given.get(c - int(math.fmod(c, 5)), [])
        out[c] = base[:h] + own[h:]
    return out


def plain_trie(given):
    members, size, ended = {}, {}, {}
    for c in sorted(given):
        path = [t[0] for t in given[c]]
        for d in range(len(path) + 1):
            node = tuple(path[:d])
            members.setdefault(node, []).append(c)
            size[node] = given[c][d - 1][1] if d else 0
        ended.setdefault(tuple(path), []).append(c)
    children = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * size[node]
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ended.get(node, []))).encode()).hexdigest())
        for node, who in members.items()
    )


def collected(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def some_turns(seed, n, most=7):
    """Few different turns, so that many conversations share their beginnings, many are equal, some are prefixes of others."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(3 * n), n):
        for turn in range(rng.randrange(1, most)):
            rows.append((rng.choice([conv, conv, conv, None if conv % 9 == 0 else conv]), rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None, "a"]), rng.choice(["x", "x", "x", "yé", "", None])))
    return rows


@pytest.mark.parametrize("shard_turns, partitions", [(prefixes.TURNS_A_SHARD, 4), (40, 4), (3, 4), (1, 1)])
def test_trie(spark, frame, shard_turns, partitions):
    turns = some_turns(shard_turns, 150)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = frame([(*t, "i", 1, 2, "d") for t in turns], DDL)
        assert collected(prefixes.prefix_trie(df, shard_turns)) == plain_trie(plain_sequences(turns))
        given = prefixes.rebuilt(prefixes.sequences(df))
        assert collected(prefixes.trie(given, shard_turns)) == plain_trie(plain_rebuilt(plain_sequences(turns)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_hot_group_of_copies_crosses_ranges(spark, frame):
    rows = [(c, t, "user", f"same {t}") for c in range(400) for t in range(5)] + [(c, 5, "user", f"own {c % 7}") for c in range(0, 400, 3)]
    rows += [(1000, t, "user", f"long {t}" if t > 2 else f"same {t}") for t in range(1500)]
    df = frame(rows, "conv_id int, turn int, role string, text string")
    got = prefixes.trie(prefixes.sequences(df), 60)
    assert collected(got) == plain_trie(plain_sequences(rows))


@pytest.mark.parametrize("width", [1, 2, 64])
def test_strips_of_any_width(monkeypatch, width):
    monkeypatch.setattr(prefixes, "WIDEST", width)
    rng = random.Random(width)
    given = {c: [(bytes([rng.randrange(1, 4)] * 16), 2) for _ in range(rng.randrange(9))] for c in range(60)}
    table = pa.table({
        "conv_id": pa.array(list(given), pa.int64()), "ids": pa.array([[t[0] for t in v] for v in given.values()], pa.list_(pa.binary())),
        "sizes": pa.array([[2] * len(v) for v in given.values()], pa.list_(pa.int64())), "back": [-1] * 60, "ahead": [-1] * 60,
    })
    got = sorted((r["conv_id"], r["depth"], -1 if r["parent_conv_id"] is None else r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in prefixes.nodes(table).to_pylist())
    assert got == plain_trie(given)


def test_turnless_and_empty(spark, frame):
    ddl = "conv_id bigint, turn bigint, role string, text string"
    assert prefixes.prefix_trie(frame([], ddl)).collect() == []
    assert prefixes.prefix_trie(frame([(None, 1, "user", "x")], ddl)).collect() == []
    # 1 % 5 is 1 and there is no conversation 0: the one turn of 1 lies within its replaced head.
    assert zlib.crc32(b"1") % 9 > 0
    got = collected(prefixes.trie(prefixes.rebuilt(prefixes.sequences(frame([(1, 0, "user", "x")], ddl)))))
    assert got == [(1, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_query_over_nulls_repeats_and_ties(spark, frame, tmp_path):
    turns = some_turns(3, 120) + [(-c, t, "user", "x") for c in range(1, 13) for t in range(4)]
    frame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = open_tables("/root/testdata/sf0.001")
    con.sql(f"create or replace view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert difference(QUERIES["op13_prefix_trie"](spark, str(tmp_path)), con, SQL["op13_prefix_trie"]) is None
