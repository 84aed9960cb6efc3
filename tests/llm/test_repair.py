"""Repaired conversations against a search through all edits, whole and cut into small blocks."""

import hashlib
import random
import re

import pytest
from compare import difference, open_tables

from hustings.llm import repair
from hustings.llm.queries import QUERIES, SQL

DDL = "conv_id bigint, turn bigint, role string, text string, c string, kind int, block int, cost string, times2 int"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def search(rows):
    """``(cost, audit, lines)`` of the best edits, by trying all with at most two insertions in a row."""
    best = None

    def go(i, fed, cost, audit, lines, inserts):
        nonlocal best
        if best and cost > best[0] or not re.fullmatch(r"s?(ua)*u?", fed):
            return
        if i == len(rows) and GRAMMAR.fullmatch(fed):
            best = min(best or (cost + 1, "", []), (cost, audit, lines), key=lambda b: b[:2])
        if inserts < 2:
            for role in ("user", "assistant"):
                go(i, fed + role[0], cost + 5, audit + "I", [*lines, f"{role}:"], inserts + 1)
        if i < len(rows):
            role, text, gone, cut = rows[i]
            go(i + 1, fed, cost + 2, audit + "D", lines, 0)
            if not gone:
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, fed + role[0], cost + 5 * cut, audit + "K", [*lines, f"{role}:{text}"], 0)
                for to in ("user", "assistant"):
                    go(i + 1, fed + to[0], cost + 1 + 5 * cut, audit + "R", [*lines, f"{to}:{text}"], 0)

    go(0, "", 0, "", [], 0)
    return best


def plain(turns):
    """The whole report from the definition, for ``(conv_id, turn, role, text)`` rows."""
    out = {}
    for conv in {t[0] for t in turns}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in turns if c == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()))
        seen, rows, count = set(), [], [0, 0, 0]
        for _, role, text in own:
            fault = 0 if not text.strip(SPACE) else 1 if (role, text) in seen else 2 if text.rstrip(SPACE)[-1] not in ".!?" else 3
            seen.add((role, text))
            rows.append((role, text, fault < 2, fault == 2))
            if fault < 3:
                count[fault] += 1
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        known = {t for t, _, _ in own if t is not None}
        cost, audit, lines = search(rows)
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def some_turns(seed, n, most):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "U", "support"]
    texts = ["Yes.", "No!", "cut", "", " \n", None, "Yes. \t", "Really?", "a.b", "long " * 50 + "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, most)):
            shown = rng.choice([turn, turn, turn, 2 * turn, None, 1])
            rows += [(conv or None, shown, rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("block", [1, 3, repair.BLOCK])
def test_all_edits(spark, frame, block):
    turns = some_turns(block, 60, 6)
    got = repair.repair(frame([(*t, None, 1, 2, "x", 0) for t in turns], DDL), block=block).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: v[:-1] for c, v in plain(turns).items()}


@pytest.mark.parametrize("block", [2, repair.BLOCK])
def test_repaired_rows(spark, frame, block):
    turns = some_turns(7, 30, 6)
    got = repair.repaired_turns(frame([(*t, None, 1, 2, "x", 0) for t in turns], DDL), block=block).collect()
    lines = {}
    for r in sorted(got, key=lambda r: (r.conv_id or 0, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.place == len(lines[r.conv_id]) and (r.edit != "I" or r.text == "")
    assert lines == {c: v[-1] for c, v in plain(turns).items() if v[-1]}


def test_nodes_are_shared():
    codes = sorted({c[::-1]: c for c in ("ua", "sua", "uaua", "xua", "sxua")}.items())
    nodes = [n for _, _, n in repair.walk((True, c) for _, c in codes)]
    endings = {c[i:] for _, c in codes for i in range(len(c))}
    assert sum(nodes) == len(endings)


def test_one_long_conversation_is_cut(spark, frame):
    """A conversation of many rows: its blocks are chained, its duplicates are seen across them."""
    rows = [(1, i, ("user", "assistant")[i % 2], f"Text {i % 700}.") for i in range(3000)] + [(2, 0, "user", "Hello")]
    one, other = (repair.repair(frame(rows, "conv_id int, turn int, role string, text string"), block=b).orderBy("conv_id").collect() for b in (50, 5000))
    assert one == other
    assert (one[0].duplicate, one[0].cost, one[0].audit) == (2300, 4600, "K" * 700 + "D" * 2300)
    assert (one[1].truncated, one[1].cost, one[1].audit) == (1, 2, "D")


def test_no_rows_and_dropped_rows(spark, frame):
    ddl = "conv_id string, turn int, role string, text string, n int"
    assert repair.repair(frame([], ddl)).collect() == []
    assert repair.repaired_turns(frame([], ddl)).collect() == []
    got = repair.repair(frame([("x", 1, "user", "Hi.", 0), (None, None, None, None, 0)], ddl), "n").collect()
    assert sorted((r.conv_id or "", *tuple(r)[1:]) for r in got) == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) for c in ("", "x")]


def test_query_over_nulls_repeats_and_ties(spark, frame, tmp_path):
    turns = some_turns(11, 40, 9)
    frame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = open_tables("/root/testdata/sf0.001")
    con.sql(f"create or replace view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    key = "op11_repair_conversations"
    assert difference(QUERIES[key](spark, str(tmp_path)), con, SQL[key]) is None
