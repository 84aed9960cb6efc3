"""No row is lost or confused with another: repeated rows, shared and missing ids."""

from collections import Counter

import pytest
from compare import difference, open_tables

from hustings.llm import decontaminate, exact, mixing, near, warc
from hustings.llm.queries import QUERIES, SQL

WORDS = "the river bends slowly past old mills where people once ground their corn and sang about summer rain"
OTHER = "in winter the same road lies under deep snow and nobody walks there before the month of march begins"


def test_archive_sql_over_repeated_rows(spark, frame, tmp_path):
    rows = [(1, "u", "x" * 150), (1, "u", "x" * 150), (1, "v", "x" * 150), (2, "u", "x" * 150), (2, "u", "x" * 150), (3, "u", "kurz"), (3, "u", "kurz"), (4, None, None), (4, None, None)]
    frame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = open_tables("/root/testdata/sf0.001")
    con.sql(f"create or replace view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert difference(QUERIES["op6_warc_round_trip"](spark, str(tmp_path)), con, SQL["op6_warc_round_trip"]) is None


def test_ids_of_text_come_back_as_they_were(frame):
    ids = ["b ", " a", "", "a\r\nWARC-Type: x", "100%41", "é ", None]
    rows = [(i, "u", f"<p>{n}</p>" * 40) for n, i in enumerate(ids)] + [("z", "u", "<p>1</p>" * 40)]
    got = warc.round_trip(frame(rows, "page_id string, url string, html string")).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows) and all(r.problem is None for r in got)
    assert [r.refers_to for r in got if r.page_id == "z"] == [" a"]


def test_every_row_keeps_its_own_copies(frame):
    sizes = Counter()
    rows = [(None, f"{chr(97 + i % 26)} " * 11, f"s{s}", i) for s in range(8) for i in range(20)]
    docs = frame(rows, "doc_id bigint, text string, source string, n int")
    want = {r.source: r.target for r in mixing.mix(docs).collect()}
    got = mixing.mixture(docs).collect()
    for r in got:
        sizes[r.source] += 11
    assert all(abs(sizes[s] - target) <= 11 for s, target in want.items())
    assert max(Counter((r.source, r.n) for r in got).values()) <= 2
    twice = mixing.mixture(frame([(1, "a b", "x", 0)] * 50, "doc_id bigint, text string, source string, n int")).count()
    assert twice == 75


def test_rows_without_an_id_are_judged_too(spark, frame):
    ddl = "doc_id bigint, text string, n int"
    rows = [(None, WORDS, 0), (1, WORDS, 1), (2, WORDS, 2), (None, OTHER, 3), (None, "alone", 4), (5, f"{OTHER} and more", 5), (5, "clean words here", 6)]
    docs = frame(rows, ddl)
    assert sorted(r.n for r in exact.drop_duplicates(docs).collect()) == [2, 3, 4, 5, 6]
    items = frame([(1, OTHER)], "item_id int, text string")
    assert sorted(r.n for r in decontaminate.drop_contaminated(docs, items).collect()) == [0, 1, 2, 4, 6]


@pytest.mark.parametrize("swap", [False, True])
def test_texts_under_one_id_stay_apart(frame, swap):
    base = [f"w{i}" for i in range(120)]
    t2, t3 = " ".join(base), " ".join([*base[:-1], "other"])
    rows = [(5, OTHER), (5, t2)]
    rows = (rows[::-1] if swap else rows) + [(3, t3)]
    got = near.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == [(3, 116, 3, True), (5, 15, 5, True), (5, 116, 3, False)]


def test_near_copies_without_an_id_go(frame):
    base = [f"w{i}" for i in range(120)]
    close = [" ".join([*base[:-1], x]) for x in "abcd"]
    ddl = "doc_id bigint, text string, n int"
    rows = [(None, close[0], 0), (7, close[1], 1), (None, close[2], 2), (None, OTHER, 3), (None, f"{OTHER}", 4), (8, "short", 5), (None, None, 6), (9, close[3], 7)]
    left = sorted(r.n for r in near.drop_near_duplicates(frame(rows, ddl)).collect())
    assert left == [1, 3, 4, 5, 6]
    left = sorted(r.n for r in near.drop_near_duplicates(frame([r for r in rows if r[0] is None], ddl)).collect())
    assert left in ([0, 3, 4, 6], [2, 3, 4, 6])
