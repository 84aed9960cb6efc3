"""Every operator over nulls, empty and very long texts, repeated rows, empty tables and columns with clashing names."""

import pytest

import corpus_pipeline
from hustings.llm import decontaminate, exact, extract, language, licenses, mixing, near, quality, secret_scan, warc

WORDS = "the river bends slowly past old mills where people once ground their corn and sang about summer rain"
LONG = " ".join(f"word{i % 5000} {WORDS}" for i in range(12_000))
DDL = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "kept string, score string, h int, size int, _n int, _lost int, _found string, _text string, key string, label string, "
    "copy int, _key string, tree int, html int, x int"
)
ROWS = [
    (1, WORDS, "en", "a"),
    (2, WORDS, "en", "b"),
    (2, WORDS, "en", "b"),
    (3, "", "en", None),
    (4, None, None, "a"),
    (None, WORDS, "en", "a"),
    (None, None, None, None),
    (5, LONG, "en", "a"),
    (6, " \n\t ", "fr", ""),
    (7, "!!! 123", "fr", "b"),
    (8, "Größe und Länge, schön wie früher gewesen", "de", "b"),
    (9, "\U0001f600 emoji été", "fr", "c"),
]


@pytest.fixture(scope="module")
def make(request):
    from conftest import small_frame

    spark = request.getfixturevalue("spark")
    return lambda rows: small_frame(spark, [(*r, 7, *[None] * 15) for r in rows], DDL)


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (5, 1), (8, 0), (None, 1), (9, None), (99, 1)], "doc_id bigint, quality int")


def benchmark(spark, rows=((1, WORDS), (1, WORDS), (2, None), (None, "sang about summer rain"), (3, ""), (4, "!!"))):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


OPERATORS = {
    "exact": lambda spark, docs: exact.exact_duplicates(docs),
    "quality": lambda spark, docs: quality.predict_quality(docs, labels(spark)),
    "near": lambda spark, docs: near.near_duplicates(docs),
    "licenses": lambda spark, docs: licenses.license_notices(docs),
    "secrets": lambda spark, docs: secret_scan.find_secrets(docs),
    "language": lambda spark, docs: language.predict_languages(docs),
    "mixing": lambda spark, docs: mixing.mix(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(spark, make, name):
    got = OPERATORS[name](spark, make(ROWS)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, make, name):
    assert OPERATORS[name](spark, make([])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_only_nulls(spark, make, name):
    assert len(OPERATORS[name](spark, make([(None, None, None, None)] * 2)).collect()) == 2


def test_exact_results(spark, make):
    got = {(r.doc_id, r.text_sha256): r for r in exact.exact_duplicates(make(ROWS)).collect()}
    by_id = {k[0]: r for k, r in got.items()}
    assert (by_id[1].keep_id, by_id[1].group_size, by_id[1].kept) == (2, 4, False)
    assert by_id[2].kept and by_id[2].group_size == 4
    assert (by_id[3].keep_id, by_id[3].group_size) == (4, 3)
    assert by_id[5].group_size == 1


def test_near_results(spark, make):
    got = {r.doc_id: r for r in near.near_duplicates(make(ROWS)).collect()}
    assert got[2].component_id == 1 and not got[2].kept and got[1].kept
    assert got[3].n_shingles == got[6].n_shingles == 0 and got[3].kept and got[6].kept
    assert got[7].n_shingles == 1 and got[None].component_id is None and got[None].kept


def test_language_results(spark, make):
    got = {r.doc_id: r for r in language.predict_languages(make(ROWS)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (3, 4, 6, 7))
    assert got[5].lang_pred == "en"


def test_passages(spark, make):
    docs = make(ROWS)
    got = decontaminate.find_passages(docs, benchmark(spark)).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in got) == sorted([(i, j) for i in (0, 1, 2, 2, 5) for j in (0, 1)])
    assert decontaminate.find_passages(docs, benchmark(spark, [])).collect() == []
    assert decontaminate.find_passages(make([]), benchmark(spark)).collect() == []


def test_pages(spark, frame):
    long = "<article>" + "<p>line of text</p>" * 50_000 + "</article>"
    rows = [(1, "http://a/x", "<article><p>a</article>"), (1, "http://a/x", "<article><p>a</article>"), (2, None, None)]
    rows += [(None, "http://a/y", "<p>only</p>"), (3, "not an address", ""), (4, "http://a/z", long), (5, "", "<p")]
    rows = [(*r, None, None) for r in rows]
    ddl = "page_id bigint, url string, html string, text string, key int"
    got = sorted(extract.main_texts(frame(rows, ddl)).collect(), key=lambda r: (r.page_id or 0, r.n_chars))
    assert [(r.page_id, r.n_chars) for r in got] == [(None, 4), (1, 1), (1, 1), (2, 0), (3, 0), (4, 650_000 - 1 + 0), (5, 2)]
    assert extract.main_texts(frame([], ddl)).collect() == []


def test_archive(spark, frame):
    long = "äöü" * 400_000
    rows = [(3, "u", "x" * 200), (1, None, "x" * 200), (2, "a b\r\n", "x" * 200), (4, "u", "kurz"), (5, "u", "kurz"), (6, "u", None)]
    rows += [(7, "u", long), (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (None, "u", "y" * 100), (7, "u", long)]
    ddl = "page_id bigint, url string, html string, digest int, own int"
    got = {r.page_id: r for r in warc.round_trip(frame([(*r, None, None) for r in rows], ddl)).collect()}
    assert len(got) == 9 and all(r.problem is None for r in got.values())
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, 3, 4, 5)] == [
        ("response", None), ("revisit", 1), ("revisit", 1), ("response", None), ("response", None)
    ]
    assert got[7].payload_bytes == len(long.encode()) and got[6].payload_bytes == 0 and got[8].payload_bytes == 9 * 33
    assert warc.round_trip(frame([], ddl)).collect() == []


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_hold_and_keep_columns(spark, make, tmp_path, stage):
    name, run = stage
    benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = make(ROWS)
    got = run(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    left = sorted((r.doc_id or 0, r.text) for r in got.collect() if r.text)
    named = {"LONG": LONG, "WORDS": WORDS}
    counts = {label: sum(t == text for _, t in left) for label, text in named.items()}
    # Of the long text and the four rows of one text (two equal in id, one without an id) each stage keeps what its docstring says.
    if name == "exact_dedup":
        assert counts == {"LONG": 1, "WORDS": 2} and all(i == 2 for i, t in left if t == WORDS)
    elif name == "near_dedup":
        assert counts == {"LONG": 1, "WORDS": 1} and (1, WORDS) in left
    elif name == "decontamination":
        assert counts == {"LONG": 0, "WORDS": 0}
    elif name == "language":
        assert counts == {"LONG": 1, "WORDS": 4}
    assert run(spark, make([]), str(tmp_path)).collect() == []
