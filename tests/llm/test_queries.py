"""The registered queries against their SQL or a plain version of them."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from compare import difference, open_tables

import corpus_pipeline
from hustings.llm import decontaminate, exact, language, licenses, near, page_lines, secret_rules, warc
from hustings.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_one_query_per_operator():
    import __spark_entry__ as entry

    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == [*range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_its_sql(spark, key):
    assert difference(QUERIES[key](spark, SF), open_tables(SF), SQL[key]) is None


def test_colliding_chunk_hashes_are_told_apart(spark, frame):
    rows = [(i, f"text {i % 40} " * 100) for i in range(120)]
    docs = frame(rows, "doc_id bigint, text string")
    got = exact.exact_duplicates(docs, id_bits=3, least=8, most=16).collect()
    assert all(r.group_size == 3 and r.keep_id == 80 + r.doc_id % 40 for r in got)


def test_chunks_join_to_the_text(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = docs.select("text", exact.chunks(docs.text).alias("c")).collect()
    assert all("".join(r.c) == r.text for r in got)


def test_license_base(spark, texts):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for r in QUERIES["op5_license_notices"](spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(str.maketrans(upper, upper.lower())))
        hits = sorted((i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())
        ends = (hits[0][0], hits[-1][0]) if hits else (None, None)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(hits), *ends)
        assert r.base_labels == ",".join(sorted({label for _, label in hits}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_license_rules_and_suppression(spark, frame):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0."),
        (2, "SPDX-License-Identifier: MIT"),
        (3, "Released under the MIT Licence. Copyright (c) 2021 Someone. ALL RIGHTS -- RESERVED; all rights reserved"),
        (4, "under the GNU General Public License, version 3"),
        (5, "mit dem Apache in open space"),
        (6, "CC BY cc_by ccby"),
    ]
    got = {r.doc_id: r for r in licenses.license_notices(frame(rows, "doc_id int, text string")).collect()}
    assert got[1].labels == "apache-2.0" and len(got[1].spans) == 1
    assert got[2].labels == "mit"
    assert got[3].labels == "copyright-notice,mit,reserved" and got[3].n_base == 2
    assert got[4].labels.split(",") == ["gnu-gpl-3", "gpl"]
    assert got[5].labels == "" and got[5].score == 0
    assert got[6].n_base == 2 and got[6].labels == "cc-by"


def test_many_phrases(spark, frame):
    got = licenses.license_notices(frame([(1, "all rights reserved " * 3000)], "doc_id int, text string")).first()
    assert (got.n_base, got.first_word, got.last_word) == (3000, 0, 8997)


def test_secrets(spark, texts):
    assign = re.compile(secret_rules.BASE[0].pattern, re.I | re.A)
    for r in QUERIES["op8_secret_scan"](spark, SF).collect():
        text = texts[r.doc_id]
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        names = ("assign", "access", "hex")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in found) for i in range(3)]
        base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_trigram_queries_admit_every_match():
    samples = {
        "assign": "API_key: 'abcdefgh'", "access": "AKIA" + "Q" * 16, "github": "ghp_" + "a1" * 18, "slack": "xoxb-1234567890ab",
        "jwt": "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM", "private-key": "-----BEGIN RSA PRIVATE KEY-----",
        "url-password": "https://user:pass@host", "bearer": "Bearer abcdefghijklmnop1234",
    }

    def holds(query, data):
        if query[0] == "has":
            return query[1] in data
        return query[0] == "every" or (all if query[0] == "and" else any)(holds(q, data) for q in query[1:])

    rules = {r.kind: r for r in secret_rules.RULES}
    for kind, sample in samples.items():
        assert re.search(rules[kind].pattern, sample, rules[kind].flags)
        assert holds(secret_rules.trigram_query(rules[kind]), sample.lower().encode())
    assert secret_rules.trigram_query(rules["hex"]) == secret_rules.EVERY
    assert all(secret_rules.trigram_query(rules[k]) != secret_rules.EVERY for k in samples)


def reach(sets):
    """Component of every set by exact comparison of all pairs that share a shingle."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def shingle_sets(texts, n):
    out = {}
    for i, text in texts.items():
        ws = near.split_words(text)
        out[i] = {tuple(ws[j : j + n]) for j in range(len(ws) - n + 1)} or ({tuple(ws)} if ws else set())
    return out


def test_near_duplicates(spark, texts):
    sets = shingle_sets(texts, 4)
    want = reach(sets)
    for r in QUERIES["op4_near_duplicates"](spark, SF).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_star_of_copies_that_are_not_alike_themselves(spark, frame):
    """A base text and many copies of it, each with other changes: only the base links them."""
    random.seed(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        ws = list(base)
        for at in random.sample(range(6, 94, 9), 2):
            ws[at] = f"x{i}_{at}"
        rows.append((i + 1, " ".join(ws if i != 200 else base)))
    docs = frame(rows, "doc_id bigint, text string")
    want = reach(shingle_sets(dict(rows), 4))
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, words=4).collect()}
    assert got == want and len(set(want.values())) < 400


def test_page_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op3_page_text"](spark, SF).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(page_lines.unescape(re.sub("<[^>]+>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n".join(filter(None, parts)) and r.n_chars == len(r.text)


def test_shared_lines_of_neighbouring_pages_go(spark, frame):
    from hustings.llm.extract import main_texts

    shell = "<body><div>Our site</div><p>{}</p><div>Imprint {}</div><p>Read more</p></body>"
    rows = [(i, f"http://h.org/a/{i}", shell.format(f"Story {i}", 2020)) for i in range(4)] + [(9, "http://other.org/a/1", shell.format("Lone", 1))]
    got = {r.page_id: r.text for r in main_texts(frame(rows, "page_id int, url string, html string")).collect()}
    assert [got[i] for i in range(4)] == [f"Story {i}" for i in range(4)]
    assert got[9] == "Our site\nLone\nImprint 1\nRead more"


def test_parts_of_a_page():
    html = (
        "<header>Site<h1>Name</h1></header><main><article><header><h1>T &amp; u</h1><span>by me</span></header><p>One\n two<br>"
        "three<p>Four <b>five</b><div class='share-buttons'>Share</div><section id=comments><p>reader</p></section></article>"
        "</main><div class='cookie-notice'>We use</div><script>if (a<b) {}</script><p title='a>b'>stray</p>"
    )
    assert page_lines.main_text(page_lines.page_lines(html), set()) == "T & u\nOne two three\nFour five"


def test_longest_common_subsequence(monkeypatch):
    random.seed(1)

    def length(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    for bits in (1 << 28, 16):
        monkeypatch.setattr(page_lines, "MOST_BITS", bits)
        for _ in range(500):
            a, b = ([random.randrange(5) for _ in range(random.randrange(14))] for _ in range(2))
            got, rest = page_lines.shared(a, b), iter(b)
            assert got == sorted(set(got)) and all(any(y == a[i] for y in rest) for i in got) and len(got) == length(a, b)


def test_archive_segments_and_damage(spark, tmp_path, frame):
    rows = [(i, f"http://h/{i}", f"<p>{i} äöü</p>" * 50) for i in range(6)]
    path = str(tmp_path / "a")
    warc.write_archive(frame(rows, "page_id int, url string, html string"), path, segment=64)
    got = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert all(got[str(i)].payload.decode() == html and got[str(i)].problem is None for i, _, html in rows)
    text = spark.read.text(path, lineSep=warc.VERSION).where("value != ''")
    one = got["3"].record_id
    lines = [warc.VERSION + r.value for r in text.collect()]
    kept = [x for x in lines if not (f"Origin-ID: {one}" in x and "Segment-Number: 4\r" in x)]
    damaged = tmp_path / "b"
    damaged.mkdir()
    (damaged / "part.txt").write_bytes("".join(kept).encode())
    got = {r.page_id: r.problem for r in warc.read_archive(spark, str(damaged)).collect()}
    assert got == {str(i): "segments" if i == 3 else None for i in range(6)}


def test_chunked_framing():
    for payload in (b"", b"a", "äöü€".encode() * 9, b"WARC/1.1\r\n" * 3, b"x\r\n0\r\n\r\ny"):
        for most in (1, 3, 7, 1000):
            framed = warc.chunked(payload, max(most, 4))
            assert warc.unchunked(framed) == payload and b"WARC/1.1\r\n" not in framed
    assert warc.unchunked(b"5\r\nab") is None and warc.unchunked(b"zz\r\n") is None


def semi_global(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
        best = min(best, row[-1])
    return best


def test_edit_distance():
    random.seed(2)
    for _ in range(300):
        pattern, text = ("".join(random.choices("ab ", k=random.randrange(1, 12))) for _ in range(2))
        assert decontaminate.edit_distance(pattern, decontaminate.masks(pattern), text) == semi_global(pattern, text)


def test_passages_whole(spark, texts):
    items = {r.item_id: " ".join(decontaminate.words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    plain = {i: " ".join(decontaminate.words(t)) for i, t in texts.items()}
    want = {(d, i) for d, t in plain.items() for i, s in items.items() if s in t}
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op7_benchmark_passages"](spark, SF).collect()}
    assert {k for k, e in got.items() if e == 0} == want
    for (d, i), edits in got.items():
        assert edits <= 0.15 * len(items[i])


def test_recall_of_changed_passages(spark, texts):
    """Of passages changed in a tenth of their characters nearly all are found."""
    random.seed(4)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.build_index(items)
    docs, want = [], set()
    for n in range(200):
        item = n % len(items)
        s = list(index.strings[item])
        for _ in range(len(s) // 10):
            at = random.randrange(len(s))
            s[at : at + 1] = random.choice([["q"], [], [s[at], "e"]])
        docs.append(f"{texts[n % len(texts)][:400]} {''.join(s)} {texts[(n + 1) % len(texts)][:400]}")
        want.add((n, item))
    got = {(row, item) for row, item, _ in decontaminate.matches(docs, index)}
    assert len(want & got) >= 0.97 * len(want)


def test_languages_of_rows_held_out(spark):
    docs = spark.read.parquet(f"{MORE}/documents.parquet")
    got = QUERIES["op9_language_id"](spark, MORE).where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_kneser_ney_sums_to_one(spark, frame):
    rows = [(f"{a} banana band bandana", "x") for a in ("an", "ban", "cab")] + [("otto rotor motor", "y")] * 2
    model = language.train(frame(rows, "text string, lang string"), order=3)
    letters = sorted({c for t, _ in rows for c in t if c != " "})
    import numpy as np

    tails = np.array([[ord(c)] for c in letters] + [[0]], np.uint32)
    for context in ("an", "ba", "zz", "ot"):
        heads = np.tile(np.array([[ord(c) for c in context]], np.uint32), (len(tails), 1))
        total = np.exp(model.log_probabilities(np.hstack([heads, tails]))).sum(axis=0)
        # What is left is the share of symbols never seen.
        assert (total <= 1.0001).all() and (total > 0.6).all()


def test_foreign_text_is_rejected(spark, frame):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(given.where("doc_id != 2"))
    own = given.where("doc_id = 2").first().text
    docs = frame([(1, own), (2, "Щипка жуйка фывапр ыъэ " * 9), (3, "zqxj vkwz qqxj zzkv " * 9)], "doc_id int, text string")
    got = {r.doc_id: r.rejected for r in language.identify(docs, model).collect()}
    assert got == {1: False, 2: True, 3: True}


def test_quality_of_rows_held_out(spark):
    labels = spark.read.parquet(f"{MORE}/labels.parquet")
    got = QUERIES["op2_quality_scores"](spark, MORE).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_mixture_meets_its_targets(spark):
    rows = QUERIES["op10_mix_sources"](spark, MORE).collect()
    taken, largest = Counter(), Counter()
    for r in rows:
        taken[r.target, r.source_size] += r.taken
        largest[r.target, r.source_size] = max(largest[r.target, r.source_size], r.size)
        assert r.taken <= 2 * r.size
    assert all(abs(n - k[0]) <= largest[k] for k, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(r.size for r in rows)) <= 0.02 * sum(taken.values())


def test_pipeline_stages_on_their_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF)
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in kept.collect()}
        assert after.items() <= before.items()
        if name == "language":
            assert set(after) == {i for i, t in before.items() if any(c.isalpha() for c in t)}
        elif name == "exact_dedup":
            assert set(after) == {max(i for i, t in before.items() if t == text) for text in before.values()}
        elif name == "near_dedup":
            assert set(after) == {i for i, c in reach(shingle_sets(before, 5)).items() if c == i}
        elif name == "decontamination":
            items = [" ".join(decontaminate.words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            dirty = {i for i, t in before.items() if any(s in " ".join(decontaminate.words(t)) for s in items)}
            assert dirty.isdisjoint(after) and len(after) >= len(before) - len(dirty) - 2
        else:
            copies = Counter(r.doc_id for r in kept.collect())
            assert max(copies.values()) <= 2
        docs = kept
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
