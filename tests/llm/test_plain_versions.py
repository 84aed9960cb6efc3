"""Quality scores from the formulas, all secret rules, and benchmark passages by an edit search over all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hustings.llm import decontaminate, quality, secret_scan
from hustings.llm.queries import QUERIES
from hustings.llm.secret_rules import BASE, RULES
from hustings.llm.tables import held_out

SF = "/root/testdata/sf0.001"
MORE = "/root/testdata/sf0.01"


def plain_statistics(text):
    """The nine statistics of one text, character by character."""
    data = text.encode()
    out = []
    for members, usual in zip(quality.CLASSES, quality.USUAL):
        out.append(((sum(b in members for b in data) + quality.PRIOR * usual) / (len(data) + quality.PRIOR)) ** 0.5)
    words = text.split()
    n = len(words)
    out.append(((text.count("\n") + quality.PRIOR * 0.004) / (len(text) + quality.PRIOR)) ** 0.5)
    out.append(np.log((sum(len(w) for w in words) + 27.5) / (n + 5)))
    out.append(np.log((len(set(words)) + 10) / (n + 10)) / np.log(n + 20))
    out.append((len({(a, b) for a, b in zip(words, words[1:])}) + 10) / (max(n - 1, 0) + 10))
    return out


def log_density(x, mean, covariance):
    gap = x - mean
    return -0.5 * np.log(np.linalg.det(covariance)) - 0.5 * gap @ np.linalg.inv(covariance) @ gap


def test_quality_scores_follow_the_formulas(spark):
    import zlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MORE}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{MORE}/labels.parquet").collect() if r.quality is not None}
    x = {i: np.array(plain_statistics(t)) for i, t in texts.items()}
    learned = [i for i in label if i in texts and zlib.crc32(str(i).encode()) % 5]
    own = [np.array([x[i] for i in learned if label[i] == c]) for c in (0, 1)]
    means = [a.mean(axis=0) for a in own]
    covariances = [np.cov(a.T, ddof=0) for a in own]
    pooled = sum(len(a) * c for a, c in zip(own, covariances)) / len(learned)
    shrunk = [0.95 * (0.9 * c + 0.1 * pooled) + 0.05 * np.diag(np.diag(pooled)) for c in covariances]
    margin = {i: log_density(v, means[1], shrunk[1]) - log_density(v, means[0], shrunk[0]) for i, v in x.items()}
    # The curve: where the penalised likelihood of the margins, in quarters between -60 and 60, has no slope.
    m = np.round(np.clip([margin[i] for i in learned], -60, 60) * 4) / 4
    y = np.array([label[i] for i in learned])
    rows = QUERIES["op2_quality_scores"](spark, MORE).collect()
    docs, labels = (spark.read.parquet(f"{MORE}/{t}.parquet") for t in ("documents", "labels"))
    rows_learned = quality.measured(docs).where(~held_out(F.col("doc_id"))).join(labels.where("quality in (0, 1)"), "doc_id")
    model = quality.fit(rows_learned.select("x", F.col("quality").cast("int").alias("label")))
    a, b = model.slope, model.shift
    p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
    assert abs(((y - p) * m).sum() - (a - 1)) < 1e-6 and abs((y - p).sum() - 0.1 * b) < 1e-6
    for r in rows:
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(a * margin[r.doc_id] + b, -40, 40))), abs=1e-6)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3)


def made_from(rng, pattern):
    """A text that a pattern matches, drawn at random from its parsed form."""
    from re import _parser

    def draw(parsed):
        out = []
        for kind, value in parsed:
            kind = str(kind)
            if kind == "LITERAL":
                out.append(chr(value))
            elif kind == "NOT_LITERAL":
                out.append("y")
            elif kind == "ANY":
                out.append("q")
            elif kind == "IN":
                if str(value[0][0]) == "NEGATE":
                    out.append("k")
                    continue
                of, what = rng.choice(value)
                of = str(of)
                out.append(chr(what) if of == "LITERAL" else chr(rng.randrange(what[0], what[1] + 1)) if of == "RANGE" else {"CATEGORY_DIGIT": "7", "CATEGORY_WORD": "w", "CATEGORY_SPACE": " "}.get(str(what), "-"))
            elif kind == "CATEGORY":
                out.append({"CATEGORY_DIGIT": "7", "CATEGORY_WORD": "w"}.get(str(value), " "))
            elif kind == "SUBPATTERN":
                out.append(draw(value[3]))
            elif kind == "BRANCH":
                out.append(draw(rng.choice(value[1])))
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                least, most, part = value
                out.append("".join(draw(part) for _ in range(rng.randrange(least, min(int(most), least + 30) + 1))))
            elif kind in ("AT", "ASSERT", "ASSERT_NOT", "GROUPREF"):
                continue
            else:
                raise AssertionError(kind)
        return "".join(out)

    return draw(_parser.parse(pattern))


def test_all_secret_rules(spark, frame):
    rng = random.Random(6)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for n in range(600):
        parts = [made_from(rng, rng.choice(RULES).pattern) for _ in range(rng.randrange(1, 4))] + ["plain words", "é = 'x'", "TOKEN"]
        rng.shuffle(parts)
        text = rng.choice([" ", "\n", "; ", ""]).join(parts)
        texts[-1 - n] = text if n % 5 else text.upper()
    seen = set()
    docs = frame(list(texts.items()), "doc_id bigint, text string")
    for r in secret_scan.find_secrets(docs).collect():
        text = texts[r.doc_id]
        found = []
        for k, rule in enumerate(RULES):
            for m in re.finditer(rule.pattern, text, rule.flags):
                if len(m[rule.group]) >= rule.least:
                    found.append((m.start(), k, m.end()))
                    seen.add(rule.kind)
        assert r.spans == ",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in sorted(found)), text
    assert seen == {rule.kind for rule in RULES} and len(RULES) > len(BASE) + 20


def test_passages_against_an_edit_search_over_all_pairs(spark, frame, tmp_path):
    """Every found passage is within the limit, and of all that are, at least nine in ten are found: a third of the texts of
    the table, and passages planted in others with edits in up to every eighth character."""
    rng = random.Random(12)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id % 3 == 0}
    for n in range(90):
        passage = list(items[rng.choice(list(items))])
        for _ in range(len(passage) * (n % 10) // 80):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([["q"], [], [passage[at], "e"]])
        about = texts[rng.choice([i for i in texts if i >= 0])]
        cut = rng.randrange(min(len(about), 600) + 1)
        texts[-1 - n] = f"{about[:cut]} {''.join(passage)} {about[cut : cut + 600]}"
    frame(list(texts.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    frame(list(items.items()), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {}
    for item, text in items.items():
        pattern = " ".join(decontaminate.words(text))
        mask = decontaminate.masks(pattern)
        for doc, other in texts.items():
            edits = decontaminate.edit_distance(pattern, mask, " ".join(decontaminate.words(other)))
            if edits <= int(decontaminate.EDITS * len(pattern)):
                want[doc, item] = edits
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op7_benchmark_passages"](spark, str(tmp_path)).collect()}
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.9 * len(want) and len(want) >= 90
