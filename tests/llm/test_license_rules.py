"""Labels, spans, suppression and score against a plain reading of the rules."""

import random
import re

import pytest

from hustings.llm import licenses
from hustings.llm.license_wording import WORDING
from hustings.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RULES = licenses.rules()
COMPILED = [re.compile(f"(?<= )(?:{r['pattern']})(?= )") for r in RULES]


def words_of(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(upper, upper.lower())))


def plain(text):
    """``spans, labels, score`` without keywords: every rule is tried everywhere."""
    joined = f" {' '.join(words_of(text))} "
    found = []
    for rule, pattern in zip(RULES, COMPILED):
        for m in pattern.finditer(joined):
            start = joined.count(" ", 0, m.start()) - 1
            found.append((start, -(start + m[0].count(" ") + 1), -rule["level"], rule["rule"]))
    kept = []
    for start, down, fall, i in sorted(found):
        if not any(s <= start and d <= down and f <= fall for s, d, f, _ in kept):
            kept.append((start, down, fall, i))
    base = {label for phrase, label in licenses.BASE if f" {phrase} " in joined}
    unsure = (1 - licenses.BASE_WEIGHT) ** len(base)
    for *_, i in kept:
        unsure *= 1 - RULES[i]["weight"]
    spans = [f"{RULES[i]['label']}:{start}:{-down}" for start, down, _, i in kept]
    return spans, sorted(base | {RULES[i]["label"] for *_, i in kept}), 1 - unsure


def notices(seed, n):
    """Texts put together from rules' own words, names, versions and other words, so that finds overlap."""
    rng = random.Random(seed)
    sample = [re.sub(r"\(\?:([^|()]*)[^()]*\)\??", r"\1", r["pattern"]) for r in RULES]
    sample = [re.sub(r"\[sc\]", "s", s).replace(r"\d\d", "20").replace("?", "").split("|")[0] for s in sample]
    out = []
    for _ in range(n):
        parts = rng.choices(sample, k=rng.randrange(1, 6)) + rng.choices(["Licensed under the", "version", "2.0", "GNU", "MIT License", "the LICENSE", "x y z"], k=3)
        rng.shuffle(parts)
        out.append(rng.choice([" ", ", ", "\n * ", "! "]).join(parts))
    return out


def test_rules_are_different():
    assert len({(r["label"], r["pattern"]) for r in RULES}) == len(RULES) >= 500
    assert len(WORDING) >= 100 and len({w[4] for w in WORDING}) == len(WORDING)


@pytest.mark.parametrize("which", ["table", "made"])
def test_spans_labels_and_score(spark, frame, tmp_path, which):
    if which == "table":
        folder, texts = SF, {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    else:
        folder, texts = str(tmp_path), dict(enumerate([*notices(1, 250), *[w[4] for w in WORDING], "", None]))
        frame(list(texts.items()), "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    some = 0
    for r in QUERIES["op5_license_notices"](spark, folder).collect():
        spans, labels, score = plain(texts[r.doc_id])
        assert (r.spans, r.labels) == (",".join(spans), ",".join(labels)), texts[r.doc_id]
        assert r.score == pytest.approx(score, abs=1e-12)
        some += len(spans) > 0
    assert some > (1 if which == "table" else 200)
