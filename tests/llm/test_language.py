"""Kneser-Ney models against dictionaries, and the two ways of scoring against each other."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from hustings.llm import language
from hustings.llm.tables import held_out

SF = "/root/testdata/sf0.001"


def plain_symbols(text):
    out, last = [], False
    for c in text.replace(chr(language.EDGE), " ").lower():
        if c.isalpha():
            out.append(c)
        elif last:
            out.append(" ")
        last = c.isalpha()
    return out


def plain_grams(text, order):
    x = [" "] * (order - 1) + plain_symbols(text)
    return ["".join(x[i : i + order]) for i in range(len(x) - order + 1)]


class Plain:
    """Interpolated Kneser-Ney of one language, by definition."""

    def __init__(self, texts, order, alphabet):
        self.order, self.alphabet = order, alphabet
        self.levels = [Counter(g for t in texts for g in plain_grams(t, order))]
        for _ in range(order - 1):
            self.levels.insert(0, Counter(g[1:] for g in self.levels[0]))
        self.totals, self.kinds, self.discounts = [], [], []
        for level in self.levels:
            totals, kinds = defaultdict(int), Counter()
            for g, n in level.items():
                totals[g[:-1]] += n
                kinds[g[:-1]] += 1
            ones, twos = (sum(n == i for n in level.values()) for i in (1, 2))
            self.totals.append(totals)
            self.kinds.append(kinds)
            self.discounts.append(min(ones / (ones + 2 * twos), 0.95) if ones else 0.5)

    def p(self, gram):
        value = 1 / self.alphabet
        for k in range(self.order):
            part = gram[self.order - 1 - k :]
            total, d = self.totals[k].get(part[:-1], 0), self.discounts[k]
            if total:
                seen = max(self.levels[k].get(part, 0) - d, 0) / total
                value = seen + d * self.kinds[k][part[:-1]] / total * value
        return value

    def cross_entropy(self, text):
        grams = plain_grams(text, self.order)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams) if grams else 0.0


@pytest.mark.parametrize("order", [2, 3, 4])
def test_cross_entropies_are_those_of_the_definition(spark, frame, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = docs.where(~held_out(docs.doc_id)).where("lang is not null")
    model = language.train(learned, order=order)
    rows = learned.select("text", "lang").collect()
    alphabet = 1 + len({c for r in rows for c in plain_symbols(r.text)})
    plain = [Plain([r.text for r in rows if r.lang == name], order, alphabet) for name in model.languages]
    texts = [r.text for r in docs.where(held_out(docs.doc_id)).collect()] + ["Щипка ыъэ", "", "a", "!?", "ΑΣ ΣΑ mixed Äö"]
    got, size = language.cross_entropies(texts, order, len(plain), model.log_probabilities)
    for text, row, n in zip(texts, got, size):
        assert n == len(plain_grams(text, order))
        assert row == pytest.approx([p.cross_entropy(text) for p in plain], abs=2e-6)


def found(df):
    return sorted((r.doc_id or -1, r.lang_pred, r.score, r.rejected) for r in df.collect())


def test_tables_score_as_the_broadcast_does(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = frame([(None, None, None), (None, "été", "x"), (-5, "", "en"), (-6, "!!", None), (-7, "the and " * 9, "en"), (-7, "the and " * 9, "en")], "doc_id bigint, text string, lang string")
    docs = docs.unionByName(odd)
    every = found(language.predict_languages(docs))
    assert len(every) == docs.count()
    for most_cells in (50, 0):
        assert found(language.predict_languages(docs, most_cells=most_cells)) == every
    assert language.train(docs, most_cells=50).kept is not None and language.train(docs).kept is None


@pytest.mark.parametrize("piece", [1, 5, 64])
def test_long_texts_keep_their_context(monkeypatch, piece):
    texts = ["Straße\n\n und  ...Häuser", "ΟΔΟΣ ΣΟΦΟΣ", "  x", "one-two three", "", "!" * 200 + "ab" + "?" * 150 + "c", "z" * 130]
    whole = list(language.runs(texts, 4))
    windows = [language.grams(x, p, 4) for x, _, p in whole]
    want = Counter((int(d[i + 3]), tuple(w[i])) for (w, at), (_, d, _) in zip(windows, whole) for i in at)
    monkeypatch.setattr(language, "PIECE", piece)
    got = Counter()
    for x, document, predicted in language.runs(texts, 4):
        assert len(x) <= max(piece, 1) + 3 or len(set(document)) > 1
        if predicted.any():
            w, at = language.grams(x, predicted, 4)
            got += Counter((int(document[i + 3]), tuple(w[i])) for i in at)
    assert got == want
    assert [sum(n for (d, _), n in want.items() if d == i) for i in range(len(texts))] == [len(plain_grams(t, 4)) for t in texts]


def test_hashes_tell_symbols_apart():
    rows = np.array([[0, 1], [1, 0], [0, 0], [97, 98]], np.uint32)
    assert len(set(language.hashes(rows).tolist())) == 4
