"""Near copies among many texts that are alike, but below the similarity."""

import random

import pytest

from hustings.llm import near


@pytest.fixture(scope="module")
def family():
    """2,000 texts on one long passage, pairwise at 0.70; 150 of them have a partner at 0.80."""
    chance = random.Random(5)

    def words(n):
        return ["w%d" % chance.randrange(10**9) for _ in range(n)]

    passage = words(251)
    tails = [words(53) for _ in range(1850)]
    texts = [passage + tail for tail in tails] + [passage + tail[:21] + words(32) for tail in tails[:150]]
    order = chance.sample(range(len(texts)), len(texts))
    rows = [(order[i], " ".join(text)) for i, text in enumerate(texts)]
    pairs = {order[i]: order[1850 + i] for i in range(150)}
    return rows, {**pairs, **{b: a for a, b in pairs.items()}}


def found(frame, family):
    rows, partner = family
    got = {r.doc_id: r.component_id for r in near.near_duplicates(frame(rows, "doc_id bigint, text string")).collect()}
    return got, {i: min(i, partner.get(i, i)) for i, _ in rows}


def test_planted_pairs_in_a_family(frame, family):
    def jaccard(a, b):
        a, b = (set(near.shingles(near.split_words(t), 5, near.WordHashes()).tolist()) for t in (a, b))
        return len(a & b) / len(a | b)

    rows, partner = family
    texts = dict(rows)
    a, b = next(iter(partner.items()))
    c, d = [i for i in texts if i not in partner][:2]
    assert 0.8 <= jaccard(texts[a], texts[b]) < 0.81 and 0.69 < jaccard(texts[c], texts[d]) < 0.71
    got, wanted = found(frame, family)
    assert got == wanted


def test_overlaps_are_exact():
    import numpy as np

    chance = np.random.default_rng(3)
    sets = [np.unique(chance.integers(0, 200 if i % 2 else 4000, 60)).astype(np.uint64) for i in range(90)]
    left, right = np.arange(0, 40), np.arange(40, 90)
    for x, y in ((left, right), (left, left)):
        got = near.overlaps(sets, x, y)
        assert all(got[i, j] == len(np.intersect1d(sets[a], sets[b])) for i, a in enumerate(x) for j, b in enumerate(y) if a != b)


@pytest.mark.parametrize("light", [0, 1 << 40])
def test_lists_of_shingles_are_joined_or_compared_in_blocks(frame, family, monkeypatch, light):
    """Either way of treating the lists finds every link, also those that neighbours miss."""
    monkeypatch.setattr(near, "LIGHT", light)
    monkeypatch.setattr(near, "sorted_neighbours", lambda shallow, signs, similarity: shallow.select(shallow.doc.alias("a"), shallow.doc.alias("b")).limit(0))
    got, wanted = found(frame, family)
    assert got == wanted


def test_neighbours_in_sorted_orders_find_most_links(frame):
    """Families of near copies: what stands next to each other in some tree already connects nearly all of them."""
    chance = random.Random(8)
    rows = []
    for family in range(60):
        base = ["f%d_%d" % (family, i) for i in range(150)]
        for copy in range(12):
            own = list(base)
            own[chance.randrange(150)] = "x%d" % copy
            rows.append((len(rows), " ".join(own)))
    import numpy as np
    import pyarrow as pa

    signs = np.array([near.signature(near.shingles(near.split_words(t), 5, near.WordHashes())) for _, t in rows])
    found = set()
    for tree in range(near.TREES):
        path = np.hstack([signs, signs])[:, tree * near.PATH : tree * near.PATH + near.DEEP]
        order = sorted(range(len(rows)), key=lambda i: tuple(path[i]))
        table = pa.table({"tree": [tree] * len(rows), "path": pa.array(path[order].tolist(), pa.list_(pa.int32())), "doc": pa.array(order, pa.int64()), "size": [146] * len(rows)})
        for batch in near.next_to_each_other(80, near.NEIGHBOURS)(iter(table.to_batches(max_chunksize=17))):
            found |= set(zip(batch["a"].to_pylist(), batch["b"].to_pylist()))
    assert all(a // 12 == b // 12 for a, b in found)
    root = list(range(len(rows)))
    for _ in range(12):
        for a, b in found:
            root[a] = root[b] = min(root[a], root[b])
    assert sum(root[i] == i // 12 * 12 for i in range(len(rows))) >= 0.98 * len(rows)
