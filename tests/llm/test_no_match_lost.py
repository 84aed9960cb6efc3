"""Passages whose every word is edited, and all pairs of texts and items against the edit distance itself."""

from random import Random

import pytest

from hustings.llm import decontaminate as d


def spoiled(item, at):
    """One letter of every word of the item changed."""
    return " ".join(w[:at] + "q" + w[at + 1 :] for w in item.split())


def test_every_word_edited(frame):
    rng = Random(3)
    items = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(12)) for _ in range(20)]
    docs = frame([(i, f"some words before {spoiled(item, i % 9)} and after it") for i, item in enumerate(items)], "doc_id int, text string")
    benchmark = frame(list(enumerate(items)), "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in d.find_passages(docs, benchmark).collect()}
    assert got == {(i, i): 12 for i in range(20)}
    assert d.drop_contaminated(docs, benchmark).count() == 0


@pytest.mark.parametrize("edits", [0.1, 0.15, 0.3])
def test_all_pairs_by_brute_force(edits, monkeypatch):
    monkeypatch.setattr(d, "HELD", 700)
    monkeypatch.setattr(d, "SPAN", 256)
    rng = Random(5)
    words = ["".join(rng.choices("abcdeé字", k=rng.randint(1, 7))) for _ in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 8, 20, 40])))) for i in range(30)]
    texts = ["", "a"]
    for _ in range(60):
        inside = list(" ".join(rng.choices(words, k=rng.randint(0, 60))))
        _, item = rng.choice(items)
        at = rng.randint(0, len(inside))
        part = list(item)
        for _ in range(int(rng.random() * 1.3 * edits * len(item))):
            place = rng.randrange(len(part))
            part[place : place + 1] = rng.choice([[], ["x"], [part[place], "b"]])
        texts.append("".join(inside[:at] + [" "] + part + [" "] + inside[at:]))
    index = d.build_index(items, edits)
    want = {}
    for row, text in enumerate(texts):
        string = " ".join(d.words(text))
        for number, pattern in enumerate(index.strings):
            least, most = d.edit_distance(pattern, d.masks(pattern), string), int(index.most_edits[number])
            if most and least <= most:
                want[row, number] = least
    got = {(row, number): e for row, number, e in d.matches(texts, index) if index.most_edits[number]}
    assert got == want and len(want) > 20


def test_an_item_is_cut_into_more_pieces_than_edits():
    for length in range(20, 600):
        for rate in (0.05, 0.15, 0.4, 0.9):
            k = int(rate * length)
            assert length // d.piece_length(length, k) > k
