"""Near copies of submissions against a comparison of all pairs."""

import random

import pytest

from hustings.operators import copies

DDL = "entry_id string, submitted_at int, state string, constituency string, candidate string"


def all_pairs(rows, percent):
    """Pairs of different sets, the earliest entry of equal ones standing for them."""
    sets, when = {}, {}
    for entry, day, *said in rows:
        if entry is not None and None not in said:
            sets.setdefault(entry, set()).add(tuple(said))
            when[entry] = min(when.get(entry, day), day)
    order = sorted(sets, key=lambda e: (when[e], e))
    firsts = {}
    for e in order:
        firsts.setdefault(frozenset(sets[e]), e)
    kept = [e for e in order if firsts[frozenset(sets[e])] == e]
    out = set()
    for i, a in enumerate(kept):
        for b in kept[i + 1 :]:
            n, larger = len(sets[a] & sets[b]), max(len(sets[a]), len(sets[b]))
            if 100 * n >= percent * larger:
                out.add((b, a, len(sets[b]), len(sets[a]), n))
    return out, {e: (firsts[frozenset(sets[e])], sum(s == sets[e] for s in sets.values())) for e in sets}


def families(seed, seats, n):
    """Families of submissions with few candidates a seat, so that single predictions say little; some short, some long."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 6 == 0:
            base = {s: rng.choice("AB") for s in range(rng.choice([seats, seats, 3, 1]))}
        own = {s: (rng.choice("ABC") if rng.random() < 0.06 else c) for s, c in base.items() if rng.random() > 0.02}
        rows += [(f"e{i:03d}", i % 17, "K", f"K{s}", c) for s, c in own.items()]
        rows += [(f"e{i:03d}", 3, "K", "K0", None), (f"e{i:03d}", 40, "K", "K1", own.get(1, "A"))]
    return rows + [(None, 1, "K", "K1", "A")]


@pytest.mark.parametrize("percent, dense, block", [(80, 1000, 2000), (80, 3, 4), (90, 0, 5), (50, 2, 3), (67, 10, 1)])
def test_all_near_copies_are_found(frame, percent, dense, block):
    rows = families(percent + dense, 40, 90)
    want, equal = all_pairs(rows, percent)
    df = frame(rows, DDL)
    got = copies.near_copies(df, percent, dense, block).collect()
    assert {(r.entry_id, r.source_entry, r["size"], r.source_size, r.n_shared) for r in got} == want and len(got) == len(want)
    assert all(r.agreement == r.n_shared / max(r["size"], r.source_size) for r in got)
    assert len(want) > 20
    assert {r.entry_id: (r.copy_of, r.n_equal) for r in copies.equal_submissions(df).collect()} == equal


def test_equal_copies_make_no_pairs(frame):
    rows = [(f"e{i:03d}", i, "K", f"K{s}", "A") for i in range(80) for s in range(10)]
    rows += [("z", 99, "K", f"K{s}", "B" if s == 0 else "A") for s in range(10)]
    got = copies.near_copies(frame(rows, DDL), 90).collect()
    assert [(r.entry_id, r.source_entry, r.n_shared) for r in got] == [("z", "e000", 9)]


def test_nothing_to_compare(frame):
    assert copies.near_copies(frame([], DDL)).collect() == []
    assert copies.equal_submissions(frame([("a", 1, None, None, "x")], DDL)).collect() == []
