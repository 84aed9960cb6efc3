"""Benchmark passages inside documents: CGK embedding, bit sampling over item-sized windows, exact edit distances.

Windows are laid wherever enough pieces of an item stand in order: it is cut into more pieces than it may have edits, and an
edit destroys one piece at most, so no place within the edits is passed over.

The CGK walk reads a string with one pointer that advances, step by step, by a random bit drawn from the step and the
symbol under it.  Two strings at a small edit distance run in step for most of the way, so a few sampled steps agree.
Repeated often enough, sampling finds a window with any given probability.  Finds are measured first; of the places it has
not found those are measured too that may hold fewer edits, so nothing is lost to chance.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.tables import own_columns, stored, text_of, unused

EDITS, RECALL, AGREEMENT, SAMPLED = 0.15, 0.99, 0.45, 3
LEAST, MANY = 20, 6
LONGEST_PIECE, BUCKETS = 8, 20
BLOCK = 4 << 20
HELD, SPAN = 1 << 22, 1 << 18
PAD = 255
WORDS = re.compile("[⺀-鿿豈-﫿]|[^\\W_⺀-鿿豈-﫿]+")


def words(text: str) -> list[str]:
    """Words in lower case; a character of a script without word spaces is a word."""
    return WORDS.findall(text.lower())


def codes(string: str) -> np.ndarray:
    """Symbols below PAD for the walk; different characters may share one, which only lets more windows through."""
    return (np.frombuffer(string.encode("utf-32-le", "surrogatepass"), np.uint32) % PAD).astype(np.uint8)


@dataclass
class Pieces:
    """Pieces of one length of all items that are cut so: pieces in order of their bucket, where each bucket's begin, and for
    every piece its item, its offset there and its number."""

    length: int
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    number: np.ndarray


@dataclass
class Index:
    """Benchmark items of one block.  ``anchors``: word to the items that hold it and its offset there, for items that must
    stand unchanged.  ``pieces``: those of all others, ``cut`` the number of each item's.  ``steps`` and ``expected``: for every
    repetition and item the sampled steps of the walk and the symbols read there."""

    ids: list
    strings: list[str]
    lengths: np.ndarray
    most_edits: np.ndarray
    anchors: dict[str, list[tuple[int, int]]]
    paired: np.ndarray
    pieces: list[Pieces]
    cut: np.ndarray
    turns: np.ndarray
    steps: np.ndarray
    expected: np.ndarray


def buckets(text: np.ndarray, length: int) -> np.ndarray:
    """A bucket for every stretch of ``length`` symbols; different stretches may share one, which only lets more through."""
    n = max(len(text) - length + 1, 0)
    mixed = np.zeros(n, np.uint32)
    for i in range(length):
        mixed *= np.uint32(16777619)
        mixed += text[i : i + n]
    return (mixed * np.uint32(2654435769)) >> np.uint32(32 - BUCKETS)


def piece_length(length: int, edits: int) -> int:
    """The longest pieces of which enough are left after ``edits``: one for every twenty characters, one at least."""
    for size in range(LONGEST_PIECE, 1, -1):
        if length // size - edits >= max(1, length // 20):
            return size
    return 1


def cut_items(strings: list[str], most: np.ndarray) -> tuple[list[Pieces], np.ndarray]:
    held, cut = defaultdict(list), np.zeros(len(strings), np.int64)
    for item, (string, edits) in enumerate(zip(strings, most)):
        if edits:
            size = piece_length(len(string), int(edits))
            cut[item] = len(string) // size
            at = np.arange(cut[item]) * size
            held[size].append((buckets(codes(string), size)[at], np.full(len(at), item), at))
    out = []
    for size, parts in sorted(held.items()):
        bucket, item, offset = (np.concatenate(x).astype(np.int64) for x in zip(*parts))
        order = np.argsort(bucket, kind="stable")
        first = np.searchsorted(bucket[order], np.arange((1 << BUCKETS) + 1)).astype(np.int32)
        item, offset = item[order].astype(np.int32), offset[order].astype(np.int32)
        out.append(Pieces(size, first, item, offset, offset // size))
    return out, cut


def advance(symbols: np.ndarray, turn: np.ndarray) -> np.ndarray:
    return ((symbols.astype(np.uint32) + np.uint32(1)) * turn >> np.uint32(15)) & np.uint32(1)


def repetitions(recall: float, agreement: float, sampled: int) -> int:
    """How often ``sampled`` steps, each agreeing with the given chance, must be tried for ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def build_index(
    items: list[tuple[object, str]],
    edits: float = EDITS,
    recall: float = RECALL,
    agreement: float = AGREEMENT,
    sampled: int = SAMPLED,
    seed: int = 7,
) -> Index:
    """Index items ``(id, text)``.

    Items that may be edited are cut into pieces.  Windows of those that must stand unchanged are laid where one of their
    anchor words stands: the rarer half of an item's words within the benchmark, at least three; items with MANY anchors need
    two of them at fitting places, which an unchanged item always has.
    """
    split = [words(text) for _, text in items]
    strings = [" ".join(w) for w in split]
    often = Counter(w for ws in split for w in set(ws))
    lengths = np.array([len(s) for s in strings], np.int64)
    most = np.where(lengths >= LEAST, np.floor(edits * lengths), 0).astype(np.int64)
    pieces, cut = cut_items(strings, most)
    anchors = defaultdict(list)
    paired = np.zeros(len(items), bool)
    for number, ws in enumerate(split):
        if most[number]:
            continue
        rare = sorted(set(ws), key=lambda w: (often[w], -len(w), w))
        chosen = set(rare[: max(3, (len(rare) + 1) // 2)])
        paired[number] = len(chosen) >= MANY
        offset = 0
        for w in ws:
            if w in chosen:
                anchors[w].append((number, offset))
            offset += len(w) + 1
    random = np.random.default_rng(seed)
    rounds, longest = repetitions(recall, agreement, sampled), int(lengths.max(initial=1))
    turns = random.integers(0, 1 << 32, (rounds, longest + sampled), dtype=np.uint32) | np.uint32(1)
    # The walk takes about two steps a character; the first half of a window drifts least.
    steps = np.sort(random.random((rounds, len(items), sampled)), axis=2) * lengths[None, :, None]
    steps = steps.astype(np.int64) + np.arange(sampled)
    expected = np.zeros((rounds, len(items), sampled), np.uint8)
    text = np.concatenate([codes(s) for s in strings] + [np.full(1, PAD, np.uint8)])
    starts = np.cumsum(lengths) - lengths
    for r in range(rounds):
        at = np.zeros(len(items), np.int64)
        for j in range(int(steps[r].max(initial=0)) + 1):
            symbol = np.where(at < lengths, text[np.minimum(starts + at, len(text) - 1)], PAD).astype(np.uint8)
            due = steps[r] == j
            expected[r][due] = np.broadcast_to(symbol[:, None], due.shape)[due]
            at += advance(symbol, turns[r, min(j, turns.shape[1] - 1)])
    return Index([i for i, _ in items], strings, lengths, most, dict(anchors), paired, pieces, cut, turns, steps, expected)


def sampled_alike(text: np.ndarray, starts: np.ndarray, items: np.ndarray, index: Index) -> np.ndarray:
    """Which windows agree with their item on all sampled steps of at least one repetition."""
    found = np.zeros(len(starts), bool)
    sampled = index.steps.shape[2]
    for r in range(len(index.steps)):
        who = np.flatnonzero(~found)
        at = np.zeros(len(who), np.int64)
        k = np.zeros(len(who), np.int64)
        j = 0
        while len(who):
            item = items[who]
            symbol = np.where(at < index.lengths[item], text[np.minimum(starts[who] + at, len(text) - 1)], PAD)
            due = index.steps[r, item, k] == j
            if due.any():
                agree = symbol == index.expected[r, item, k]
                k = k + due
                done = due & agree & (k == sampled)
                found[who[done]] = True
                stay = ~((due & ~agree) | done)
                who, at, k, symbol = who[stay], at[stay], k[stay], symbol[stay]
            at = at + advance(symbol, index.turns[r, min(j, index.turns.shape[1] - 1)])
            j += 1
    return found


def masks(pattern: str) -> dict[str, int]:
    found = defaultdict(int)
    for i, c in enumerate(pattern):
        found[c] |= 1 << i
    return found


def edit_distance(pattern: str, mask: dict[str, int], text: str) -> int:
    """Least edit distance between ``pattern`` and any stretch of ``text`` (bit-parallel columns)."""
    if pattern in text:
        return 0
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    least = m
    get = mask.get
    for c in text:
        eq = get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = (down | ~(xh | up)) & full
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < least:
                least = score
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up = (mh | ~(xv | ph)) & full
        down = ph & xv
    return least


def supported(starts: list[int], item: int, index: Index) -> list[int]:
    """The starts that another anchor of the item confirms within its edits; all of them where anchors are few."""
    if not index.paired[item]:
        return starts
    if len(starts) == 1:
        return []
    starts.sort()
    slack = int(index.most_edits[item])
    near = [b - a <= slack for a, b in zip(starts, starts[1:])]
    return [s for s, before, after in zip(starts, [False, *near], [*near, False]) if before or after]


def may_hold(grams: list[str], slack: int, text: str) -> bool:
    """Whether enough of an item's trigrams are left: an edit destroys at most three of them."""
    there = {text[i : i + 3] for i in range(len(text) - 2)}
    return sum(map(there.__contains__, grams)) >= len(grams) - 3 * slack


def unchanged(ws: list[str], string: str, index: Index) -> set[int]:
    """The items that stand unchanged where their anchor words stand."""
    hits = [i for i, w in enumerate(ws) if w in index.anchors]
    if not hits:
        return set()
    last = hits[-1] + 1
    sizes = np.fromiter(map(len, ws[:last]), np.int64, last)
    offsets = (np.cumsum(sizes + 1) - sizes - 1)[hits].tolist()
    starts = defaultdict(list)
    for i, offset in zip(hits, offsets):
        for item, off in index.anchors[ws[i]]:
            starts[item].append(offset - off)
    return {
        item
        for item, found in starts.items()
        if any(string.startswith(index.strings[item], max(start, 0)) for start in supported(found, item, index))
    }


def matches(texts: Iterable[str], index: Index) -> Iterator[tuple[int, int, int]]:
    """``(text number, item number, edits)`` of every item found in every text; memory follows the longest text."""
    held, size = [], 0
    for row, text in enumerate(texts):
        ws = words(text)
        string = " ".join(ws)
        if index.anchors:
            for item in unchanged(ws, string, index):
                yield row, item, 0
        if index.pieces and string:
            held.append((row, string))
            size += len(string)
        if size > HELD:
            yield from confirmed(held, index)
            held, size = [], 0
    yield from confirmed(held, index)


def places(text: np.ndarray, pieces: Pieces, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(item, position, piece)`` of pieces that stand where enough of their item may.

    The pieces left of an item stand on diagonals no further apart than its edits, so in two neighbouring strips of that width.
    The text goes through in spans that overlap by the longest item with its edits.
    """
    overlap = int((index.lengths + index.most_edits).max())
    width = (index.most_edits + 1).astype(np.int32)
    longest = int(index.lengths.max())
    for begin in range(0, len(text), SPAN):
        bucket = buckets(text[begin : begin + SPAN + overlap], pieces.length)
        count = pieces.first[bucket + np.uint32(1)] - pieces.first[bucket]
        at = np.flatnonzero(count).astype(np.int32)
        count = count[at]
        ends = np.cumsum(count, dtype=np.int64)
        if not len(ends):
            continue
        which = np.arange(ends[-1], dtype=np.int64) + np.repeat(pieces.first[bucket[at]] - (ends - count), count)
        at = np.repeat(at, count)
        item = pieces.item[which]
        strips = (len(bucket) + longest) // width + 2
        base = np.cumsum(strips) - strips
        strip = base[item] + (at - pieces.offset[which] + np.int32(longest)) // width[item]
        full = np.bincount(strip, minlength=int(strips.sum()))
        pair = full[:-1] + full[1:]
        enough = pair >= np.repeat(index.cut - index.most_edits, strips)[:-1]
        marked = np.zeros(len(full), bool)
        marked[:-1] |= enough
        marked[1:] |= enough
        kept = np.flatnonzero(marked[strip])
        yield item[kept], at[kept].astype(np.int64) + begin, which[kept]


def clusters(text: np.ndarray, bases: np.ndarray, index: Index) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """``(text number, item, starts, edits)``: neighbouring starts of windows within a text and the fewest edits they allow."""
    for pieces in index.pieces:
        found = list(places(text, pieces, index))
        if not found:
            continue
        item, position, which = (np.concatenate(x) for x in zip(*found))
        of = np.searchsorted(bases, position, "right") - 1
        start = position - pieces.offset[which]
        order = np.lexsort((start, of, item))
        item, of, start, number = item[order], of[order], start[order], pieces.number[which[order]]
        apart = (np.diff(item) != 0) | (np.diff(of) != 0) | (np.diff(start) > index.most_edits[item[1:]])
        group = np.concatenate([[0], np.cumsum(apart)]) if len(item) else np.zeros(0, np.int64)
        firsts = np.flatnonzero(np.concatenate([[True], apart])) if len(item) else np.zeros(0, np.int64)
        different = np.unique(group * (int(index.cut.max()) + 1) + number) // (int(index.cut.max()) + 1)
        fewest = np.maximum(index.cut[item[firsts]] - np.bincount(different, minlength=len(firsts)), 0)
        lasts = np.append(firsts[1:], len(item))
        for g in np.flatnonzero(fewest <= index.most_edits[item[firsts]]):
            a, b = firsts[g], lasts[g]
            yield int(of[a]), int(item[a]), np.unique(start[a:b]), int(fewest[g])


def confirmed(held: list, index: Index) -> Iterator[tuple[int, int, int]]:
    if not held:
        return
    # A stretch that reaches over the gap between two texts would have too many edits, and no strips meet across it.
    gap = np.full(2 * int((index.lengths + index.most_edits).max()) + 2, PAD, np.uint8)
    text = np.concatenate([part for _, string in held for part in (codes(string), gap)])
    bases = np.cumsum([0, *[len(string) + len(gap) for _, string in held[:-1]]])
    laid = list(clusters(text, bases, index))
    if not laid:
        return
    sizes = [len(starts) for _, _, starts, _ in laid]
    items = np.repeat(np.array([item for _, item, _, _ in laid], np.int64), sizes)
    sampled = sampled_alike(text, np.maximum(np.concatenate([s for _, _, s, _ in laid]), 0), items, index)
    found = np.bincount(np.repeat(np.arange(len(laid)), sizes), weights=sampled, minlength=len(laid)) > 0
    best, known = {}, {}
    # What sampling has found comes first; other places are looked at where they may hold fewer edits.
    for c in np.argsort(~found, kind="stable"):
        d, item, starts, fewest = laid[c]
        pattern, slack = index.strings[item], int(index.most_edits[item])
        if fewest >= best.get((d, item), slack + 1):
            continue
        if item not in known:
            known[item] = masks(pattern), [pattern[i : i + 3] for i in range(len(pattern) - 2)]
        mask, grams = known[item]
        low, high = int(starts[0] - bases[d]), int(starts[-1] - bases[d])
        region = held[d][1][max(low - slack, 0) : high + len(pattern) + 2 * slack]
        if not may_hold(grams, slack, region):
            continue
        edits = edit_distance(pattern, mask, region)
        if edits <= slack:
            best[d, item] = min(edits, best.get((d, item), edits))
    for (d, item), edits in best.items():
        yield held[d][0], item, edits


def blocks(benchmark: DataFrame, most: int = BLOCK) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded size, one at a time on the driver: the query set of the search."""
    held, size = [], 0
    for row in benchmark.toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size > most:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    edits: float = EDITS,
    **sampling,
) -> DataFrame:
    """Rows ``doc_id, item_id, edits, similarity``: a benchmark item that stands in a document with at most ``edits`` times
    its length in edits, over words in lower case joined by single spaces.

    Documents are read whole, once per block of the benchmark (4 MB).  Items without words are never found; items under
    20 characters only unchanged.  Null and empty documents hold nothing.  Repeated documents give repeated rows, repeated
    items one.  An empty benchmark gives no rows.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text)
    items = own_columns(benchmark, item_id=item_id, text=item_text)
    # The driver asks for the items a partition at a time, each a job of its own: written, they are as few as their size allows.
    items = stored(items.where(text_of("text").rlike(r"[\p{L}\p{N}]")).distinct(), "items")
    kinds = [rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1].simpleString()}, edits bigint, similarity double"
    found = [docs.sparkSession.createDataFrame([], schema)]
    for block in blocks(items):
        block = [(i, t) for i, t in block if words(t)]
        if block:
            shared = docs.sparkSession.sparkContext.broadcast(build_index(block, edits, **sampling))
            found.append(rows.mapInArrow(finder(shared, kinds[1]), schema))
    out = found[-1] if len(found) == 2 else found[0]
    for more in found[1:] if len(found) > 2 else []:
        out = out.unionAll(more)
    return out


def finder(shared, item_kind):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        index: Index = shared.value
        for batch in batches:
            hits = list(matches((t.as_py() or "" for t in batch.column(1)), index))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([row for row, _, _ in hits], pa.int64())),
                    pa.array([index.ids[item] for _, item, _ in hits], to_arrow_type(item_kind)),
                    pa.array([e for _, _, e in hits], pa.int64()),
                    pa.array([1 - e / len(index.strings[item]) for _, item, e in hits], pa.float64()),
                ],
                names=["doc_id", "item_id", "edits", "similarity"],
            )

    return find


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in which a benchmark item was found.

    A row is known by its id and its text, so rows without an id and different texts under one id are told apart.
    """
    own, hit, words_of, sha = unused(docs, "_row", "_found", "_words", "_sha")
    hashed = F.sha2(text_of(f"`{text}`"), 256)
    rows = docs.select(F.struct(F.col(f"`{doc_id}`").alias("id"), hashed.alias("sha")).alias(own), F.col(f"`{text}`").alias(words_of))
    found = find_passages(rows, benchmark, own, words_of, **options).select(F.col("doc_id.id").alias(hit), F.col("doc_id.sha").alias(sha))
    here = F.col(f"`{doc_id}`").eqNullSafe(F.col(hit)) & (hashed == F.col(sha))
    return docs.join(found.distinct(), here, "left_anti")
