"""Near duplicates by an LSH forest over MinHash signatures.

A signature is read as several paths, one per tree.  In every tree the documents that share the head of their path with another
stand sorted by their paths, and each is a candidate with the neighbours that share the longest prefix with it: where a region
is dense, neighbours agree to a greater depth.  Candidates are confirmed on whole shingle sets.

What neighbours leave open is completed exactly, among documents that share a region but no component: in small regions pair
by pair, for documents of dense regions by a prefix filter.  With all shingles in one order, rare ones first, two sets that
reach the similarity share a shingle near the beginning of both; those beginnings are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.llm.components import components, joined_components
from hustings.llm.tables import own_columns, stored, text_of, unused
from hustings.operators.skew import spread_join

WORDS, SIMILARITY = 5, 80
# Steps of a path that are its own, that make a region, and by which neighbours are sorted; neighbours on either side.
TREES, PATH, SHALLOW, DEEP, NEIGHBOURS = 24, 5, 4, 24, 2
SMALL, BLOCK, OFTEN = 16, 512, 32
# Shingles are ordered by counts in so many buckets; lists of a shingle are joined up to so many pairs, else compared in blocks.
BUCKETS, LIGHT = 1 << 18, 1 << 12
ROWS = 2048
SEEDS = np.random.default_rng(11).integers(0, 1 << 63, TREES * PATH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)
OUTPUT = 8 << 20


class WordHashes(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(ws: list[bytes], n: int, known: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``n``-word shingles; a shorter text is one shingle, no words are none."""
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    take = min(n, len(ws))
    mixed = np.full(len(ws) - take + 1, take, np.uint64)
    for i in range(take):
        mixed = (mixed ^ h[i : len(h) - take + 1 + i]) * MIX
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The upper halves of the least products with every seed; in blocks, so memory does not follow the set's size."""
    least = np.full(len(SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), ROWS):
        np.minimum(least, (hashes[at : at + ROWS, None] * SEEDS[None, :]).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketcher(n: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = WordHashes()
            size, key, signs = [], [], []
            for text in batch.column(2):
                ws = split_words(text.as_py())
                found = shingles(ws, n, known)
                size.append(len(found))
                key.append(xxhash.xxh3_128_digest(b" ".join(ws)))
                signs.append(signature(found))
                if len(known) > 1 << 20:
                    known.clear()
            values = pa.array(np.concatenate(signs) if signs else np.zeros(0, np.int32))
            signs = pa.FixedSizeListArray.from_arrays(values, len(SEEDS)).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(key, pa.binary()), signs],
                names=["doc_id", "sha", "n_shingles", "key", "sign"],
            )

    return sketch


def confirmer(n: int, similarity: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, sets, held = WordHashes(), {}, 0
            keep = []
            a, b, ta, tb = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                both = []
                for own, text in ((a[i].as_py(), ta[i]), (b[i].as_py(), tb[i])):
                    if own not in sets:
                        if held > OUTPUT:
                            sets, held = {}, 0
                        sets[own] = shingles(split_words(text.as_py()), n, known)
                        held += len(sets[own]) * 8
                    both.append(sets[own])
                x, y = both
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * shared >= similarity * (len(x) + len(y) - shared):
                    keep.append(i)
            taken = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(taken), b.take(taken)], names=["a", "b"])

    return confirm


def path(tree: Column, sign: Column, depth: int) -> Column:
    """The first ``depth`` steps of a tree's path; behind its own steps a path goes on with the next tree's."""
    return F.slice(sign if depth <= PATH else F.concat(sign, sign), tree * PATH + 1, F.lit(depth))


def regions(signs: DataFrame, at_most: int | None = None) -> DataFrame:
    """Rows ``doc, size, tree, h, n``: the regions (``h``) of at least two documents, with their number ``n``.

    ``signs`` has ``doc, size, sign``, and no more than ``at_most`` rows if that is given.
    """
    heads = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.struct(t.alias("tree"), F.xxhash64(t, path(t, F.col("sign"), SHALLOW)).alias("h")),
    )
    rows = signs.select("doc", "size", F.explode(heads).alias("p")).select("doc", "size", "p.tree", "p.h")
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    most = None if at_most is None else TREES * at_most
    return stored(spread_join(rows, counts.withColumn("n", F.col("_n")), ["h"], ["doc"], "inner", at_most=most), "regions")


def next_to_each_other(similarity: int, neighbours: int):
    """Pairs ``a, b`` of sorted rows ``tree, path, doc, size`` that stand at most ``neighbours`` places apart in one tree and
    share the steps of a region, if their sizes allow the similarity."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if before is None else pa.concat_tables([before, table]).combine_chunks()
            new = 0 if before is None else before.num_rows
            before = table.slice(max(table.num_rows - neighbours, 0))
            tree, doc, size = (table.column(c).to_numpy() for c in ("tree", "doc", "size"))
            steps = table.column("path").combine_chunks()
            steps = np.asarray((steps.chunk(0) if isinstance(steps, pa.ChunkedArray) else steps).flatten()).reshape(len(doc), -1)
            found = []
            for apart in range(1, neighbours + 1):
                at = np.arange(max(new, apart), len(doc))
                other = at - apart
                same = (tree[at] == tree[other]) & (steps[at, :SHALLOW] == steps[other, :SHALLOW]).all(axis=1)
                fits = np.minimum(size[at], size[other]) * 100 >= np.maximum(size[at], size[other]) * similarity
                at, other = at[same & fits], other[same & fits]
                found.append(np.stack([np.minimum(doc[at], doc[other]), np.maximum(doc[at], doc[other])], axis=1))
            pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return pair


def sorted_neighbours(shallow: DataFrame, signs: DataFrame, similarity: int) -> DataFrame:
    """Candidates ``a, b`` from the sorted orders of all trees.

    An order is cut into ranges, by path and document, so a dense region may spread over many; two rows on either side of a
    cut are no candidates here.
    """
    paths = shallow.select("doc", "size", "tree").join(signs.select("doc", "sign"), "doc")
    rows = paths.select("tree", path(F.col("tree"), F.col("sign"), DEEP).alias("path"), "doc", "size")
    ranges = int(signs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "path", "doc"]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(next_to_each_other(similarity, NEIGHBOURS), "a bigint, b bigint").distinct()


def alike(n: Column, m: Column, similarity: int) -> Column:
    """Whether sets of these sizes can reach the similarity."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * similarity


def ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with the component of ``doc``, which is its own where it has no link."""
    return rows.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc"))


def open_pairs(marked: DataFrame, similarity: int) -> DataFrame:
    """All pairs within small regions whose documents are not yet in one component."""
    member = F.struct("doc", "size", "label")

    def partners(x: Column) -> Column:
        others = F.filter("m", lambda y: (x["doc"] < y["doc"]) & (x["label"] != y["label"]) & alike(x["size"], y["size"], similarity))
        return F.transform(others, lambda y: F.struct(x["doc"].alias("a"), y["doc"].alias("b")))

    groups = marked.groupBy("h").agg(F.collect_set(member).alias("m"))
    groups = groups.where(F.size(F.array_distinct("m.label")) > 1)
    return groups.select(F.explode(F.flatten(F.transform("m", partners))).alias("p")).select("p.a", "p.b").distinct()


def block_pairs(rows: DataFrame, weight: Column, at_most: int | None = None) -> DataFrame:
    """Rows ``g, doc, size, label`` of groups, once for every pair of blocks ``i, j`` of their group that their ``block`` is in.

    A block has members of about ``BLOCK`` units of ``weight``.  Members of the label that holds a quarter of its group or
    more have blocks of their own, which do not meet each other; a group of one label has no blocks.  ``at_most`` as for
    ``spread_join``.
    """
    per = rows.groupBy("g", "label").agg(F.count(F.lit(1)).alias("held"), F.sum(weight).alias("w"))
    facts = per.groupBy("g").agg(
        F.max(F.struct("held", "label", "w")).alias("top"),
        F.sum("held").alias("_n"),
        F.sum("w").alias("w"),
        F.count(F.lit(1)).alias("kinds"),
    ).where("kinds > 1")
    own = F.col("top.held") * 4 >= F.col("_n")
    blocks = facts.select(
        "g",
        "_n",
        F.when(own, F.col("top.label")).alias("top"),
        F.ceil((F.col("w") - F.when(own, F.col("top.w")).otherwise(0)) / BLOCK).alias("k"),
        F.when(own, F.ceil(F.col("top.w") / BLOCK)).otherwise(0).alias("k_top"),
    )
    placed = spread_join(rows, blocks, ["g"], ["doc"], "inner", at_most=at_most)
    top = F.coalesce(F.col("label") == F.col("top"), F.lit(False))
    turn = F.xxhash64("doc", F.lit("block"))
    block = F.when(top, F.col("k") + F.pmod(turn, F.greatest("k_top", F.lit(1)))).otherwise(F.pmod(turn, F.col("k")))
    last = F.when(top, F.col("k")).otherwise(F.col("k") + F.col("k_top")) - 1
    met = placed.withColumn("block", block).select(
        "g", "doc", "size", "label", "block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("c")
    )
    return met.select(
        "g", F.least("block", "c").alias("i"), F.greatest("block", "c").alias("j"), "doc", "size", "label", "block"
    )


def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that follow each other with equal ``g, i, j``, whatever batches they come in."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and last != tuple(keys[a]):
                yield pa.Table.from_batches(held)
                held = []
            last = tuple(keys[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``, exactly.

    Elements of many sets are counted by a product of matrices, the others place by place.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets)
    order = np.argsort(element, kind="stable")
    owner, (_, number, times) = owner[order], np.unique(element[order], return_inverse=True, return_counts=True)
    out = np.zeros((len(left), len(right)), np.float32)
    often = np.flatnonzero(times >= OFTEN)
    column = np.full(len(times), -1)
    column[often] = np.arange(len(often))
    column = column[number]
    for at in range(0, len(often), ROWS):
        here = (column >= at) & (column < at + ROWS)
        held = np.zeros((len(sets), ROWS), np.float32)
        held[owner[here], column[here] - at] = 1
        out += held[left] @ held[right].T
    rare = column < 0
    owner, number = owner[rare], number[rare]
    place = [np.full(len(sets), -1) for _ in range(2)]
    place[0][left], place[1][right] = np.arange(len(left)), np.arange(len(right))
    counted = np.zeros(out.size, np.int64)
    for step in range(1, OFTEN):
        at = np.flatnonzero(number[step:] == number[:-step])
        if not len(at):
            break
        p, q = owner[at], owner[at + step]
        for x, y in ((p, q), (q, p)):
            met = (place[0][x] >= 0) & (place[1][y] >= 0)
            np.add.at(counted, place[0][x[met]] * len(right) + place[1][y[met]], 1)
    return out.astype(np.int64) + counted.reshape(out.shape)


def spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all linked pairs as few as connect the same of ``n`` members, each with a partner closer to the smallest one."""
    root, by = np.arange(n), np.arange(n)
    while True:
        before = root.copy()
        for mine, other, pairs in ((left, right, linked), (right, left, linked.T)):
            reach = np.where(pairs, root[other][None, :], n)
            at = reach.argmin(axis=1)
            least = reach[np.arange(len(mine)), at]
            better = least < root[mine]
            by[mine[better]] = other[at[better]]
            root[mine[better]] = least[better]
        if (before == root).all():
            moved = np.flatnonzero(by != np.arange(n))
            return moved, by[moved]


def comparer(similarity: int, tell: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray]):
    """Pairs ``a, b`` that connect what ``tell`` links between the two blocks of every group, among pairs of different
    labels whose sizes allow the similarity."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_groups(batches):
            i, j = (table.column(c)[0].as_py() for c in (1, 2))
            block = table.column("block").to_numpy()
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            size = table.column("size").to_numpy()
            label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            x, y = size[left][:, None], size[right][None, :]
            may = (label[left][:, None] != label[right][None, :]) & (np.minimum(x, y) * 100 >= np.maximum(x, y) * similarity)
            if not may.any():
                continue
            a, b = spanning(may & tell(table, left, right), left, right, len(size))
            doc = table.column("doc").combine_chunks()
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(a)), doc.take(pa.array(b))], names=["a", "b"])

    return compare


def exactly(n: int, similarity: int):
    """Whole shingle sets that reach the similarity."""

    def tell(table: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        known = WordHashes()
        sets = [shingles(split_words(text.as_py()), n, known) for text in table.column("text")]
        sizes = np.array([len(s) for s in sets])
        both = overlaps(sets, left, right)
        return 100 * both >= similarity * (sizes[left][:, None] + sizes[right][None, :] - both)

    return comparer(similarity, tell)


def by_blocks(rows: DataFrame, further: DataFrame, compare, kind: str) -> DataFrame:
    """Links ``a, b`` that ``compare`` finds in the pairs of blocks ``rows``, with a further column of every ``doc``."""
    whole = rows.join(further, "doc").select("g", "i", "j", "block", "doc", "size", "label", further.columns[1])
    dealt = whole.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return dealt.mapInArrow(compare, f"a {kind}, b {kind}")


def bucket_counts(n: int):
    """How many of a batch's sets hold a shingle of each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        known = WordHashes()
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(held, (shingles(split_words(text.as_py()), n, known) % BUCKETS).astype(np.int64), 1)
                if len(known) > 1 << 20:
                    known.clear()
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["bucket", "n"])

    return count


def beginnings(shared, n: int, similarity: int):
    """The shingles by which a set can be found: rows ``token, place, short, doc, size, label``.

    With places counted in the order of all shingles, the first that two sets share leaves enough of both behind it.
    ``short`` rows allow a partner that is at least as large, the others one that is at most as large.
    """

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: np.ndarray = shared.value
        for batch in batches:
            known = WordHashes()
            tokens, places, shorts, owners = [], [], [], []
            size = batch.column("size").to_numpy()
            for row, text in enumerate(batch.column("text")):
                own = shingles(split_words(text.as_py()), n, known)
                own = own[np.lexsort([own, counts[(own % BUCKETS).astype(np.int64)]])]
                left = len(own) - np.arange(len(own))
                # A larger partner of size b needs b <= left * (100 + s) / s - size; the smallest such b is the own size.
                short = left * (100 + similarity) >= 2 * similarity * len(own)
                # A smaller one of size a is at least s % of the own size.
                least = -(-similarity * len(own) // 100)
                long = left * (100 + similarity) >= similarity * (len(own) + least)
                take = np.flatnonzero(long)
                tokens.append(own[take].view(np.int64))
                places.append(take)
                shorts.append(short[take])
                owners.append(np.full(len(take), row))
            if not tokens:
                continue
            owner = pa.array(np.concatenate(owners))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens)),
                    pa.array(np.concatenate(places)),
                    pa.array(np.concatenate(shorts)),
                    batch.column("doc").take(owner),
                    pa.array(size[owner.to_numpy()], pa.int64()),
                    batch.column("label").take(owner),
                ],
                names=["token", "place", "short", "doc", "size", "label"],
            )

    return begin


def dense_links(dense: DataFrame, texts: DataFrame, n: int, similarity: int) -> tuple[DataFrame, DataFrame | None]:
    """Candidates to be confirmed, and links, if any, that need it no more: together they connect all documents of dense regions that
    are linked at all, in place of those within one component.

    ``dense`` has ``doc, size, label``.  Every text goes through twice, to count its shingles in buckets (a sum of bounded
    size, which only orders them) and to emit its beginning.  A shingle that few beginnings hold gives pairs; under one that
    many hold, whose pairs would be too many, the documents are compared block against block.
    """
    spark = dense.sparkSession
    held = stored(dense.join(texts.toDF("doc", "text"), "doc"), "dense")
    counted = held.mapInArrow(bucket_counts(n), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    schema = "token bigint, place bigint, short boolean, doc bigint, size bigint, label bigint"
    rows = stored(held.mapInArrow(beginnings(shared, n, similarity), schema), "beginnings")
    most = rows.count()
    lists = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("short").alias("shorter"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    lists = stored(lists.where("_n > 1 and shorter > 0 and low < high").select("token", "_n", (F.col("_n") * F.col("shorter")).alias("pairs")), "lists")
    light = spread_join(rows, lists.where(F.col("pairs") <= LIGHT).drop("pairs"), ["token"], ["doc"], "inner", at_most=most)
    larger = light.select("token", *[F.col(c).alias(f"l_{c}") for c in ("place", "doc", "size", "label")])
    met = spread_join(light.where("short"), larger, ["token"], ["doc"], "inner", at_most=most)
    left = F.least(F.col("size") - F.col("place"), F.col("l_size") - F.col("l_place"))
    fits = (F.col("size") <= F.col("l_size")) & (left * (100 + similarity) >= similarity * (F.col("size") + F.col("l_size")))
    pairs = met.where((F.col("label") != F.col("l_label")) & alike(F.col("size"), F.col("l_size"), similarity) & fits)
    pairs = stored(pairs.select(*ordered(F.col("doc"), F.col("l_doc"))).distinct(), "open-pairs")
    heavy = lists.where(F.col("pairs") > LIGHT)
    links = None
    if not heavy.isEmpty():
        members = spread_join(rows, heavy.drop("pairs"), ["token"], ["doc"], "inner", at_most=most)
        members = stored(members.select(F.col("token").alias("g"), "doc", "size", "label"), "members")
        family = block_pairs(members, F.col("size") / 512 + 1, most)
        links = by_blocks(family, texts.toDF("doc", "text"), exactly(n, similarity), "bigint").distinct()
    return pairs, links


def confirmed(pairs: DataFrame, texts: DataFrame, n: int, similarity: int) -> DataFrame:
    """Of pairs ``a, b`` those whose whole shingle sets reach the similarity; ``texts`` has ``doc, text``."""
    # Both sides are plain shuffles, so adaptive execution splits a centre that stands in very many pairs.
    two = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    kind = pairs.schema["a"].dataType.simpleString()
    return two.select("a", "b", "ta", "tb").mapInArrow(confirmer(n, similarity), f"a {kind}, b {kind}")


def clustered(docs: DataFrame, doc_id: str, text: str, words: int, similarity: int, nameless: bool) -> DataFrame:
    """``doc_id, sha, n_shingles, best`` of every row: ``best`` is the row (``none, doc_id, sha``) that stands for its
    component, the one with the smallest id, null for rows that take no part.  ``nameless`` rows without an id take part or not."""
    rows = own_columns(docs, doc_id=doc_id, text=text).select("doc_id", sha_of("text").alias("sha"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketches = stored(
        rows.mapInArrow(sketcher(words), f"doc_id {kind}, sha binary, n_shingles bigint, key binary, sign array<int>"), "sketches"
    )
    most = sketches.count()
    part = F.col("n_shingles") > 0
    if not nameless:
        part &= F.col("doc_id").isNotNull()
    # Texts with equal words are one document of the forest, known by a number of its own.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "sha"))
    per_key = sketches.where(part).groupBy("key").agg(
        first.alias("rep"), F.count(F.lit(1)).alias("_n"), F.first("n_shingles").alias("size"), F.first("sign").alias("sign")
    )
    copies = stored(per_key.withColumn("doc", F.monotonically_increasing_id()), "copies")
    signs = copies.select("doc", "size", "sign")
    shallow = regions(signs, most)
    wanted = copies.join(shallow.select("doc").distinct(), "doc", "left_semi").select("doc", F.col("rep.doc_id").alias("_id"), F.col("rep.sha").alias("_sha"))
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha"))
    texts = stored(rows.join(wanted, here).select("doc", "text").dropDuplicates(["doc"]), "texts")
    tried = stored(sorted_neighbours(shallow, signs, similarity), "neighbours")
    links = stored(confirmed(tried, texts, words, similarity), "links")
    labels = stored(components(links), "labels")
    marked = stored(labelled(shallow, labels), "marked")
    rest = open_pairs(marked.where(F.col("n") <= SMALL), similarity).join(tried, ["a", "b"], "left_anti")
    dense = marked.where(F.col("n") > SMALL)
    blockwise = None
    if not dense.isEmpty():
        pairs, blockwise = dense_links(dense.select("doc", "size", "label").distinct(), texts, words, similarity)
        rest = rest.unionAll(pairs)
    # All candidates go through one pair of joins with their texts.
    last = confirmed(rest, texts, words, similarity)
    if blockwise is not None:
        last = last.unionAll(blockwise)
    labels = joined_components(labels, stored(last, "links"))
    # Components have numbers; each is named after its smallest row.
    named = stored(labels.withColumnRenamed("node", "doc").join(copies.select("doc", "rep"), "doc"), "named")
    names = named.groupBy("label").agg(F.min("rep").alias("best"), F.count(F.lit(1)).alias("_n"))
    best = spread_join(named.select("doc", "label"), names, ["label"], ["doc"], "inner", at_most=most).drop("label")
    of_key = copies.join(best, "doc", "left").select("key", F.coalesce("best", "rep").alias("best"), "_n")
    whole = sketches.select("doc_id", "sha", "n_shingles", F.when(part, F.col("key")).alias("key"))
    return spread_join(whole, of_key, ["key"], ["doc_id", "sha"], at_most=most).drop("key")


def sha_of(text: str) -> Column:
    """What tells the texts under one id apart."""
    return F.unhex(F.md5(text_of(text)))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Texts are linked whose sets of ``words``-word shingles have a Jaccard similarity of at least ``similarity`` percent;
    ``component_id`` is the smallest id that links reach.  A text with fewer words is one shingle; a null text or one
    without words has none and is linked with nothing.  Texts with equal words are one document of the forest, so groups
    of copies cost nothing further.  Rows that share an id keep the component of their own text; a row without an id has a
    null component, links nothing and is kept.  No rows give no rows; further columns are not looked at.
    """
    found = clustered(docs, doc_id, text, words, similarity, False)
    component = F.coalesce("best.doc_id", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: int = SIMILARITY
) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.

    Rows without an id take part and come last in their component.  Rows equal in id and text stay or go together; rows without
    words stay.
    """
    found = clustered(docs, doc_id, text, words, similarity, True)
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("sha") == F.col("best.sha"))
    gone, sha = unused(docs, "_lost", "_sha")
    lost = found.where(F.col("best").isNotNull() & ~stays).select(F.col("doc_id").alias(gone), F.col("sha").alias(sha))
    here = F.col(f"`{doc_id}`").eqNullSafe(F.col(gone)) & (sha_of(f"`{text}`") == F.col(sha))
    return docs.join(lost, here, "left_anti")
