"""The trie of all conversations, by their first turns.

Every turn becomes an identifier of 16 bytes and every conversation a row of identifiers; texts stay where they are.  The rows
are cut into ranges of their lexicographic order, so copies and conversations with a hot first turn spread over many ranges.
Within a range NumPy sorts padded matrices of identifiers, strip by strip of columns.  Where a row differs from the one above
it in a column or in an earlier one (an OR along the columns), a node of that depth starts; ``reduceat`` over these starts
gives every node its numbers.  All numbers are sums over rows, given how far a range's first row agrees with the last row of
the range before it, so the few nodes that cross a border are added up afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hustings.llm.tables import own_columns, stored
from hustings.operators.skew import lookup

TURNS_A_SHARD = 1_000_000
CELLS = 1 << 22
WIDEST = 64
ID = 16

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
# kind: 0 a whole node, 1 a part of a node that crosses a border, 2 a conversation that ends in such a node.
PARTS = "kind int, " + ", ".join(f"{c} bigint" for c in NODE) + ", ends_sha256 string, key binary, parent_key binary"
NONE = hashlib.sha256().hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``ids``, an identifier per turn, and ``sizes``, the UTF-8 bytes of its text.

    Turns go by number (null first), those of one number by role and identifier.  Null roles and texts count as empty, rows
    without ``conv_id`` belong to no conversation.
    """
    rows = own_columns(turns, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        "turn",
        role.alias("role"),
        F.substring(F.unhex(F.sha2(named, 256)), 1, ID).alias("id"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    grouped = rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))


def rebuilt(given: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 5 in place of its own, h = crc32(c) % 9."""
    heads = given.select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, 8).alias("head_ids"), F.slice("sizes", 1, 8).alias("head_sizes")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    joined = given.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")

    def spliced(head: str, own: str) -> Column:
        return F.concat(
            F.slice(F.coalesce(head, F.slice(own, 1, 0)), F.lit(1), h), F.slice(own, h + 1, F.size(own))
        ).alias(own)

    return joined.select("conv_id", spliced("head_ids", "ids"), spliced("head_sizes", "sizes"))


def agreement(a: Column, b: Column) -> Column:
    """How many leading elements two arrays share; -1 if one of them is null."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    same = F.when(differs == 0, F.size(a)).otherwise(differs - 1)
    return F.when(a.isNull() | b.isNull(), -1).otherwise(same).cast("bigint")


def in_ranges(given: DataFrame, turns_a_shard: int) -> DataFrame:
    """The rows by ranges (``shard``) of their order, and how far a range's ends agree with its neighbours' (``back``, ``ahead``)."""
    spark = given.sparkSession
    given = stored(given, "sequences")
    turns = given.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // turns_a_shard))
    ranged = stored(given.repartitionByRange(shards, "ids", "conv_id").withColumn("shard", F.spark_partition_id()), "ranges")
    # One row per range.
    ends = ranged.groupBy("shard").agg(F.min(F.struct("ids")).alias("first"), F.max(F.struct("ids")).alias("last"))
    order = W.orderBy("shard")
    borders = ends.select(
        "shard",
        agreement(F.lag("last.ids").over(order), F.col("first.ids")).alias("back"),
        agreement(F.col("last.ids"), F.lead("first.ids").over(order)).alias("ahead"),
    )
    return ranged.join(F.broadcast(borders), "shard")


class Rows:
    """The rows of one range in lexicographic order, with their identifiers as pairs of machine words."""

    def __init__(self, shard: pa.Table):
        shard = shard.select(["conv_id", "ids", "sizes", "back", "ahead"]).combine_chunks()
        self.n = shard.num_rows
        self.conv = shard["conv_id"].to_numpy()
        self.back, self.ahead = shard["back"][0].as_py(), shard["ahead"][0].as_py()
        lists = shard["ids"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        self.len = lists.value_lengths().to_numpy().astype(np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.len)[:-1]])
        flat = lists.flatten()
        raw = flat.cast(pa.binary(ID)).buffers()[1] if len(flat) else None
        self.raw = raw.to_pybytes() if raw is not None else b""
        words = np.frombuffer(self.raw, ">u8").astype(np.uint64).reshape(-1, 2)
        # One more cell, for places that hold nothing.
        self.words = np.vstack([words, np.zeros((1, 2), np.uint64)])
        sizes = shard["sizes"].combine_chunks()
        sizes = sizes.chunk(0) if isinstance(sizes, pa.ChunkedArray) else sizes
        self.bytes_before = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy())])
        self.width = int(min(WIDEST, max(1, CELLS // max(self.n, 1))))
        self.sort()

    def cells(self, rows: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """The padded matrix of some rows' identifiers from column ``start``, and which cells hold one."""
        columns = start + np.arange(self.width)
        held = columns < self.len[rows, None]
        return self.words[np.where(held, self.off[rows, None] + columns, -1)], held

    def sort(self) -> None:
        by_conv = np.argsort(self.conv, kind="stable")
        last_strip = np.where(self.len[by_conv] > 0, (self.len[by_conv] - 1) // self.width, -1)
        entering = by_conv[np.argsort(-last_strip, kind="stable")]
        edges = np.searchsorted(np.sort(-last_strip), -np.arange(last_strip.max(initial=-1), -2, -1), "right")
        order, at = np.zeros(0, np.int64), 0
        for strip, edge in zip(range(int(last_strip.max(initial=-1)), -2, -1), edges):
            order, at = np.concatenate([entering[at:edge], order]), edge
            if strip >= 0:
                matrix, _ = self.cells(order, strip * self.width)
                order = order[np.lexsort(matrix.reshape(len(order), -1).T[::-1])]
        self.conv, self.len, self.off = self.conv[order], self.len[order], self.off[order]

    def strips(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Strip by strip: first column, rows that reach it, cells that hold a turn, cells in which a node starts."""
        changed = np.zeros(self.n, bool)
        rows = np.flatnonzero(self.len > 0)
        start = 0
        while len(rows):
            matrix, held = self.cells(rows, start)
            differs = np.ones(held.shape, bool)
            differs[1:] = (matrix[1:] != matrix[:-1]).any(axis=2)
            differs[1:][np.diff(rows) > 1] = True
            differs[:, 0] |= changed[rows]
            starts = np.logical_or.accumulate(differs, axis=1)
            changed[rows] = starts[:, -1]
            yield start, rows, held, starts & held
            start += self.width
            rows = rows[self.len[rows] > start]

    def agreements(self) -> np.ndarray:
        """For every row, how many leading turns it shares with the row above it."""
        shared = np.zeros(self.n, np.int64)
        for _, rows, held, starts in self.strips():
            shared[rows] += (held & ~starts).sum(axis=1)
        return shared

    def keys(self, row: int, depth: int) -> list[bytes]:
        """What names the nodes of a row down to a depth in all ranges."""
        running, out = hashlib.sha256(), [hashlib.sha256().digest()]
        at = int(self.off[row]) * ID
        for d in range(depth):
            running.update(self.raw[at + d * ID : at + (d + 1) * ID])
            out.append(running.copy().digest())
        return out


def nodes(shard: pa.Table) -> pa.Table:
    rows = Rows(shard)
    last = rows.n - 1
    shared = rows.agreements()
    shared[0] = max(rows.back, 0)
    below = np.append(shared[1:], rows.ahead)
    leaf_end = (below < rows.len).astype(np.int64)
    saved_to = rows.bytes_before[rows.off + shared]
    keys = (rows.keys(0, max(rows.back, 0)), rows.keys(last, max(rows.ahead, 0)))
    # Copies stand together: where each group of equal rows begins and ends.
    same = (rows.len[1:] == rows.len[:-1]) & (shared[1:] == rows.len[1:])
    first = np.concatenate([[True], ~same])
    group_end = np.append(np.flatnonzero(first)[1:], rows.n)[np.cumsum(first) - 1]
    out: list[list] = [[] for _ in range(11)]

    def side(start_row, end_row, depth):
        """By which border of the range a node goes on: 1 the first, 2 the last, 0 none."""
        return np.where((start_row == 0) & (depth <= rows.back), 1, np.where((end_row == last) & (depth <= rows.ahead), 2, 0))

    def emit(depth, start_row, conv, parent, n, children, leaves, saved, crosses, parent_crosses):
        """Nodes in arrays; those that cross a border go out as parts, with the conversations that end in them."""
        for i in range(len(depth)):
            d, r = int(depth[i]), int(start_row[i])
            ended = range(r, int(group_end[r])) if rows.len[r] == d else range(0)
            key = keys[crosses[i] - 1][d] if crosses[i] else None
            above = keys[parent_crosses[i] - 1][d - 1] if d and parent_crosses[i] else None
            names = ",".join(map(str, rows.conv[r : int(group_end[r])])) if ended and not key else ""
            sha = (hashlib.sha256(names.encode()).hexdigest() if names else NONE) if not key else None
            row = (1 if key else 0, int(conv[i]), d, None if above or not d else int(parent[i]), int(n[i]), int(children[i]), int(leaves[i]), int(saved[i]), sha, key, above)
            for column, value in zip(out, row):
                column.append(value)
            if key:
                for member in ended:
                    for column, value in zip(out, (2, int(rows.conv[member]), d, None, None, None, None, None, None, key, None)):
                        column.append(value)

    root = rows.conv.min()
    crosses = side(np.array([0]), np.array([last]), np.array([0]))
    new_child = (shared == 0) & (rows.len > 0)
    emit(
        [0], [0], [root], [None], [rows.n], [new_child.sum()], [leaf_end.sum()],
        [(saved_to - rows.bytes_before[rows.off]).sum()], crosses, crosses,
    )
    above_conv, above_side = np.full(rows.n, root), np.full(rows.n, crosses[0])
    for start, strip_rows, held, starts in rows.strips():
        column, which = np.nonzero(held.T)
        row, depth = strip_rows[which], start + column + 1
        begins = np.flatnonzero(starts.T[column, which])
        counted = np.diff(np.append(begins, len(row)))
        conv = np.minimum.reduceat(rows.conv[row], begins)
        goes_on = side(row[begins], row[begins + counted - 1], depth[begins])
        children = np.add.reduceat((shared[row] <= depth) & (rows.len[row] > depth), begins, dtype=np.int64)
        saved = np.where(shared[row] >= depth, saved_to[row] - rows.bytes_before[rows.off[row] + depth - 1], 0)
        # What stands one column to the left, for the parents.
        node = np.cumsum(starts.T[column, which]) - 1
        own_conv, own_side = np.zeros((rows.width + 1, len(strip_rows)), np.int64), np.zeros((rows.width + 1, len(strip_rows)), np.int64)
        own_conv[0], own_side[0] = above_conv[strip_rows], above_side[strip_rows]
        own_conv[column + 1, which], own_side[column + 1, which] = conv[node], goes_on[node]
        emit(
            depth[begins], row[begins], conv, own_conv[column, which][begins], counted, children,
            np.add.reduceat(leaf_end[row], begins), np.add.reduceat(saved, begins), goes_on, own_side[column, which][begins],
        )
        above_conv[strip_rows], above_side[strip_rows] = own_conv[-1], own_side[-1]
    kinds = [pa.int32(), *[pa.int64()] * 7, pa.string(), pa.binary(), pa.binary()]
    names = ["kind", *NODE, "ends_sha256", "key", "parent_key"]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)


def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, conv_id`` in order to the hash of each key's ids, which are never held together."""
    key, running, done = None, None, []
    for batch in batches:
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    done.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256(str(conv).encode())
            else:
                running.update(f",{conv}".encode())
    if key is not None:
        done.append((key, running.hexdigest()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.binary(), pa.string()))], names=["key", "ends_sha256"])


def trie(given: DataFrame, turns_a_shard: int = TURNS_A_SHARD) -> DataFrame:
    """One row per node of the trie of ``given`` (``conv_id, ids, sizes``, one row per conversation, as ``sequences`` gives).

    ``conv_id`` is the smallest conversation that begins with the node's turns, ``n_convs`` their number, ``n_children`` and
    ``n_leaves`` count nodes right below and childless nodes from here on, ``saved_tokens`` adds for all nodes from here on the
    bytes of the last text times ``n_convs - 1``, ``ends_sha256`` is the hash of the ids that end here.  The root has depth 0
    and no parent; a conversation without turns ends there.  Equal conversations are members of the same nodes.  No
    conversations give no nodes.  The driver holds the sample of rows that cuts the ranges.
    """
    shards = in_ranges(given, turns_a_shard)
    parts = stored(shards.groupBy("shard").applyInArrow(nodes, PARTS), "trie")
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    members = parts.where("kind = 2").select("key", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id")
    crossing = stored(
        parts.where("kind = 1")
        .groupBy("key")
        .agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in sums])
        .join(members.mapInArrow(ends, "key binary, ends_sha256 string"), "key", "left"),
        "crossing",
    )
    parents = crossing.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    columns = [*NODE, "ends_sha256"]
    whole = parts.where("kind = 0 and parent_key is null").select(columns)
    hanging = parts.where("kind = 0 and parent_key is not null").select(*columns, "parent_key")
    joined = crossing.withColumns({"ends_sha256": F.coalesce("ends_sha256", F.lit(NONE)), "parent_conv_id": F.lit(None).cast("bigint")})
    below = hanging.unionByName(joined.select(*columns, "parent_key"))
    known = lookup(below, parents, ["parent_key"], ["conv_id", "depth"])
    return whole.unionByName(known.withColumn("parent_conv_id", F.col("above")).select(columns))


def prefix_trie(turns: DataFrame, turns_a_shard: int = TURNS_A_SHARD) -> DataFrame:
    """The trie of the conversations in ``turns`` (``conv_id, turn, role, text``); further columns are not looked at."""
    return trie(sequences(turns), turns_a_shard)
