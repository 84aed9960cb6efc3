"""Find secrets through a trigram inverted index.

Every batch of documents is one shard of the index: postings are built for the trigrams that the rules ask for, the rules'
Boolean queries intersect and unite them, and only the documents that are left are matched with the regular expression.
Rules without mandatory trigrams scan every document.  Shards need no exchange between machines.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hustings.llm.secret_rules import BASE, RULES, Rule, trigram_query, trigrams
from hustings.llm.tables import bytes_of, own_columns

STRIDE = 1 << 21
LOWER = np.arange(256, dtype=np.uint32)
LOWER[65:91] += 32


def postings(data: np.ndarray, offsets: np.ndarray, wanted: list[bytes]) -> dict[bytes, np.ndarray]:
    """For each wanted trigram the rows that hold it; built in strides, so memory does not follow the text's length."""
    codes = np.array(sorted(int.from_bytes(t, "big") for t in wanted), np.uint32)
    asked = np.zeros(1 << 24, bool)
    asked[codes] = True
    rows, which = [], []
    for at in range(0, max(len(data) - 2, 0), STRIDE):
        low = LOWER[data[at : at + STRIDE + 2]]
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        hits = np.flatnonzero(asked[code])
        row = np.searchsorted(offsets, hits + at, "right") - 1
        inside = hits + at + 3 <= offsets[row + 1]
        pairs = np.unique(np.stack([code[hits[inside]].astype(np.int64), row[inside]]), axis=1)
        which.append(pairs[0])
        rows.append(pairs[1])
    which, rows = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (which, rows))
    return {t: np.unique(rows[which == int.from_bytes(t, "big")]) for t in wanted}


def candidates(query: tuple, index: dict[bytes, np.ndarray], every: np.ndarray) -> np.ndarray:
    if query[0] == "has":
        return index[query[1]]
    if query[0] == "every":
        return every
    parts = [candidates(q, index, every) for q in query[1:]]
    found = parts[0]
    for part in parts[1:]:
        found = np.intersect1d(found, part, assume_unique=True) if query[0] == "and" else np.union1d(found, part)
    return found


def spans(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    return [m.span() for m in compiled.finditer(text) if len(m.group(rule.group)) >= rule.least]


def written(found: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in sorted(found))


def scanner(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r) for r in rules]
        wanted = sorted(set().union(*map(trigrams, queries)))
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            every = np.arange(batch.num_rows)
            index = postings(data, offsets, wanted)
            left = [set(candidates(q, index, every).tolist()) for q in queries]
            base, full, counts = [], [], [[] for _ in BASE]
            for row, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                found = [
                    (a, k, b) for k, r in enumerate(rules) if row in left[k] for a, b in spans(r, compiled[k], text)
                ]
                own = [f for f in found if f[1] < len(BASE)]
                base.append(hashlib.sha256(written(own, rules).encode()).hexdigest())
                full.append(written(found, rules))
                for k, count in enumerate(counts):
                    count.append(sum(f[1] == k for f in own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(full, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return scan


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", more: tuple[Rule, ...] = RULES[len(BASE) :]) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` in code points, end exclusive, by start and then by the order of the rules; finds of
    one rule do not overlap, finds of different rules may.  Null and empty texts hold no secret: counts 0, ``spans`` empty,
    ``base_sha256`` that of the empty string.  Repeated rows give repeated results, a null id stays null, further columns
    are not looked at.  ``more`` adds rules to the base kinds.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return rows.mapInArrow(scanner(BASE + more), schema)
