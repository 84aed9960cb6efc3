"""Language identification by interpolated Kneser-Ney models over characters.

Character n-grams are counted over all training documents in tasks and smoothed with joins and aggregates; no n-gram is
left out.  A model of proven size is broadcast as sorted hash arrays with one column per language.  A larger one stays a set
of tables: documents are dealt into buckets, the different n-grams of each bucket are joined with the tables, and the answers
come back to the bucket as the sorted arrays of its own n-grams.  Both ways give the same numbers.  A document gets the language
with the lowest cross-entropy per character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.tables import held_out, own_columns, slices, stored, unused
from hustings.operators.skew import lookup, spread_join

ORDER = 4  # at least 2
# Cells (rows of all tables times languages) up to which a model is broadcast, as keys of 8 and cells of 4 bytes.
MOST_CELLS = 8_000_000
PIECE = 1 << 20
BUCKET_BYTES = 1 << 25
UNKNOWN = "und"
EDGE = 1  # between documents; stands in no letter


def _letters() -> np.ndarray:
    """For every code point whether it is a letter, built once per process."""
    if not hasattr(_letters, "table"):
        _letters.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters.table


def symbols(joined: str, after_letter: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of a lower-cased text, which of them are edges, and the places in the text they come from.

    Letters stand for themselves, whatever lies between two words is one 0.
    """
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    edges = points == EDGE
    letter = _letters()[points]
    follows = np.empty(len(points), bool)
    follows[:1] = after_letter
    follows[1:] = letter[:-1]
    keep = np.flatnonzero(letter | edges | (~letter & ~edges & follows))
    return np.where(letter, points, 0)[keep], edges[keep]


def runs(texts: list[str], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The symbols of all texts in stretches of about ``PIECE`` characters: symbols, the number of their text, and which of
    them are predicted.

    ``order - 1`` zeros stand before every text.  A longer text is cut into stretches that begin with the last ``order - 1``
    symbols before them, so memory does not follow a text's length and no context is lost.
    """
    edge = chr(EDGE) * (order - 1)
    lowered = [t.replace(chr(EDGE), " ").lower() for t in texts]
    for a, b in slices(map(len, lowered), PIECE):
        if b - a > 1 or len(lowered[a]) <= PIECE:
            x, edges = symbols(edge + edge.join(lowered[a:b]))
            yield x, a + np.cumsum(edges) // (order - 1) - 1, ~edges
            continue
        text, tail, after_letter = lowered[a], np.zeros(order - 1, np.uint32), False
        for start in range(0, len(text), PIECE):
            piece = text[start : start + PIECE]
            x = np.concatenate([tail, symbols(piece, after_letter)[0]])
            predicted = np.ones(len(x), bool)
            predicted[: order - 1] = False
            yield x, np.full(len(x), a), predicted
            tail, after_letter = x[len(x) - order + 1 :], bool(_letters()[ord(piece[-1])])


def hashes(rows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of symbols of one length."""
    h = np.full(len(rows), rows.shape[1], np.uint64)
    for column in rows.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def grams(x: np.ndarray, predicted: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of ``order`` symbols, as a view, and those that end at a predicted symbol."""
    return np.lib.stride_tricks.sliding_window_view(x, order), np.flatnonzero(predicted) - order + 1


def distinct(windows: np.ndarray, at: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number the windows by their content (and group); and the first place of each number."""
    from pandas import factorize

    h = np.zeros(len(at), np.uint64)
    columns = [windows[at, i] for i in range(windows.shape[1])]
    for column in columns if group is None else [group, *columns]:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    number, first = factorize(h)
    place = np.empty(len(first), np.int64)
    place[number[::-1]] = np.arange(len(at))[::-1]
    return number, place


def rows_of(windows: np.ndarray, at: np.ndarray, order: int) -> list[str]:
    """The windows at some places as strings, blanks for 0."""
    rows = np.ascontiguousarray(windows[at].astype(np.uint32))
    rows[rows == 0] = ord(" ")
    return rows.view(f"<U{order}").ravel().tolist()


def counter(order: int):
    """Counts of n-grams per language, as strings, for every piece of a batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, lang = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str), return_inverse=True)
            for x, document, predicted in runs(texts, order):
                if not predicted.any():
                    continue
                windows, at = grams(x, predicted, order)
                of = lang[document[at + order - 1]]
                number, place = distinct(windows, at, of)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[of[place]].tolist(), pa.string()),
                        pa.array(rows_of(windows, at[place], order), pa.string()),
                        pa.array(np.bincount(number, minlength=len(place)), pa.int64()),
                    ],
                    names=["lang", "gram", "n"],
                )

    return count


@dataclass
class Model:
    """``tables[k]``: sorted hashes of the (k+1)-grams and their log probabilities, one column per language, NaN where
    unseen.  ``backoffs[k]``: the same for contexts of k symbols with the log weight of the shorter context.  Both are empty
    in a model that is too large to be broadcast; ``kept`` are its stored tables.
    """

    languages: list[str]
    order: int
    tables: list[tuple[np.ndarray, np.ndarray]]
    backoffs: list[tuple[np.ndarray, np.ndarray]]
    floor: float
    mean: np.ndarray
    spread: np.ndarray
    kept: tuple[list[DataFrame], list[DataFrame]] | None = None

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """For rows of ``order`` symbols the log probability of the last one, per language."""
        p = np.full((len(rows), len(self.languages)), self.floor)
        for k in range(self.order):
            seen = looked_up(self.tables[k], rows[:, self.order - 1 - k :], np.nan)
            weight = looked_up(self.backoffs[k], rows[:, self.order - 1 - k : self.order - 1], 0.0)
            p = np.where(np.isnan(seen), p + np.nan_to_num(weight), seen)
        return p


def looked_up(table: tuple[np.ndarray, np.ndarray], part: np.ndarray, missing: float) -> np.ndarray:
    """The values of rows of symbols in a sorted table."""
    keys, values = table
    if not len(keys):
        return np.full((len(part), values.shape[1]), missing)
    h = hashes(part)
    i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where((keys[i] == h)[:, None], values[i], missing)


def cross_entropies(
    texts: list[str], order: int, languages: int, logs_of: Callable[[np.ndarray], np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Nats per symbol of every text in every language, and the number of symbols."""
    total, size = np.zeros((len(texts), languages)), np.zeros(len(texts), np.int64)
    for x, document, predicted in runs(texts, order):
        if not predicted.any():
            continue
        windows, at = grams(x, predicted, order)
        number, place = distinct(windows, at)
        logs = logs_of(windows[at[place]])
        of = document[at + order - 1]
        size += np.bincount(of, minlength=len(size))
        for j in range(languages):
            total[:, j] -= np.bincount(of, weights=logs[number, j], minlength=len(size))
    return total / np.maximum(size, 1)[:, None], size


def smoothed(counts: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame], int]:
    """Interpolated Kneser-Ney over rows ``lang, gram, n``: per order ``lang, gram, n, p`` and ``lang, gram, n, logw`` of the
    contexts, and the number of different symbols, one more for all others.

    The highest order has raw counts; below, an n-gram counts the different symbols seen before it.
    """
    levels = [counts]
    for k in range(order - 1, 0, -1):
        lower = levels[0].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.insert(0, stored(lower, f"grams-{k}"))
    alphabet = levels[0].select("gram").distinct().count() + 1
    tables, backoffs, below = [], [], None
    for k, level in enumerate(levels, 1):
        ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
        discount = level.groupBy("lang").agg(
            F.when(ones > 0, F.least(ones / (ones + 2 * twos), F.lit(0.95))).otherwise(0.5).alias("d")
        )
        context = level.withColumn("context", F.substring("gram", 1, k - 1))
        totals = (
            context.groupBy("lang", "context")
            .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            .join(discount, "lang")
            .withColumn("weight", F.col("d") * F.col("kinds") / F.col("total"))
        )
        known = context.join(totals, ["lang", "context"])
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        if below is None:
            known = known.withColumn("p", own + F.col("weight") / alphabet)
        else:
            shorter = below.select("lang", F.col("gram").alias("_short"), F.col("p").alias("_p"))
            known = known.withColumn("_short", F.substring("gram", 2, k - 1)).join(shorter, ["lang", "_short"])
            known = known.withColumn("p", own + F.col("weight") * F.col("_p"))
        below = stored(known.select("lang", "gram", "n", "p"), f"model-{k}")
        tables.append(below)
        backoffs.append(
            stored(totals.select("lang", F.col("context").alias("gram"), F.log("weight").alias("logw"), F.col("total").alias("n")), f"context-{k}")
        )
    return tables, backoffs, alphabet


def points_of(rows: list[str], k: int) -> np.ndarray:
    """Strings of k symbols as rows of symbols, 0 for blanks."""
    points = np.array(rows, f"<U{k}").view(np.uint32).reshape(-1, k).copy()
    points[points == ord(" ")] = 0
    return points


def sorted_arrays(table: DataFrame, languages: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    rows = table.toArrow()
    if not rows.num_rows:
        return np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32)
    if k:
        points = points_of(rows["gram"].to_pylist(), k)
    else:
        points = np.zeros((rows.num_rows, 0), np.uint32)
    keys, number = np.unique(hashes(points), return_inverse=True)
    values = np.full((len(keys), len(languages)), np.nan, np.float32)
    column = {name: i for i, name in enumerate(languages)}
    values[number, [column[name] for name in rows["lang"].to_pylist()]] = rows["v"].to_numpy()
    return keys, values


def train(docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, most_cells: int = MOST_CELLS) -> Model:
    """Learn from the whole text of all rows with a language.

    Counting and smoothing are Spark jobs over all n-grams.  The finished model comes to the driver, to be broadcast, only if
    its rows times its languages are at most ``most_cells``; otherwise it stays in its tables.
    """
    rows = own_columns(docs, text=text, lang=lang).where("lang is not null and text is not null")
    per_batch = rows.mapInArrow(counter(order), "lang string, gram string, n bigint")
    counts = stored(per_batch.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not languages:
        return Model([], order, [], [], 0.0, np.zeros(0), np.zeros(0))
    tables, backoffs, alphabet = smoothed(counts, order)
    log = F.log("p")
    # Mean and spread of the training cross-entropy per symbol, the base of the rejection.
    moments = tables[-1].groupBy("lang").agg(
        (-F.sum(F.col("n") * log) / F.sum("n")).alias("mean"), (F.sum(F.col("n") * log * log) / F.sum("n")).alias("square")
    )
    known = {r["lang"]: (r["mean"], r["square"]) for r in moments.collect()}
    mean = np.array([known[name][0] for name in languages])
    square = np.array([known[name][1] for name in languages])
    tables = [t.select("lang", "gram", log.cast("float").alias("v")) for t in tables]
    backoffs = [b.select("lang", "gram", F.col("logw").cast("float").alias("v")) for b in backoffs]
    cells = reduce(DataFrame.unionAll, [t.select("lang") for t in (*tables, *backoffs)]).count() * len(languages)
    facts = {"languages": languages, "order": order, "floor": -float(np.log(alphabet)), "mean": mean, "spread": np.sqrt(np.maximum(square - mean**2, 0.0))}
    if cells > most_cells:
        return Model(tables=[], backoffs=[], kept=(tables, backoffs), **facts)
    return Model(
        tables=[sorted_arrays(t, languages, k) for k, t in enumerate(tables, 1)],
        backoffs=[sorted_arrays(t, languages, k) for k, t in enumerate(backoffs)],
        **facts,
    )


def judged(model: Model, sharpness: float, slack: float, deviations: float, texts: list[str | None], logs_of) -> list[pa.Array]:
    """``lang_pred, score, rejected`` of some texts."""
    texts = [t or "" for t in texts]
    n = len(texts)
    if not model.languages or not n:
        return [pa.array([UNKNOWN] * n, pa.string()), pa.array(np.zeros(n)), pa.array(np.ones(n, bool))]
    entropy, size = cross_entropies(texts, model.order, len(model.languages), logs_of)
    best = entropy.argmin(axis=1)
    least = entropy[np.arange(n), best]
    score = 1 / np.exp(-sharpness * (entropy - least[:, None])).sum(axis=1)
    limit = model.mean[best] * (1 + slack) + deviations * model.spread[best] / np.sqrt(np.maximum(size, 1))
    known, rejected = size > 0, (size == 0) | (least > limit)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return [pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(rejected)]


ADDED = ["lang_pred", "score", "rejected"]


def by_broadcast(plain: DataFrame, model: Model, limits: tuple[float, float, float], schema: str) -> DataFrame:
    shared = plain.sparkSession.sparkContext.broadcast(model)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judged(shared.value, *limits, batch.column(0).to_pylist(), shared.value.log_probabilities)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], names=[*batch.schema.names[1:], *ADDED])

    return plain.mapInArrow(identify, schema)


def asked(order: int):
    """The different n-grams of each bucket, from batches of ``bucket, text, …``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = np.asarray(batch.column(0).to_pylist(), np.int64)
            for x, document, predicted in runs([t or "" for t in batch.column(1).to_pylist()], order):
                if not predicted.any():
                    continue
                windows, at = grams(x, predicted, order)
                of = buckets[document[at + order - 1]]
                _, place = distinct(windows, at, of)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[place], pa.int64()), pa.array(rows_of(windows, at[place], order), pa.string())], names=["bucket", "gram"]
                )

    return ask


def answers(grams_asked: DataFrame, model: Model) -> DataFrame:
    """``gram, logs``: the log probabilities per language of the distinct n-grams ``gram``, from the stored tables."""
    languages = F.array(*[F.lit(name) for name in model.languages])
    most = max(1_000_000 // (len(model.languages) + 2), 1)
    tables, backoffs = model.kept
    out = grams_asked

    def joined(out: DataFrame, table: DataFrame, key, name: str) -> DataFrame:
        wide = table.groupBy(F.col("gram").alias("_key")).agg(F.map_from_entries(F.collect_list(F.struct("lang", "v"))).alias(name))
        return lookup(out.withColumn("_key", key), stored(wide, name), ["_key"], ["gram"], "left", most).drop("_key")

    def next_order(logs, k: int):
        def value(p, lang):
            seen, weight = (F.try_element_at(F.col(f"{name}{k}"), lang).cast("double") for name in ("seen", "weight"))
            return F.coalesce(seen, p + F.coalesce(weight, F.lit(0.0)))

        return F.zip_with(logs, languages, value)

    logs = F.transform(languages, lambda _: F.lit(model.floor))
    for k in range(model.order):
        out = joined(out, tables[k], F.substring("gram", model.order - k, k + 1), f"seen{k}")
        out = joined(out, backoffs[k], F.substring("gram", model.order - k, k), f"weight{k}")
        logs = next_order(logs, k)
    return out.select("gram", logs.alias("logs"))


def by_join(plain: DataFrame, model: Model, limits: tuple[float, float, float], schema: str) -> DataFrame:
    """Rows are dealt by a hash of their columns, so copies spread too: once to ask for n-grams, once to meet the answers."""
    spark, order, facts = plain.sparkSession, model.order, replace(model, kept=None)
    first = plain.columns[0]
    size = plain.agg(F.sum(F.octet_length(f"`{first}`"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    hashed = [F.col(f"`{f.name}`") for f in plain.schema if f.dataType.typeName() not in ("map", "variant")]
    bucket = F.pmod(F.xxhash64(*hashed), F.lit(buckets)).alias("bucket")
    dealt = plain.select(bucket, *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(plain.columns)]).repartition(buckets, "bucket")
    requests = stored(dealt.mapInArrow(asked(order), "bucket bigint, gram string").distinct(), "asked")
    known = stored(answers(requests.select("gram").distinct(), model), "answers")
    given = spread_join(requests, known, ["gram"], ["bucket"], "inner")
    names = plain.columns[1:]

    def score(rows: pa.Table, logs: pa.Table) -> pa.Table:
        points = points_of(logs["gram"].to_pylist(), order) if logs.num_rows else np.zeros((0, order), np.uint32)
        values = np.array(logs["logs"].to_pylist(), np.float64).reshape(len(points), len(facts.languages))
        keys = hashes(points)
        in_order = np.argsort(keys)
        table = keys[in_order], values[in_order]
        found = judged(facts, *limits, rows["c0"].to_pylist(), lambda windows: looked_up(table, windows, np.nan))
        return pa.Table.from_arrays([*[rows[f"c{i}"] for i in range(1, len(names) + 1)], *found], names=[*names, *ADDED])

    return dealt.groupBy("bucket").cogroup(given.groupBy("bucket")).applyInArrow(score, schema)


def identify(
    docs: DataFrame, model: Model, text: str = "text", sharpness: float = 8.0, slack: float = 0.5, deviations: float = 4.0
) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` added (columns of these names are replaced).

    ``lang_pred`` is the language of lowest cross-entropy per symbol, ``und`` for a text that is null or has no letter;
    ties go to the first language by name.  ``score`` is the softmax of the cross-entropies, 0 for ``und``.  ``rejected``
    is true for ``und`` and where the lowest cross-entropy lies above that of the training texts by more than the share
    ``slack`` and ``deviations`` standard errors at the text's length.  A model without languages gives ``und`` only.
    Rows are not moved if the model is broadcast, otherwise twice, along with the different n-grams of each bucket.
    """
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    plain = docs.select(F.col(f"`{text}`").alias(unused(docs, "_text")[0]), *[F.col(f"`{c}`") for c in kept])
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in plain.schema[1:])
    way = by_broadcast if model.kept is None else by_join
    return way(plain, model, (sharpness, slack, deviations), f"{fields}, lang_pred string, score double, rejected boolean")


def predict_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most_cells: int = MOST_CELLS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score, rejected``, learned from rows not held out.

    Only text and language are learned from, only the text is predicted from.  Null ids are held out.  Repeated rows
    count and are predicted as often as they stand.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text, lang=lang).withColumn("held_out", held_out(F.col("doc_id")))
    model = train(rows.where("not held_out"), most_cells=most_cells)
    return identify(rows.select("doc_id", "held_out", "text"), model).drop("text")
