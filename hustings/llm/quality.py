"""Text quality by regularised quadratic discriminant analysis over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.tables import bytes_of, held_out, own_columns, stored

FEATURES = ("symbols", "shouts", "upper", "digits", "stops", "breaks", "word_length", "variety", "pair_variety")
# Character classes of the first five statistics; each share is drawn towards its usual value by PRIOR characters.
CLASSES = (b"#$%&*|<>{}[]\\^~=@_+`", b"!?", bytes(range(65, 91)), bytes(range(48, 58)), b".,;:")
USUAL = (0.001, 0.0005, 0.02, 0.002, 0.025)
PRIOR = 40.0
THRESHOLD = 0.3
STRIDE = 1 << 20


def statistics(batch_text) -> np.ndarray:
    """Transformed statistics of every text of an Arrow column, one row each; null counts as empty."""
    data, offsets = bytes_of(batch_text)
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    out = np.zeros((rows, len(FEATURES)))
    kinds = np.zeros(256, np.uint8)
    for k, members in enumerate(CLASSES, 1):
        kinds[list(members)] = k
    counts = np.zeros((len(CLASSES) + 1, rows), np.int64)
    # In strides, so memory does not follow the length of the texts.
    for at in range(0, len(data), STRIDE):
        of = kinds[data[at : at + STRIDE]]
        for k in range(1, len(CLASSES) + 1):
            row = np.searchsorted(offsets, np.flatnonzero(of == k) + at, "right") - 1
            counts[k] += np.bincount(row, minlength=rows)
    for k, usual in enumerate(USUAL, 1):
        out[:, k - 1] = np.sqrt((counts[k] + PRIOR * usual) / (size + PRIOR))
    for i, text in enumerate(batch_text):
        text = text.as_py() or ""
        words = text.split()
        n = len(words)
        pairs = len(set(zip(words, words[1:])))
        out[i, 5] = np.sqrt((text.count("\n") + PRIOR * 0.004) / (len(text) + PRIOR))
        out[i, 6] = np.log((sum(map(len, words)) + 5 * 5.5) / (n + 5))
        out[i, 7] = np.log((len(set(words)) + 10) / (n + 10)) / np.log(n + 20)
        out[i, 8] = (pairs + 10) / (max(n - 1, 0) + 10)
    return out


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = statistics(batch.column(1))
        x = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every row, made in one pass over the texts."""
    rows = own_columns(docs, doc_id=doc_id, text=text)
    return rows.mapInArrow(measure, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


@dataclass
class Discriminant:
    """Class means and inverse Cholesky factors of the shrunken covariances; margins become scores by a logistic curve."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    slope: float
    shift: float
    constant: float | None = None

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, from Mahalanobis distances."""
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            z = (x - mean) @ factor.T
            logs.append(offset - 0.5 * np.einsum("ij,ij->i", z, z))
        return logs[1] - logs[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(x) + self.shift, -40, 40)))


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class the number of rows, the sums and the sums of products: one aggregate, two rows to the driver."""
    d = len(FEATURES)
    x = F.col("x")
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    found = {}
    for row in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect():
        s = np.array([row[f"s{i}"] for i in range(d)])
        p = np.array([[row[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
        found[int(row["label"])] = (float(row["n"]), s, p)
    return found


def fit(labelled: DataFrame, pooling: float = 0.1, ridge: float = 0.05) -> Discriminant:
    """Fit on all rows ``x, label`` (0 or 1).

    A class covariance is drawn by ``pooling`` towards the pooled one and then by ``ridge`` towards the pooled variances.
    Margins are turned into scores by a logistic curve fitted on the margins of the same rows, gathered in bins of a
    quarter between -60 and 60.  With a class missing every score is the smoothed share of class 1.
    """
    labelled = stored(labelled.select("x", "label"), "labelled")
    found = moments(labelled)
    n0, n1 = (found.get(c, (0.0,))[0] for c in (0, 1))
    if min(n0, n1) < 1:
        return Discriminant(*[np.zeros(0)] * 3, 0.0, 0.0, (n1 + 1) / (n0 + n1 + 2))
    means, own = [], []
    for c in (0, 1):
        n, s, p = found[c]
        means.append(s / n)
        own.append(p / n - np.outer(s / n, s / n))
    pooled = (n0 * own[0] + n1 * own[1]) / (n0 + n1)
    target = np.diag(np.maximum(np.diag(pooled), 1e-9))
    factors, offsets = [], []
    for covariance in own:
        shrunk = (1 - ridge) * ((1 - pooling) * covariance + pooling * pooled) + ridge * target
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        offsets.append(-np.log(np.diag(lower)).sum())
    model = Discriminant(np.array(means), np.array(factors), np.array(offsets), 1.0, 0.0)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.clip(shared.value.margins(vectors(batch.column(0))), -60, 60)
            yield pa.RecordBatch.from_arrays([pa.array(np.round(m * 4).astype(np.int64)), batch.column(1)], names=["bin", "label"])

    binned = labelled.mapInArrow(bins, "bin bigint, label int").groupBy("bin", "label").count().collect()
    m = np.array([r["bin"] / 4 for r in binned])
    y = np.array([r["label"] for r in binned])
    w = np.array([r["count"] for r in binned], float)
    model.slope, model.shift = logistic(m, y, w)
    return model


def logistic(m: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic curve of y on m, by Newton steps with a slight penalty."""
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -40, 40)))
        gradient = np.array([(w * (y - p) * m).sum() - (a - 1.0), (w * (y - p)).sum() - 0.1 * b])
        v = w * p * (1 - p)
        hessian = np.array([[(v * m * m).sum() + 1.0, (v * m).sum()], [(v * m).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 1e-3), b


def vectors(column) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, len(FEATURES))


def score(measured_rows: DataFrame, model: Discriminant) -> DataFrame:
    """Rows ``doc_id, x`` with ``score`` in place of ``x``."""
    shared = measured_rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.scores(vectors(batch.column(1))), pa.float64())], names=["doc_id", "score"]
            )

    return measured_rows.select("doc_id", "x").mapInArrow(
        run, f"doc_id {measured_rows.schema['doc_id'].dataType.simpleString()}, score double"
    )


def predict_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Learned from the labelled rows that are not held out; only the text enters a score.  Null and empty texts are scored
    by the statistics of an empty text.  Labels other than 0 and 1, null labels and labels without a document are left
    out; an id with several labels or several rows counts once for each pair.  No rows give no rows.
    """
    rows = stored(measured(docs, doc_id, text), "statistics")
    given = own_columns(labels, doc_id=doc_id, label=label).where("label in (0, 1)")
    labelled = rows.where(~held_out(F.col("doc_id"))).join(given.select("doc_id", F.col("label").cast("int").alias("label")), "doc_id")
    return score(rows, fit(labelled)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
