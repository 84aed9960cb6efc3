"""What a workflow gives besides the files it writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Outcome:
    """``predicted`` rows, the sources ``left_out`` with reasons, and, where a model was fitted, the ``accuracy`` per fold, the
    class ``balance``, the ``splits`` per feature; ``counts`` are what was observed while reading."""

    predicted: DataFrame
    left_out: DataFrame
    accuracy: DataFrame | None = None
    balance: DataFrame | None = None
    splits: DataFrame | None = None
    model: PipelineModel | None = None
    counts: dict[str, int] | None = None


def class_balance(rows: DataFrame, label: str) -> DataFrame:
    """Rows per class, the largest first: ``label, n``."""
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), label)
