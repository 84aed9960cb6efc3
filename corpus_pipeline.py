"""The corpus pipeline: language, exact copies, near copies, benchmark passages, mixture.

Every stage takes the documents its predecessor has kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.llm import decontaminate, exact, language, mixing, near
from hustings.session import fresh_path


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or unlike every learned language go.

    The models learn from the rows that are not held out.  ``lang`` stays as given.  Null and empty texts go; every row is
    judged by its own text, so repeated rows stay or go together, with or without an id.
    """
    learned = docs.where(~language.held_out(F.col("doc_id")))
    marked = language.identify(docs, language.train(learned))
    return marked.where("not rejected").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, the one with the largest id.

    Null counts as an empty text.  A row without an id stays only where no row of its group has one; rows equal in id and text
    stay together.
    """
    return exact.drop_duplicates(docs).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five words, similarity 0.8), the one with the smallest id.

    Rows without an id come last in their group.  Texts without words stay; rows equal in id and text stay or go together.
    """
    return near.drop_near_duplicates(docs).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands.

    Null and empty texts stay; a row is known by its id and its text, so rows without an id are judged too.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: every document as often as its source's target asks, with ``copy`` counted from 1.

    Every row is a document of its own, whatever it shares with others; rows without a source are a source, and the last.
    """
    return mixing.mixture(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

# Models and signatures are not expressible in SQL; tests compare the stages with plain versions of them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
