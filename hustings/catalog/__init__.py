"""Registered queries over the test tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``key``."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            SQL[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


for _area in ("grids", "records", "winners", "encoding", "features", "profiles", "contest", "models"):
    import_module(f"hustings.catalog.{_area}")
