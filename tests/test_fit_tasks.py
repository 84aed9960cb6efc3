"""Tasks of a fit take a bounded number of rows, however many there are."""

import pytest

from hustings import session
from hustings.operators import models
from hustings.operators.stages import FixedRows


def sizes(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]


@pytest.mark.parametrize("prepare", [
    lambda df: models.training_rows(df, ["x"], "label", ["id"]),
    lambda df: FixedRows(rowId=["id"]).transform(df),
])
def test_rows_of_a_task(spark, monkeypatch, prepare):
    df = spark.range(4000).selectExpr("id", "id % 7 as x", "cast(id % 3 = 0 as int) as label")
    few = prepare(df)
    monkeypatch.setattr(session, "ROWS_PER_FIT_TASK", 100, raising=False)
    many = prepare(df)
    assert max(sizes(many)) < 200 and sum(sizes(many)) == 4000 and len(sizes(few)) < 20
    assert sorted(many.drop("features").collect()) == sorted(few.drop("features").collect())
    assert many.collect() == many.collect()


def test_large_tables_keep_the_cores_busy(spark, monkeypatch):
    """Tasks of about the size that is named, in whole rounds of the cores, not one for each shuffle partition."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(9000).selectExpr("id", "id % 7 as x", "cast(id % 3 = 0 as int) as label")
    monkeypatch.setattr(session, "ROWS_PER_FIT_TASK", 9000 // (cores + 1))
    rows = session.fixed_rows(df, ["id"], 50 * cores)
    assert rows.rdd.getNumPartitions() == 2 * cores and rows.count() == 9000


def test_tasks_of_a_fit_are_not_many(spark):
    """A task of a tree's level costs some milliseconds whatever it holds, so it holds many rows."""
    assert session.ROWS_PER_FIT_TASK >= 1_000_000
