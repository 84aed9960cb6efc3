"""A table that lies in one small file is worked on by many tasks."""

import pytest

from hustings.catalog import grids, models
from hustings.session import dealt


def sizes(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


@pytest.fixture
def tables(frame, tmp_path):
    customers = [(i, i % 7, f"name {i}", 10.5 * i, "MACHINERY" if i % 5 == 0 else "AUTO") for i in range(800)]
    orders = [(i, i % 90, "FO"[i % 2], 1000.0 * i, f"{1 + i % 5}-X") for i in range(800)]
    ddl = "c_custkey bigint, c_nationkey int, c_name string, c_acctbal double, c_mktsegment string"
    frame(customers, ddl).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    ddl = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    frame(orders, ddl).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_dealt(spark):
    few = dealt(spark.range(1000).coalesce(1))
    assert max(sizes(few)) < 600 and sorted(r.id for r in few.collect()) == [*range(1000)]


@pytest.mark.parametrize("made", [grids.customer_pages, grids.order_grid])
def test_rows_made_of_one_file(spark, tables, made):
    found = sizes(made(spark, tables))
    assert max(found) < 500 and sum(found) >= 800


def test_template_of_one_file(spark, tables, monkeypatch):
    class Stop(Exception):
        pass

    def stop(grid, sheets):
        raise Stop(grid)

    monkeypatch.setattr(models.template, "template_records", stop)
    with pytest.raises(Stop) as stopped:
        models.winners_of_the_template(spark, tables)
    grid = stopped.value.args[0]
    # It is read several times, so it is written first, by several tasks.
    assert len(grid.inputFiles()) > 1 and grid.count() == 805
