"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf_dir] [keys …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql) -> str | None:
    """What differs between a query's rows and its SQL's rows, types of whole numbers included."""
    expected = con.sql(sql)
    names = spark_df.columns
    if sorted(names) != sorted(expected.columns):
        return f"columns {sorted(names)} / {sorted(expected.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    theirs = dict(zip(expected.columns, map(str, expected.types)))
    for name, kind in spark_df.dtypes:
        if kinds.get(kind, kind) != theirs[name]:
            return f"type of {name}: {kind} / {theirs[name]}"
    got = normal([tuple(r) for r in spark_df.collect()], names)
    want = normal(expected.fetchall(), expected.columns)
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)} rows; {[r for r in got if r not in set(want)][:2]} / {[r for r in want if r not in set(got)][:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} / {b}"
    return None


def main() -> int:
    from hustings.catalog import QUERIES, SQL
    from hustings.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in SQL:
                found = difference(df, con, SQL[key])
            else:
                found = None if df.collect() else "no rows"
        except Exception as e:  # report every query
            found = str(e)[:1500]
        bad += found is not None
        print(f"{key:28s} {time.time() - start:6.2f}s {'ok' if found is None else 'DIFFERS ' + found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
