import os
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from hustings.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


def small_frame(spark, rows, ddl):
    """A DataFrame of literal rows, handed over as an Arrow table."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


@pytest.fixture
def frame(spark):
    return lambda rows, ddl: small_frame(spark, rows, ddl)


@pytest.fixture
def column(spark):
    """Values of an expression over one text column."""

    def run(expression, values):
        df = small_frame(spark, list(enumerate(values)), "i int, x string")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]

    return run
