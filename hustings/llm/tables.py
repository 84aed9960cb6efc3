"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.session import fresh_path

# A word of the size and shingle contracts: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared folder and read it back; lost executors cost only their tasks.

    The folder belongs to the application: results are lazy and may read it as long as the session lives.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that extra columns never clash.

    A column name may hold dots or differ in case from the wanted one; it is looked up exactly first.
    """
    return df.select(*[F.col(f"`{given}`").alias(own) for own, given in columns.items()])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as make it new to ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(""))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept out of training: crc32 of its id as text leaves no remainder.  No id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


def bytes_of(column):
    """An Arrow text column as one array of its UTF-8 bytes and the offsets of its rows; null is empty."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(lengths, most: int):
    """Ranges of neighbouring rows of about ``most`` units together; a longer row stands alone."""
    lengths = list(lengths)
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > most:
            yield start, i
            start, held = i, 0
        held += length
    if start < len(lengths):
        yield start, len(lengths)
