"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its content says so, every distinct chunk is moved once and gets a verified identifier, and texts are
compared as ordered lists of identifiers, so long documents themselves are never grouped or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hustings.llm.tables import own_columns, stored, text_of, unused
from hustings.operators.skew import spread_join

LEAST, MOST = 256, 4096


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The chunks of a text in order; joined again they are the text.

    A chunk ends at the first end of a sentence or line after ``least`` characters, or after ``most``.
    """
    end = r"(?:(?<=[.!?。！？]\s)|(?<=\n)|\z)"
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{{least},{most}}}?{end}|.{{1,{most}}}"), F.lit(0))


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", id_bits: int = 64, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; a null text is an empty one, and empty texts are equal.  Of equal texts the row
    with the largest id stays.  A row without an id stays only if no row of its group has one.  Rows that repeat id and
    text count in ``group_size`` and share ``kept``.  No rows give no rows.  Further columns are not looked at.

    A chunk's identifier is a hash of ``id_bits`` bits.  All distinct chunks are compared under their hash; where a hash
    stands for several chunks, the number of the chunk among them is part of the identifier too.
    """
    rows = own_columns(docs, doc_id=doc_id, text=text).select("doc_id", text_of("text").alias("text"))
    # Bytes that are no UTF-8 would be lost in the regular expression; such texts are cut in their hexadecimal form.
    valid = F.is_valid_utf8("text")
    cut = rows.select(
        "doc_id",
        F.sha2("text", 256).alias("text_sha256"),
        valid.alias("_valid"),
        chunks(F.when(valid, F.col("text")).otherwise(F.hex("text")), least, most).alias("_chunks"),
    )
    short = 64 - id_bits

    def hashed(chunk: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(chunk), short) if short else F.xxhash64(chunk)

    store = cut.select(F.explode("_chunks").alias("chunk")).select(hashed(F.col("chunk")).alias("h"), "chunk").distinct()
    shared = stored(store.groupBy("h").count().where("count > 1").select("h"), "shared-hashes")
    # Texts are cut twice, for their chunks and for their recipes; all that follows reads the recipes.
    recipes = stored(cut.select("doc_id", "text_sha256", "_valid", F.transform("_chunks", hashed).alias("_recipe")), "recipes")
    if shared.isEmpty():
        recipes = recipes.withColumn("_numbers", F.lit(None).cast("array<struct<pos:int,number:int>>"))
    else:
        number = F.row_number().over(W.partitionBy("h").orderBy("chunk"))
        numbered = store.join(shared, "h", "left_semi").withColumn("number", number)
        places = (
            cut.select("doc_id", "text_sha256", F.posexplode("_chunks").alias("pos", "chunk"))
            .withColumn("h", hashed(F.col("chunk")))
            .join(numbered, ["h", "chunk"])
            .groupBy("doc_id", "text_sha256")
            .agg(F.array_sort(F.collect_set(F.struct("pos", "number"))).alias("_numbers"))
            .withColumnsRenamed({"doc_id": "_d", "text_sha256": "_s"})
        )
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_sha256") == F.col("_s"))
        recipes = recipes.join(places, same, "left").drop("_d", "_s")
    key = ["_valid", "_recipe", "_numbers"]
    recipes = recipes.withColumn("_numbers", F.coalesce("_numbers", F.array().cast("array<struct<pos:int,number:int>>")))
    groups = recipes.groupBy(*key).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("_n"))
    joined = spread_join(recipes, groups.withColumn("group_size", F.col("_n")), key, ["doc_id", "text_sha256"])
    return joined.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep, rows without an id included."""
    gone, sha = unused(docs, "_lost", "_sha")
    lost = exact_duplicates(docs, doc_id, text).where("not kept").select(F.col("doc_id").alias(gone), F.col("text_sha256").alias(sha))
    here = F.col(f"`{doc_id}`").eqNullSafe(F.col(gone)) & (F.sha2(text_of(f"`{text}`"), 256) == F.col(sha))
    return docs.join(lost, here, "left_anti")
