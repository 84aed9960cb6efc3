"""Connected components of a graph held as a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.llm.tables import stored
from hustings.operators.skew import spread_join


def is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether of rows ``u`` points at ``v`` every ``u`` has one target and no target points on itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out")).unionAll(edges.select("v", F.lit(0)))
    seen = ends.groupBy("node").agg(F.sum("out").alias("targets"), F.min("out").alias("least"))
    return seen.where("targets > 1 or (targets = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); the label is the smallest node of the component.

    Every round points all neighbours of a node at the smallest one, first the larger neighbours, then the smaller, until
    no node that is pointed at points on; the rounds needed grow with the logarithm of the longest chain.  A node with very
    many links is a hot key of the joins and is spread.  Each round is written to the shared folder, so no lineage builds up.
    """
    down = F.struct(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(links.where("a != b").select(down.alias("e")).select("e.*").distinct(), "links")
    while not is_forest_of_stars(edges):
        most = 2 * edges.count()
        both = edges.unionAll(edges.select("v", "u")).toDF("x", "y")
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"), F.count(F.lit(1)).alias("_n"))
        large = spread_join(both, least, ["x"], ["y"], "inner", at_most=most).where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        joined = spread_join(
            large.withColumnRenamed("u", "x"), least.withColumnRenamed("u", "x"), ["x"], ["v"], "inner", at_most=most
        )
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionAll(edges.select("v", "v").distinct().toDF("node", "label"))


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (``node, label``) after further ``links``: only the labels the links connect are worked on."""
    if links.isEmpty():
        return labels
    ends = links.join(labels.toDF("a", "la"), "a", "left").join(labels.toDF("b", "lb"), "b", "left")
    ends = ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    moved = stored(components(ends), "moved")
    known = labels.join(moved.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return known.unionAll(moved.join(labels, "node", "left_anti"))
