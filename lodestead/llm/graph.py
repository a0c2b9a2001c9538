"""Connected components of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.llm.text import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours, and keeps for itself, the smallest of them (edges go from u down to v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every node with a link; the component is its smallest node.

    Large-star and small-star steps take turns until nothing changes: a
    logarithmic number of rounds, each with the edges' number of rows at most.
    Minima are combined before a shuffle, so a node with many links is one row.
    Rows with a null end are left out.
    """
    spark = links.sparkSession
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    edges = stored(spark, edges, "links")
    before = mark(edges)
    while before[0]:
        edges = stored(spark, _small_star(_large_star(edges)), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
