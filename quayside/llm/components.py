"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.buckets import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the least node among them and itself.

    The large star moves the neighbours greater than a node, the small star the lesser ones and the node itself. Edges are
    rows (u, v) with u > v.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = edges.join(least, "u")
    moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """The least node of the component of every linked node, as rows (node, component).

    Large and small stars alternate until nothing changes: the graph is then a star around each component's least node.
    A node's neighbours are never gathered; they meet as rows of joins and minima.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    state = None
    while True:
        last, edges = edges, written(_star(_star(edges, large=True), large=False), "edges")
        discard(last)
        new = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
