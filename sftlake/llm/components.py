"""Connected components by alternating large-star and small-star rounds.

Each round is a grouped minimum and a join over the edge list; nothing is gathered per vertex, so a vertex
with a third of all edges is a row count, not a list. Rounds end when the edges form stars. Every
round's edges are written to the shared folder, which ends their lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    """Join each larger neighbour of a vertex to the smallest of the vertex and its neighbours."""
    both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi > lo").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Join each vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    return joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi > lo").union(
        least.select("hi", F.col("m").alias("lo"))
    ).distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each node with an edge can reach. Nodes are integers."""
    edges = pairs.where(f"{a} <> {b}").select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = stored(edges, "edges")
    while True:
        edges = stored(_small(_large(edges)), "edges")
        # Stars: every vertex has one centre, and no centre has one.
        rows, vertices = edges.agg(F.count(F.lit(1)), F.countDistinct("hi")).first()
        if rows == vertices and edges.join(edges.select(F.col("hi").alias("_hi")), F.col("lo") == F.col("_hi"), "left_semi").isEmpty():
            break
    centres = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(centres)
