"""Connected components of a graph given as edges, by alternating star contraction over Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.frames import stored


def _large(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (u, v), root being the smallest node reachable.

    Rounds end when the edges stop changing, after a number of rounds that grows with the logarithm
    of the nodes. Each round is written to the shared folder. A node with many edges is met by a
    partial minimum and a join that is split when skewed. Loops (u = v) are no edges; nulls are none
    either; no edges give no rows.
    """
    edges = stored(_small(edges.select("u", "v").where("u <> v")))
    print_of = lambda e: e.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(edges)
    while before[0]:
        edges = stored(_small(_large(edges)))
        now = print_of(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct()).toDF("node", "root")
