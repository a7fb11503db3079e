"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.session import write_shared


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link each node's larger (or, if ``small``, its smaller) neighbours to its least neighbour, itself included.

    The least neighbour comes from an aggregate that tasks begin before the shuffle, and
    goes back over a join, which Spark can split where one node has very many neighbours.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not small:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "w")
    joined = both.join(least, F.col("u") == F.col("w"))
    links = joined.where("v < u" if small else "v > u").select(F.col("v").alias("x"), "m")
    if small:
        links = links.union(least.select(F.col("w").alias("x"), "m"))
    return links.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node on an edge (a, b); the component is its least node."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = write_shared(edges, name)
    state = None
    while True:
        edges = write_shared(_star(_star(edges, small=False), small=True), name)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
