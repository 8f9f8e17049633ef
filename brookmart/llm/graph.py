"""Connected components of large graphs by contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (a, b: long): root is the smallest node reachable.

    Each round points every node to its smallest neighbour, follows the pointers to their ends,
    and replaces the edges by those between the ends. A component's smallest node always points
    to itself, so it is the end that is left. Every table is written before it is used again;
    the driver sees counts only.
    """
    links = None
    edges = materialise(_between(edges, "a", "b"), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")), "parents")
        while True:
            ends = parents.select(F.col("a").alias("p"), F.col("p").alias("q"))
            jumped = materialise(parents.join(ends, "p").select("a", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), "jumps")
            parents = jumped.select("a", "p")
            if jumped.where("moved").isEmpty():
                break
        ends = parents.select(F.col("a").alias("root"), F.col("p").alias("end"))
        if links is None:
            links = parents.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            links = materialise(links.join(ends, "root", "left").select(
                "node", F.coalesce("end", "root").alias("root")), "links")
        left, right = ends.select(F.col("root").alias("a"), F.col("end").alias("x")), ends.select(F.col("root").alias("b"), F.col("end").alias("y"))
        edges = materialise(_between(edges.join(left, "a").join(right, "b"), "x", "y"), "edges")
    return links if links is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _between(edges, one, other):
    return edges.where(F.col(one) != F.col(other)).select(
        F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct()
