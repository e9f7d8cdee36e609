"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm.common import staged

MAX_ROUNDS = 60  # rounds grow with the logarithm of the nodes


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) and the least of u and its neighbours.

    Neighbours are combined on the map side; the join is one that adaptive execution splits
    where a node has very many edges.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return edges.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    """A large and a small star: larger neighbours hang on the least one, then all on the least."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
                              F.struct(F.col("u"), F.col("least").alias("v"))))
    return _with_least(large).select(pairs.alias("e")).select("e.*").filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of the links (u, v), two longs.

    Each round groups edges by a node, takes the least neighbour and hangs the others on it.
    Ends when a round changes nothing, which two sums over the edges show.
    """
    edges, state = links.select("u", "v").filter("u <> v"), None
    for _ in range(MAX_ROUNDS):
        edges = staged(_round(edges), "stars")
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        state = new
    raise RuntimeError("components did not settle")
