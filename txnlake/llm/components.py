"""Connected components of a graph in a table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import stored


def _min_neighbour(links: DataFrame) -> DataFrame:
    """Rows (u, m).  Written, so that Spark can split a hub's partition in the joins with it."""
    return stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _min_neighbour(both).select("u", F.least("m", "u").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node itself, to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _min_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for all nodes of `edges` (u, v); the root is the least node reachable.

    Each round writes its edges to the shared folder; rounds end when a star at every root remains,
    after about the logarithm of the longest path.
    """
    edges = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        mark = edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))
        ).first()
        if mark == state:
            break
        state = mark
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
