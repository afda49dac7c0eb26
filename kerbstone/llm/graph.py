"""Connected components of an edge table, by contraction.

Each round maps every node to the least of itself and its neighbours and replaces the edges by
edges between the images, until none is left. Then the maps are followed back from the last
to the first. Rounds grow with the logarithm of the longest chain. Minima are partial sums in
every task, so a node with very many neighbours is no hot key; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node reached."""
    edges = settle(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = settle(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        )
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("c"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("d"))
        edges = settle(
            edges.join(left, "a")
            .join(right, "b")
            .where("c != d")
            .select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct()
        )
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    roots = maps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("to"), F.col("root").alias("later"))
        roots = settle(
            step.join(later, "to", "left").select("node", F.coalesce("later", "to").alias("root"))
        )
    return roots
