"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.common import stored

#: Rounds after which the components of even a chain of 2**60 links are found.
ROUNDS = 60


def components(links: DataFrame, name: str = "component") -> DataFrame:
    """(node, root) for each node of links (a, b) but the roots' own rows: root is the least node that links reach.

    Rounds of large-star and small-star until all links go to roots; each round is written to the shared
    folder. A node's least neighbour is found by partial aggregates; joins back to it have a plain exchange on
    both sides, so that a node with very many links can be split.
    """
    links = stored(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-links")
    for _ in range(ROUNDS):
        links = _small_star(_large_star(links, name), name)
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        if ends.where("up > 1 or (up > 0 and down > 0)").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))  # every node has one parent, which has none
    raise RuntimeError(f"the components of {name} were not found in {ROUNDS} rounds")


def _large_star(links: DataFrame, name: str) -> DataFrame:
    """Each node's larger neighbours link to the least of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-least")
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, name: str) -> DataFrame:
    """Each node and its smaller neighbours link to the least of them. After a large star a node has few of those."""
    least = F.min("b").over(Window.partitionBy("a")).alias("m")
    moved = links.select("a", "b", least).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
    return stored(moved.select("x.*").where("a <> b").distinct(), f"{name}-links")
