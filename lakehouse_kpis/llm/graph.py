"""Connected components of an undirected graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehouse_kpis.llm.tables import stored

ROUNDS = 60


def components(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: bigint), root being the smallest node reachable.

    Alternates two steps on the edge list until it no longer changes: every node hands its larger
    neighbours to its smallest neighbour, then its smaller ones. Each step keeps the components and
    ends in stars round the smallest node, within O(log^2 nodes) rounds. Neighbour lists are never
    gathered: a step is a grouped minimum and a join, and joins are split by AQE when a node is hot.
    Self loops and rows with a null end are ignored; nodes without a link are not returned. Raises
    RuntimeError if `rounds` do not suffice.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    links = stored(links, "links")
    mark = _mark(links)
    for _ in range(rounds):
        if mark[0] == 0:
            break
        after = stored(_small_star(_large_star(links)), "links")
        now = _mark(after)
        links = after
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select(
        F.col("u").alias("k"), F.least("u", "low").alias("m")
    )
    return both.join(least, both["u"] == least["k"]).where("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    moved = links.join(least, links["u"] == least["k"]).where("v <> m").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    kept = least.select(F.col("k").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def _mark(links: DataFrame) -> tuple:
    """A count and a sum that tell two edge lists apart."""
    half = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(half)).first())
