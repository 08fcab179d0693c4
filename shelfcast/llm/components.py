"""Connected components of a link table by alternating star steps.

Every round replaces links by links to smaller neighbours; rounds are joins and groups on
the link table alone, each written to the shared folder. Hot nodes: minima are partial
aggregates, and the join on a node is a plain equality join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.settings import settle, settle_counted

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: each node's (larger or smaller) neighbours are tied to its least neighbour."""
    if large:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = both.join(least, "a")
    if large:
        return tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.select("b", "m").union(least.select(F.col("a").alias("b"), "m")).filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of integer nodes to (node, root): root is the smallest node reachable.

    Self links and repeated links are allowed; links with a null end are left out. Nodes
    without links have no row. An empty table gives an empty table.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, count = settle_counted(links, "links")
    if not count:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    for _ in range(MAX_ROUNDS):
        links = _star(_star(links, large=True).distinct(), large=False).distinct()
        seen = Observation()
        # A forest of depth one has as many links as children and no parent that is a child;
        # equal sums over two rounds mean that nothing moved.
        state = (
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark"),
        )
        links = settle(links.observe(seen, *state), "links")
        now = (seen.get.get("rows"), seen.get.get("mark"))
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
