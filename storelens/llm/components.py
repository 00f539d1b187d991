"""Connected components of a graph held in DataFrames.

Large-star / small-star (Kiveris et al., "Connected Components in MapReduce and
Beyond"): each round replaces the links so that every node hangs on the smallest
node it knows, until nothing changes; that takes a number of rounds logarithmic
in the number of nodes.  Hub nodes are safe: the minimum is a partial
aggregation, and the join that follows reads a written table on both sides, so
adaptive execution splits a hub's rows.  Nothing but one row of totals a round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.frames import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round over links (a, b) with a > b."""
    both = links.select("a", "b")
    if large:
        both = both.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    moved = both.join(lowest, "a")
    if large:      # every larger neighbour hangs on the smallest node around
        return moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionAll(
        lowest.select("a", F.col("low").alias("b"))).where("a > b")


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs, in any order -> (node, root) for every linked node
    that isn't its component's smallest; root is that smallest node."""
    links = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                      F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        links = checkpointed(_star(_star(links, large=True), large=False).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
