"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v`` long); root is the smallest node reachable.

    Alternating large-star and small-star steps: every edge moves to the smallest
    neighbour until each component is a star. Steps grow with the logarithm of the
    longest path. Loops, null ends and repeated edges are ignored; no edge gives no
    row. Edges stay in tables; only two totals for each step reach the driver.
    """
    now = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        totals = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if totals == seen or totals[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = totals
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
