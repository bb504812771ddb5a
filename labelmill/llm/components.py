"""Connected components of an edge table, by rounds of joins: no part of the graph leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import cut


def _smallest(neighbours: DataFrame) -> DataFrame:
    return neighbours.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) -> (node, root): the smallest node reachable, for every node of an edge.

    Rounds of linking larger neighbours, then smaller ones, to the smallest
    neighbour, until the edges stay the same; paths shrink at least by half each
    time. A round is cut from its lineage by a reliable checkpoint. Loops and
    repeated edges do no harm; nodes without an edge are not in the result.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_smallest(both).select("u", F.least("u", "m").alias("m")), "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = _smallest(large)
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        now = cut(small)
        after = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
