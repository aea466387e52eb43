"""Connected components of links between bigint nodes, without ever holding a component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorakit.session import cut


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One half step of Kiveris et al., 2014: a node's larger (or smaller) neighbours are linked to its least neighbour."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    out = moved.where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (u, v): root is the least node that can be reached.

    Large and small stars by turns until nothing changes; each round is written to the shared folder. Rounds grow with the logarithm
    of the longest path. Nodes are spread by join and partial minimum; the centre of a large star is split by Spark's skew join.
    """
    now = cut(links.where("u <> v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        now = cut(_stars(_stars(now, large=True), large=False), "links")
        # One row: the number of links and a sum over them tell whether a round changed anything.
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = mark
