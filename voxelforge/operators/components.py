"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelforge.session import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an undirected edge table; the component is its smallest node.

    Rounds of large-star and small-star: every node hands its neighbours over to
    the smallest of them, until stars are left. The number of rounds grows with
    the logarithm of the size. Nothing but a row count reaches the driver; a hub's
    edges are reduced to their minimum before they move. Loops are nodes alone.
    """
    a, b = F.col(src), F.col(dst)
    pairs = cut(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL").distinct())
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v"))
    now = pairs.where("u < v")
    seen = None
    while True:
        # Large star: a node's larger neighbours go to the smallest of it and its neighbours.
        both = now.select("u", "v").union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").select(F.col("m"), F.col("u"), F.col("v"))
        moved = small.select("m", F.col("u").alias("v")).union(small.select("m", "v")).where("m < v").select(F.col("m").alias("u"), "v").distinct()
        now = cut(moved)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
    found = nodes.distinct().join(now.select(F.col("v").alias("node"), F.col("u").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
    return cut(found)
