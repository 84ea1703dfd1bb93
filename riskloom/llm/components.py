"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import materialize


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("b")).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge, the root being the smallest node of its component.

    ``edges`` has long columns ``a`` and ``b``. Each round replaces the links of a node by links to
    its smallest neighbour: first those of larger neighbours, then those of smaller ones. Rounds
    grow with the logarithm of a component's width, and every round is two aggregations and two
    joins over the edges, written to the shared folder. Hubs combine on the map side, and a hub's
    join is one that run-time skew handling can split. Self-links and repeats are allowed.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while (sign := _sign(now)) != seen:
        seen = sign
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).where("a <> b").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("b", "m").union(least.select("a", "m")).toDF("a", "b").where("a <> b").distinct()
        now = materialize(small, "small-star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
