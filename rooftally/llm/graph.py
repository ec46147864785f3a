"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.session import stage


def _print_of(edges: DataFrame) -> tuple:
    """Number of edges and two sums over their hashes: equal for equal edge sets."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node of an edge.

    Every round ties each node's larger neighbours, then its smaller ones, to the smallest node near it, until nothing
    changes. A round is aggregations with map-side minima and equi-joins, each round is stored in the shared folder, and only
    its size and hash reach the driver. Loops, repeated edges and edges with a NULL end are passed over.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    links = stage(links)
    before = None
    while (now := _print_of(links)) != before:
        before = now
        # large star: u's larger neighbours go to the smallest of u and all neighbours
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large.filter("u <> v"))
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
