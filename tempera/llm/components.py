"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is an aggregate and a join on the node; nothing is gathered per component. The rounds grow with
the logarithm of the longest chain. A round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempera.session import materialise


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and the smallest node reachable from it, ``component``, for every node with a link.

    Links from a node to itself and NULL ends are ignored; direction and repetition do not matter.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    both = F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    edges = materialise(links.filter(both).select(high, low).distinct())
    state = _state(edges)
    while True:
        edges = materialise(_small_star(materialise(_large_star(edges))))
        before, state = state, _state(edges)
        if before == state:
            break
    # Every node now points to the smallest of its component.
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the set of links, which stays the same once no step changes it."""
    wide = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(wide), F.sum(F.col("v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node next to it."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    larger = around.filter("v > u").join(least, F.col("u") == F.col("at"))
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    smaller = edges.join(least, F.col("u") == F.col("at")).filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct()
