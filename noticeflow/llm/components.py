"""Connected components of links, in Spark rounds.

Alternating large-star and small-star steps (Kiveris et al., "Connected components in
MapReduce and beyond", 2014): each round joins every node to the smallest node it sees,
until the links are stars. Links never leave the cluster; every round is written to the
shared folder, so no plan grows and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _smallest(links: DataFrame) -> DataFrame:
    """Links (u, v) with the smallest of u's neighbours and u itself."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    found = _smallest(links)
    down = found.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return down.union(own).filter("u <> v").distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Links of a node to itself and repeated links do no harm; no links give no rows.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    stars = links.filter("a <> b").select(larger.alias("u"), smaller.alias("v")).distinct()
    stars = written(stars, "links")
    before = _mark(stars)
    while before[0]:
        stars = written(_small_star(_large_star(stars)), "links")
        after = _mark(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
