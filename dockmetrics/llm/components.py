"""Connected components of a link table by alternating star contraction.

Each round replaces links by links to the smallest neighbour, first for larger
and then for smaller neighbours (Kiveris et al., "Connected Components in
MapReduce and Beyond"). Rounds grow with the logarithm of the longest path. The
links are written to the shared folder after each round; nothing but a count and
a checksum reaches the driver. Minima are partial aggregates, so a node with any
number of links costs one row per task, and the joins are left to the adaptive
skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import discard, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the
    smallest node reachable, the node itself included."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars = materialize(pairs.filter("u <> v").distinct(), "components")
    state = _state(stars)
    while state[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        earlier, stars = stars, materialize(small, "components")
        discard(earlier)
        before, state = state, _state(stars)
        if before == state:
            break
    roots = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(stars.agg(F.count(F.lit(1)), checksum).first())
