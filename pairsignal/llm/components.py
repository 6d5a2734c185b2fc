"""Connected components of an edge table by alternating large and small stars.

Edges stay distributed; each round links every neighbour to the smallest one it knows of, so the
number of rounds is logarithmic in the length of chains.  A node's neighbours are never gathered:
the rounds need their minimum, which is summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is its smallest node."""
    edges = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct())
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
