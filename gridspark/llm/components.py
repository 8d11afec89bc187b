"""Connected components by alternating large and small stars.

Every round links nodes to smaller neighbours, until each component is a star around its
smallest node; the rounds grow with the logarithm of the longest path. Only counts and
one checksum per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is the smallest node reachable.

    Links may be repeated and point either way; a node linked only to itself, or null, is left out.
    """
    edges = settled(
        links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = settled(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")))
        # large star: every larger neighbour of u meets the least one of u
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = settled(large.distinct())
        # small star: u and its smaller neighbours meet the least of them
        least = settled(large.groupBy("hi").agg(F.min("lo").alias("m")))
        small = large.join(least, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = settled(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
