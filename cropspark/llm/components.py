"""Connected components by alternating star contractions, one written table per step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropspark.llm.frames import stored


def _star(both: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on the smallest node around it.

    `both` holds each edge in both directions. A hub is a key of a join, whose partitions
    Spark can split, and of a minimum, which is combined before the shuffle.
    """
    own = both if larger else both.filter("v < u")
    least = own.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = own.join(least, "u")
    if larger:
        return moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for each node that has an edge; the component is its smallest node.

    Loops and repeated edges are fine, rows with a null end are left out, and no edges give no
    rows. The loop ends when a step changes nothing, after O(log^2 n) steps.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    now = stored(now.distinct(), "edges")
    before = _state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, True).distinct(), "edges")
        now = stored(_star(large, False).filter("u <> v").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
