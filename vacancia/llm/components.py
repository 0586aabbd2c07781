"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each node's larger (or, one way, smaller) neighbours are tied to the smallest of it and its neighbours."""
    if both_ways:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    tied = edges.join(least, "u")
    if both_ways:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """u, v for links (u, v of any order): each node but the smallest of its component, with that smallest.

    Every round's table is written to the shared folder; rounds end when nothing changes, after
    a number of them that grows with the logarithm of the longest chain squared.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = stored(_star(_star(edges, True), False), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
