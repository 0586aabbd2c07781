"""Exact continuous percentiles that never hold a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], bucket_width: float,
    lows: Sequence[str] = (), highs: Sequence[str] = (),
) -> DataFrame:
    """Distribution of non-null values per group.

    Gives keys, ``n``, ``mean``, the percentile_cont columns named in probs, the
    minimum of each column in ``lows`` and the maximum of each in ``highs``.

    The built-in aggregate keeps every distinct value of a group in one buffer.
    Here values are counted per (group, value) first, the counts of coarse value
    ranges locate the range each wanted rank falls into, and only those ranges
    are ranked value by value. A group holding most of the table is spread over
    its value ranges; the largest unit of work is one range of one group.
    Everything derives from one shuffle of the input, which the planner reuses.
    """
    keys = list(keys)
    counts = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count("*").alias("_n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs])
        .withColumn("_b", F.floor(F.col("_v") / F.lit(bucket_width)))
    )
    carried = {c: F.min for c in lows} | {c: F.max for c in highs}
    # Cumulative counts per range. One row per (group, range): bounded by the value domain.
    by_range = Window.partitionBy(*keys).orderBy("_b")
    whole = Window.partitionBy(*keys)
    ranges = counts.groupBy(*keys, "_b").agg(
        F.sum("_n").alias("_bn"), F.sum(F.col("_v") * F.col("_n")).alias("_bsum"),
        *[f(c).alias(c) for c, f in carried.items()],
    ).select(
        *keys, "_b", "_bn",
        (F.sum("_bn").over(by_range) - F.col("_bn")).alias("_before"),
        F.sum("_bn").over(whole).alias("_total"), F.sum("_bsum").over(whole).alias("_sum"),
        *[f(c).over(whole).alias(f"_all_{c}") for c, f in carried.items()],
    )
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), (F.lit(p) * (F.col("_total") - 1)).alias("h"))
        for name, p in probs.items()
    ])
    group_values = ["_total", "_sum", *[f"_all_{c}" for c in carried]]
    ranks = ranges.withColumn("_w", F.explode(wanted)).withColumn(
        "_rank", F.explode(F.array_distinct(F.array(F.floor("_w.h"), F.ceil("_w.h"))))
    ).filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_bn")))
    # Rank values only inside the ranges that hold a wanted rank.
    hit = ranks.groupBy(*keys, "_b").agg(
        *[F.first(c).alias(c) for c in ("_before", *group_values)],
        F.collect_set(F.struct(F.col("_w.name").alias("name"), F.col("_w.h").alias("h"), F.col("_rank").alias("rank"))).alias("_ranks"),
    ).withColumnsRenamed({k: f"_hit_{k}" for k in [*keys, "_b"]})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hit_{k}")) for k in [*keys, "_b"]])
    in_range = Window.partitionBy(*keys, "_b").orderBy("_v")
    points = (
        counts.join(hit, same)
        .withColumn("_to", F.sum("_n").over(in_range) + F.col("_before"))
        .withColumn("_r", F.explode("_ranks"))
        .filter((F.col("_r.rank") < F.col("_to")) & (F.col("_r.rank") >= F.col("_to") - F.col("_n")))
    )
    low_rank, high_rank = F.floor("_r.h"), F.ceil("_r.h")

    def at(name: str):
        mine = F.col("_r.name") == name
        lo = F.max(F.when(mine & (F.col("_r.rank") == low_rank), F.col("_v")))
        hi = F.max(F.when(mine & (F.col("_r.rank") == high_rank), F.col("_v")))
        return (lo + (hi - lo) * F.max(F.when(mine, F.col("_r.h") - low_rank))).alias(name)

    def extreme(c: str):
        # The group's own value already covers the points; reading the column here
        # too keeps both branches on one shuffle.
        pick = F.least if c in lows else F.greatest
        return pick(F.max(f"_all_{c}"), carried[c](c)).alias(c)

    return points.groupBy(*keys).agg(
        F.max("_total").alias("n"), F.max(F.col("_sum") / F.col("_total")).alias("mean"),
        *[at(n) for n in probs], *[extreme(c) for c in carried],
    )
