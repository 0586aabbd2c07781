"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups. DataFrame operations only.

Groups stand in the order of their keys. A capacity is feasible if shards that are filled one after
another, each as far as it goes, are enough. The least feasible capacity is found by binary search
over sums of key ranges: taken as groups, ranges give a capacity that surely does; taken as if they could be
cut anywhere, one that is surely needed. Where the two differ, the ranges in which some cut can lie are
split and summed again, until they agree.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import stored

#: The first look sums up the ranges of 2**FIRST_BITS key prefixes; groups over a 2**-FIRST_BITS part of the bytes come one by one.
FIRST_BITS = 16
#: The most sums that any other look brings to the driver.
LOOK = 1 << 17
SLOT_BUCKETS = 4096


@dataclass(frozen=True)
class Knot:
    """A range of keys (both ends belong to it), the sum of its sizes, and whether it is a single group."""

    first: int
    last: int
    size: int
    single: bool


def _totals(knots: list[Knot]) -> list[int]:
    out, total = [0], 0
    for k in knots:
        total += k.size
        out.append(total)
    return out


def fill(knots: list[Knot], totals: list[int], shards: int, capacity: int, divide: bool = False) -> list[int] | None:
    """Ends (numbers of knots) of shards filled up to ``capacity``; None if they are not enough.

    With ``divide``, ranges of several groups may be cut anywhere; the ends are rounded down then.
    """
    ends, at, whole = [], 0, totals[-1]
    for _ in range(shards):
        target = min(whole, at + capacity)
        i = bisect_right(totals, target) - 1
        at = target if divide and i < len(knots) and not knots[i].single else totals[i]
        ends.append(i)
    return ends if at == whole else None


def least_capacity(knots: list[Knot], totals: list[int], shards: int, low: int, divide: bool = False) -> int:
    """Binary search for the least feasible capacity of ``low`` or more."""
    high = max(low, totals[-1])
    while low < high:
        middle = (low + high) // 2
        if fill(knots, totals, shards, middle, divide) is None:
            low = middle + 1
        else:
            high = middle
    return low


def cut_ranges(knots: list[Knot], totals: list[int], shards: int, low: int, high: int) -> set[int]:
    """Knots of several groups in which a cut can lie for some capacity from ``low`` to ``high``."""
    found: set[int] = set()
    starts = [(0, 0)]  # where a shard can begin: ranges of bytes
    for _ in range(shards - 1):
        begins = []
        for a, b in starts:
            i = min(len(knots) - 1, bisect_right(totals, a + low) - 1)
            j = min(len(knots) - 1, bisect_right(totals, b + high) - 1)
            run = None  # knots of several groups that follow one another
            for k in range(i, j + 1):
                if knots[k].single:
                    if run is not None:
                        begins.append((totals[run], totals[k]))
                        run = None
                    begins += [(totals[k], totals[k]), (totals[k + 1], totals[k + 1])]
                else:
                    found.add(k)
                    run = k if run is None else run
            if run is not None:
                begins.append((totals[run], min(totals[j + 1], b + high)))
        starts = []
        for a, b in sorted(begins):
            if starts and a <= starts[-1][1]:
                starts[-1] = (starts[-1][0], max(b, starts[-1][1]))
            else:
                starts.append((a, b))
    return found


def _sums(groups: DataFrame, ranges: list[tuple[int, int]], bits: int) -> list[Knot]:
    """Each of the ranges in up to 2**bits parts. The ranges go out as a small table that is joined by key prefix."""
    shift = 64 - FIRST_BITS
    rows = [(a >> shift, i, a, b, max(0, (b - a).bit_length() - bits)) for i, (a, b) in enumerate(ranges)]
    table = groups.sparkSession.createDataFrame(rows, "prefix long, i int, a long, b long, shift int")
    inside = groups.withColumn("prefix", F.shiftright("group_key", shift)).join(F.broadcast(table), "prefix").where("group_key between a and b")
    part = F.expr("shiftright(group_key - a, shift)")
    found = inside.groupBy("i", "shift", part.alias("part")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("group_key").alias("key")).collect()
    out = []
    for r in found:
        a, b = ranges[r.i]
        first = a + (r.part << r.shift)
        single = r.n == 1
        out.append(Knot(r.key if single else first, r.key if single else min(b, first + (1 << r.shift) - 1), r["size"], single))
    return out


def _first_look(groups: DataFrame, total: int) -> list[Knot]:
    """Sums by key prefix; where a group is large, it and what lies before and behind it in its prefix."""
    shift = 64 - FIRST_BITS
    found = groups.groupBy(F.shiftright("group_key", shift).alias("p")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("group_key").alias("key")).collect()
    large = groups.where(F.col("size") > total >> FIRST_BITS).collect()  # fewer than 2**FIRST_BITS
    held: dict[int, list] = {}
    for g in large:
        held.setdefault(g.group_key >> shift, []).append(g)
    knots, between = [], []
    for r in found:
        first, last = r.p << shift, (r.p + 1 << shift) - 1
        if r.n == 1:
            knots.append(Knot(r.key, r.key, r["size"], True))
        elif r.p not in held:
            knots.append(Knot(first, last, r["size"], False))
        else:
            for g in sorted(held[r.p], key=lambda g: g.group_key):
                knots.append(Knot(g.group_key, g.group_key, g["size"], True))
                between.append((first, g.group_key - 1))
                first = g.group_key + 1
            between.append((first, last))
    between = [(a, b) for a, b in between if a <= b]
    return sorted(knots + (_sums(groups, between, 0) if between else []), key=lambda k: k.first)


def cut_points(groups: DataFrame, shards: int) -> list[int]:
    """The last group key of each shard but the last (keys ascending), for the least possible largest shard.

    ``groups``: group_key (a 64-bit hash, each once), size. The driver gets 2**FIRST_BITS sums and as
    many large groups at most, and LOOK sums in each later look, however many groups there are and
    whatever their sizes.
    """
    total, largest = groups.agg(F.sum("size"), F.max("size")).first()
    if total is None:
        return [2**63 - 1] * (shards - 1)
    knots, low = _first_look(groups, total), max(largest, -(-total // shards))
    while True:
        totals = _totals(knots)
        low = least_capacity(knots, totals, shards, low, divide=True)
        high = least_capacity(knots, totals, shards, low)
        if low == high:
            break
        todo = cut_ranges(knots, totals, shards, low, high)
        if 2 * len(todo) > LOOK:  # one capacity alone has its cuts in few ranges
            todo = cut_ranges(knots, totals, shards, (low + high) // 2, (low + high) // 2)
        bits = min(FIRST_BITS, max(1, (LOOK // len(todo)).bit_length() - 1))
        finer = _sums(groups, [(knots[i].first, knots[i].last) for i in sorted(todo)], bits)
        knots = sorted([k for i, k in enumerate(knots) if i not in todo] + finer, key=lambda k: k.first)
    return [knots[e - 1].last if e else -(2**63) for e in fill(knots, totals, shards, low)[:-1]]


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, group_key of every row.

    Groups of equal texts (by a 64-bit hash: should two texts collide, they only share a shard)
    stay together, in hash order; shard boundaries make the largest shard as small as possible.
    A null text is a group with size 1. Repeated rows get a slot each. Other columns are not read.
    An empty table gives an empty result.
    """
    text = F.col("text").cast("string")
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("group_key"), F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("group_key").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = cut_points(groups, shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("group_key") > F.lit(cut)).cast("int")
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(SLOT_BUCKETS)))
    # Slots: an offset for each bucket of a shard (at most shards x SLOT_BUCKETS sums), then places within the bucket;
    # buckets go by the stored number of a row, so equal rows are spread.
    offsets = (
        placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("base", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).drop("n")
    )
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("row"))
    return placed.withColumn("place", place).join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("place") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "group_key",
    )
