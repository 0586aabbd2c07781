"""Near-duplicates by SimHash with pigeonring filtering.

The 64 bits form a ring of SEGMENTS segments. If two fingerprints differ in at most RADIUS bits, a
segment exists from which every run of l segments around the ring differs in at most
l * RADIUS / SEGMENTS bits. So candidates share one segment exactly (budget 0) and differ in at
most one bit of the next (budget 1), which leaves one of its halves equal: a fingerprint is dealt
to SEGMENTS x 2 buckets keyed by a segment and half of the next. In a bucket the budgets of longer
runs prune further before the full Hamming check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import ascii_words, batch_of, id_texts, ship, slices, stored
from vacancia.llm.components import connected
from vacancia.llm.simhash import fingerprint, shingle_hashes

RADIUS, SEGMENTS = 4, 5
#: First bit and width of each segment, from the low end.
RING = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Fingerprints that one task compares at most; larger buckets are dealt in pairs of parts.
PART = 20_000
PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _segment(i: int) -> np.uint64:
    first, width = RING[i % SEGMENTS]
    return np.uint64(((1 << width) - 1) << first)


def chain_masks(start: int) -> list[tuple[np.uint64, int]]:
    """(mask of the run, its budget) for runs of 1 to SEGMENTS segments from ``start``; the last is the full check."""
    out, mask = [], np.uint64(0)
    for l in range(1, SEGMENTS + 1):
        mask |= _segment(start + l - 1)
        out.append((mask, l * RADIUS // SEGMENTS))
    return out


CHAINS = [chain_masks(i) for i in range(SEGMENTS)]


def within(x: np.ndarray, start: int) -> np.ndarray:
    """Positions of the differences ``x`` that keep all budgets of the chain from ``start``."""
    at = np.arange(len(x))
    for mask, budget in CHAINS[start]:
        at = at[np.bitwise_count(x[at] & mask) <= budget]
        if not len(at):
            break
    return at


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number) of every whole text; map-only."""

    def run(batches):
        for part in slices(batches):
            prints = np.array([fingerprint(shingle_hashes(ascii_words(t), width)) for t in part.column("text").to_pylist()], np.uint64)
            yield batch_of(PRINTS, part.column("doc_id"), prints.view(np.int64))

    return id_texts(docs).mapInArrow(run, "doc_id long, fp long")


def _spread(prints: np.ndarray, start: int, left: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that join what the bucket's fingerprints connect, found by walking from one to all within reach.

    Each compares itself with those not yet reached only, so a dense bucket of g near copies takes
    about g comparisons and gives g - 1 links, not g * g. ``left`` (for a pair of parts) marks the
    first part: only links between the parts are looked for there.
    """
    links, open_ = [], np.ones(len(prints), bool)
    for seed in range(len(prints)):
        if not open_[seed]:
            continue
        open_[seed] = False
        reached = [seed]
        while reached:
            i = reached.pop()
            rest = np.flatnonzero(open_ if left is None else open_ & (left != left[i]))
            if not len(rest):
                continue
            hit = rest[within(prints[rest] ^ prints[i], start)]
            open_[hit] = False
            links += [(prints[i], prints[j]) for j in hit]
            reached += hit.tolist()
    return links


def _link(batches):
    """Links within each bucket; rows arrive sorted by bucket, and one bucket is held at a time."""
    kept: list[tuple] = []

    def close(key, side, fp):
        a, b = np.concatenate(key), np.concatenate(fp).view(np.uint64)
        s = np.concatenate(side)
        edges = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        sizes = np.diff(np.append(edges, len(a)))
        out = []
        small = sizes == 2  # most buckets with a pair have just one
        first = edges[small]
        for start in range(SEGMENTS):
            mine = first[(a[first] & 7) == start]
            hit = mine[within(b[mine] ^ b[mine + 1], start)] if len(mine) else mine
            out += list(zip(b[hit], b[hit + 1]))
        for at, n in zip(edges[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            part = s[at : at + n]
            out += _spread(b[at : at + n], int(a[at]) & 7, part == 1 if part.any() else None)
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return batch_of(LINKS, pairs[:, 0], pairs[:, 1])

    for batch in batches:
        key, side, fp = (batch.column(i).to_numpy() for i in range(3))
        if not len(key):
            continue
        ends = np.flatnonzero(key != key[-1])
        whole = int(ends[-1]) + 1 if len(ends) else 0
        if whole or (kept and kept[0][0][0] != key[0]):
            yield close(*zip(*kept, (key[:whole], side[:whole], fp[:whole])))
            kept = []
        kept.append((key[whole:], side[whole:], fp[whole:]))
    if kept:
        yield close(*zip(*kept))


def near_links(prints: DataFrame, part: int = PART) -> DataFrame:
    """u, v: links among the distinct fingerprints (column fp) that connect all pairs within RADIUS bits."""
    ship(prints.sparkSession)
    fp = F.col("fp")

    def bits(first: int, width: int):
        return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))

    entries = []
    for i in range(SEGMENTS):
        (first, width), (after, wide) = RING[i], RING[(i + 1) % SEGMENTS]
        low = wide // 2
        for half, (a, w) in enumerate(((after, low), (after + low, wide - low))):
            key = F.shiftleft(F.shiftleft(bits(first, width), 7).bitwiseOR(bits(a, w)), 4).bitwiseOR(F.lit(half * 8 + i))
            entries.append(F.struct(key.cast("long").alias("key"), F.lit(i).alias("start")))
    dealt = prints.select(fp, F.inline(F.array(*entries)))
    # Buckets over the part size: at most 10 * rows / part of them, counted without moving fingerprints.
    large = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part).select("key", F.ceil(F.col("n") / part).cast("int").alias("parts"))
    large = stored(large, "large-buckets")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # A part meets itself and each other part once: pair (low, high) with the row's side in it.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    split = dealt.join(large, "key").select("key", "fp", mine.alias("mine"), "parts", other).select(
        F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("mixed"), "key",
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "fp",
    ).select(F.col("mixed").bitwiseAND(F.lit(-8)).bitwiseOR(F.col("key").bitwiseAND(F.lit(7))).alias("key"), "side", "fp")
    whole = dealt.join(large, "key", "left_anti").select("key", F.lit(0).alias("side"), "fp")
    parts = whole.unionByName(split)
    return parts.select("key", F.col("side").cast("long").alias("side"), "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_link, "u long, v long")


def roots(prints: DataFrame) -> DataFrame:
    """fp, root: of each distinct fingerprint (column fp) with another one within reach over links, the smallest reachable."""
    ties = connected(near_links(prints))
    return ties.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(ties.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct())


def near_groups(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable over links).

    Copies share a fingerprint, so links are sought among distinct fingerprints only. A null or
    blank text has fingerprint zero and links like any other. Rows without doc_id take part as
    links but never name a component (null if all its rows lack one). Repeated rows each give a
    row; an empty table gives none; columns other than doc_id and text are not read.
    """
    rows = stored(fingerprints(docs, width), "prints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    root = distinct.join(roots(distinct.select("fp")), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    smallest = stored(root, "roots")
    named = smallest.join(smallest.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
