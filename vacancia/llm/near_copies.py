"""Near copies by shingle similarity: SimHash links and MinHash bands find candidates, the whole shingle sets decide.

Two texts are near copies if their sets of word shingles have a Jaccard similarity of SIMILAR or
more. Fingerprints of the same shingles are linked by the SimHash operator (pigeonring, RADIUS bits),
and all texts of one of its groups are candidates. Texts that are just similar enough differ by about ten bits, though; so
each set is also dealt to BANDS buckets, each keyed by ROWS of its minima under random hashes; at
similarity s two sets share a bucket with probability 1 - (1 - s ** ROWS) ** BANDS, at 0.8 all but
1.3e-7. Every set is tied to the smallest of its buckets and SimHash groups, so candidates need no pair lists. Within each
group tied that way all sets are compared by a walk from set to set over what is not yet reached;
large groups are dealt as pairs of parts. Groups so large that this would move their sets more than
once a band (texts that have nothing but a licence in common may tie thousands of them) are compared
within their buckets instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm import simhash_dedup
from vacancia.llm.common import ascii_words, batch_of, id_texts, slices, stored
from vacancia.llm.components import connected
from vacancia.llm.simhash import fingerprint, shingle_hashes

WIDTH = 5
#: The least similarity, as a fraction of whole numbers: 0.8.
SIMILAR = (4, 5)
BANDS, ROWS = 40, 5
#: Sets and shingles of a part of a group of candidates.
PART, PART_SHINGLES = 256, 200_000
#: A group of more parts than this is compared bucket by bucket: it moves each set once a band, not once a part.
BY_BUCKET = BANDS
_RANDOM = np.random.Generator(np.random.PCG64(42))
_XOR = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_FOLD = _RANDOM.integers(0, 1 << 64, ROWS, np.uint64) | np.uint64(1)
#: Bits of the map of candidates' set numbers that is broadcast, so that other sets are not moved.
MAP_BITS = 25
KEYS = pa.schema([("doc_id", pa.int64()), ("set", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))])
SETS = pa.schema([("set", pa.int64()), ("shingles", pa.binary())])
LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A number for each band; of no shingles, none."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        mixed = (shingles[at : at + 512, None] ^ _XOR) * _TIMES
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0))
    folded = ((least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(29))) * _FOLD).sum(axis=1, dtype=np.uint64)
    # The band is in the key, so that minima of different bands don't meet.
    return ((folded ^ (folded >> np.uint64(31))) & ~np.uint64(63) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _hashes(texts: list, width: int) -> list[np.ndarray]:
    return [shingle_hashes(ascii_words(t), width) for t in texts]


def _sets(hashes: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct shingles of each text and the set's number."""
    sets = list(map(np.unique, hashes))
    return sets, np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)


def set_keys(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, set (a number of the shingle set), fp (its SimHash, null without words) and band keys of every whole text; map-only."""

    def run(batches):
        for part in slices(batches):
            hashes = _hashes(part.column("text").to_pylist(), width)
            sets, numbers = _sets(hashes)
            prints = np.array([fingerprint(h) for h in hashes], np.uint64).view(np.int64)
            yield batch_of(KEYS, part.column("doc_id"), numbers, [p if len(h) else None for p, h in zip(prints.tolist(), hashes)], [band_keys(s) for s in sets])

    return id_texts(docs).mapInArrow(run, "doc_id long, set long, fp long, keys array<long>")


def candidate_sets(docs: DataFrame, groups: DataFrame, width: int = WIDTH) -> DataFrame:
    """set, size, shingles, root of the distinct sets in ``groups`` (set, root), made again from the texts: few are needed."""
    bit = F.col("set").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = groups.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(set & 63 as int))").alias("bits")).groupBy("at").agg(F.bit_or("bits").alias("bits")).collect()
    bits = np.zeros(1 << MAP_BITS - 6, np.int64)
    for r in words:
        bits[r.at] = r.bits
    held = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def run(batches):
        for part in slices(batches):
            sets, numbers = _sets(_hashes(part.column("text").to_pylist(), width))
            at = numbers & ((1 << MAP_BITS) - 1)
            maybe = np.flatnonzero(held.value[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
            yield batch_of(SETS, numbers[maybe], [sets[i].tobytes() for i in maybe])

    found = id_texts(docs).mapInArrow(run, "set long, shingles binary").groupBy("set").agg(F.first("shingles").alias("shingles"))
    return found.join(groups, "set").select("set", (F.octet_length("shingles") / 8).cast("long").alias("size"), "shingles", "root")


def similar_links(sets: np.ndarray, blobs: list[bytes], left: np.ndarray | None) -> list[tuple[int, int]]:
    """Links that join what pairs of similar sets connect; ``left``, if given, marks the first of two parts, and only links between them are sought.

    Each set compares itself with all not yet reached at once.
    """
    sizes = np.array([len(b) // 8 for b in blobs], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at, often = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True, return_counts=True)
    shared = often[at] > 1  # the others meet nothing
    owner, at = owner[shared], at[shared]
    ends = np.searchsorted(owner, np.arange(len(sets) + 1))
    flag, links, open_ = np.zeros(len(often), bool), [], np.ones(len(sets), bool)
    top, bottom = SIMILAR
    for seed in range(len(sets)):
        if not open_[seed]:
            continue
        open_[seed] = False
        reached = [seed]
        while reached:
            i = reached.pop()
            rest = open_ & (bottom * np.minimum(sizes, sizes[i]) >= top * np.maximum(sizes, sizes[i]))
            if left is not None:
                rest &= left != left[i]
            if not rest.any():
                continue
            mine = at[ends[i] : ends[i + 1]]
            flag[mine] = True
            both = np.bincount(owner[flag[at]], minlength=len(sets))
            flag[mine] = False
            hit = np.flatnonzero(rest & (bottom * both >= top * (sizes + sizes[i] - both)))
            open_[hit] = False
            links += [(int(sets[i]), int(sets[j])) for j in hit]
            reached += hit.tolist()
    return links


def _link(batches):
    """Links within each group; rows arrive sorted by group, and one group is held at a time."""
    key, sets, sides, blobs = None, [], [], []

    def close():
        left = np.array(sides) == 1
        links = similar_links(np.array(sets), blobs, left if left.any() else None)
        return batch_of(LINKS, *(zip(*links) if links else [[]] * 2))

    for batch in batches:
        for k, s, side, b in zip(*(batch.column(c).to_pylist() for c in ("key", "set", "side", "shingles"))):
            if k != key and sets:
                yield close()
                sets, sides, blobs = [], [], []
            key = k
            sets.append(s)
            sides.append(side)
            blobs.append(b)
    if sets:
        yield close()


def similar_pairs(docs: DataFrame, rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """u, v: links among the distinct sets of ``docs`` (``rows``: their stored set_keys) that connect all pairs of similar ones."""
    bands = rows.groupBy("set").agg(F.first("keys").alias("keys")).select("set", F.explode("keys").alias("key"))
    dealt = stored(bands.unionByName(simhash_keys(rows)), "buckets")
    first = dealt.groupBy("key").agg(F.min("set").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first")
    ties = connected(dealt.join(first, "key").where("set != first").select(F.col("set").alias("u"), F.col("first").alias("v")))
    groups = stored(ties.select(F.col("u").alias("set"), F.col("v").alias("root")).unionByName(ties.select(F.col("v").alias("set"), F.col("v").alias("root")).distinct()), "candidates")
    held = stored(candidate_sets(docs, groups, width), "candidate-sets")
    sizes = held.groupBy("root").agg(_parts().alias("parts"))
    small = _paired(held.join(sizes.where(F.col("parts") <= BY_BUCKET), "root"), "root")
    # Sets of a large group meet again only where they share a bucket.
    large = held.join(sizes.where(F.col("parts") > BY_BUCKET).select("root"), "root").join(dealt, "set")
    buckets = large.groupBy("key").agg(_parts().alias("parts"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    split = small.unionByName(_paired(large.drop("root").join(buckets, "key"), "key"))
    return split.repartition("key").sortWithinPartitions("key").mapInArrow(_link, "u long, v long")


def simhash_keys(rows: DataFrame) -> DataFrame:
    """set, key: a bucket for each group of fingerprints (fp of ``rows``) that the SimHash operator links; a set whose texts repeat shingles unlike may have several."""
    prints = stored(rows.where("fp is not null").select("set", "fp").distinct(), "set-prints")
    linked = prints.join(simhash_dedup.roots(prints.select("fp").distinct()), "fp", "left").select("set", F.coalesce("root", "fp").alias("root"))
    # The band's place in a key holds a number that no band has.
    return linked.select("set", F.xxhash64("root").bitwiseOR(F.lit(63)).alias("key")).distinct()


def _parts():
    return F.greatest(F.ceil(F.count(F.lit(1)) / PART), F.ceil(F.sum("size") / PART_SHINGLES)).cast("int")


def _paired(rows: DataFrame, group: str) -> DataFrame:
    """key, set, side, shingles: a group's sets in ``parts`` parts; a part meets itself and each other part once, as pair (low, high) with the row's side in it."""
    mine = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    pairs = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return pairs.select(
        F.xxhash64(group, F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), "set", F.when(F.col("mine") > F.col("other"), 1).otherwise(0).cast("long").alias("side"), "shingles",
    )


def keep_one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of each group of near copies of ``docs``: one with the group's smallest doc_id; all columns stay.

    Groups are what links between similar texts connect. Texts without a word are copies of each
    other. Rows without doc_id take part as links and stay, as nothing names them. Repeated rows
    are copies; an empty table gives none.
    """
    rows = stored(set_keys(docs, width), "set-keys")
    ties = connected(similar_pairs(docs, rows, width))
    least = rows.groupBy("set").agg(F.min("doc_id").alias("least"))
    rooted = least.join(ties.select(F.col("u").alias("set"), "v"), "set", "left").select(F.coalesce("v", "set").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("doc_id")).where("doc_id is not null").select("doc_id")
    one = docs.join(named, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.select(docs.columns).unionByName(docs.where("doc_id is null"))
