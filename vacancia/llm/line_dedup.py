"""Lines that many documents hold: sharded minimal perfect hashes index their fingerprints, counts and last holders.

A first pass counts, for each distinct line key, the documents that hold it. Keys that enough of them
hold are dealt to shards by their hash. A shard is a minimal perfect hash (levels of bit arrays: a
key takes the first level where no other key has its place, so 2 to 4 bits a key lead to a number
below the number of keys) and, at that number, the key's fingerprint, count and last holder. The
second pass is a map over the documents: their lines probe the broadcast shards, and no line is
shuffled or joined. A line that no shard holds lands on some other key's number and is told apart by
the fingerprint: 64 of its 128 hash bits.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import batch_of, ship, slices, stored

#: What is stripped from a line's ends for its key.
BLANKS = " \t\n\x0b\x0c\r"
#: Keys of a shard, about (a shard is a broadcast of some 6 MB), and shards that are broadcast for one pass over the documents.
SHARD_KEYS, PASS_SHARDS = 1 << 18, 128
#: Distinct keys a task counts before it gives them on.
HELD_KEYS = 200_000
#: Bits of a level for each key that is left to it.
ROOM = 2
#: Shards a worker keeps as arrays.
KEPT_SHARDS = 4
COUNTS = pa.schema([("hash", pa.int64()), ("fingerprint", pa.int64()), ("n", pa.int64()), ("last", pa.int64())])
SHARD = pa.schema([("shard", pa.int32()), ("arrays", pa.binary())])
OUT = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("n_holders", pa.int64()), ("dropped", pa.list_(pa.int32())),
])
OUT_DDL = "doc_id long, text string, n_lines long, n_dropped long, n_holders long, dropped array<int>"
#: Stands for a null doc_id among holders: before all others.
NO_ID = -(2**63)


def line_hashes(lines: list[str], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the lines whose keys have ``least`` code points or more, and the keys' hashes as rows (hash, fingerprint)."""
    keys = [x.strip(BLANKS) for x in lines]
    at = [i for i, k in enumerate(keys) if len(k) >= least]
    # Lower-casing bytes changes A-Z alone.
    data = b"".join(xxhash.xxh3_128_digest(keys[i].encode("utf-8", "replace").lower()) for i in at)
    return np.array(at, np.int64), np.frombuffer(data, ">i8").astype(np.int64).reshape(-1, 2)


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Random 64 bits for each of the rows (hash, fingerprint), others on each level."""
    pair = keys.view(np.uint64) if keys.flags.c_contiguous else np.ascontiguousarray(keys).view(np.uint64)
    x = (pair[:, 0] ^ np.uint64(level * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x = ((x ^ (x >> np.uint64(29))) + pair[:, 1]) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Numbers 0 to n - 1 for n distinct rows (hash, fingerprint), in 2 to 4 bits each; any other row gets some number or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.ranks, before = levels, [], 0  # bytes of bits, least bit first; ones before each byte
        for bits in levels:
            ones = np.cumsum(_ONES[bits], dtype=np.int64)
            self.ranks.append(before + ones - _ONES[bits])
            before += int(ones[-1])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            bits = -(-ROOM * len(keys) // 64) * 64
            at = (_mixed(keys, len(levels)) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = (_mixed(keys[open_], level) % np.uint64(8 * len(bits))).astype(np.int64)
            byte, bit = bits[at >> 3], at & 7
            one = (byte >> bit) & 1 == 1
            out[open_[one]] = (ranks[at >> 3] + _ONES[byte & ((1 << bit) - 1).astype(np.uint8)])[one]
            open_ = open_[~one]
        return out


_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass
class Shard:
    """Keys' fingerprints, counts of holders (up to 2**32 - 1) and last holders, by their perfect number."""

    index: PerfectHash
    fingerprints: np.ndarray
    counts: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, last: np.ndarray) -> Shard:
        index = PerfectHash.of(keys)
        order = np.argsort(index.numbers(keys))
        return cls(index, keys[order, 1], np.minimum(counts, 2**32 - 1).astype(np.uint32)[order], last[order])

    def pack(self) -> bytes:
        parts = [*self.index.levels, self.fingerprints, self.counts, self.last]
        sizes = np.array([len(self.index.levels), *(x.nbytes for x in parts)], np.int64)
        return b"".join([sizes.tobytes(), *(x.tobytes() for x in parts)])

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n + 3, 8)
        ends = 8 * (n + 4) + np.cumsum(sizes)
        arrays = [np.frombuffer(data[b - size : b], kind) for size, b, kind in zip(sizes.tolist(), ends.tolist(), [np.uint8] * n + [np.int64, np.uint32, np.int64])]
        return cls(PerfectHash(arrays[:n]), *arrays[n:])

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Holders (0: not a key of this shard) and last holder of each of the rows (hash, fingerprint)."""
        if not len(self.counts):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = self.index.numbers(keys)
        known = (at >= 0) & (self.fingerprints[at] == keys[:, 1])
        return np.where(known, self.counts[at], 0).astype(np.int64), self.last[at]


def line_counts(docs: DataFrame, least: int) -> DataFrame:
    """hash, fingerprint, n (documents that hold the key), last (the largest doc_id among them); tasks sum up before the shuffle."""

    def run(batches):
        held: dict[bytes, list] = {}

        def close():
            flat = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
            return batch_of(COUNTS, flat[:, 0], flat[:, 1], *zip(*held.values()))

        for part in slices(batches):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                doc_id = NO_ID if doc_id is None else doc_id
                keys = line_hashes((text or "").split("\n"), least)[1].tobytes()
                for key in {keys[i : i + 16] for i in range(0, len(keys), 16)}:
                    seen = held.get(key)
                    if seen is None:
                        held[key] = [1, doc_id]
                    else:
                        seen[0] += 1
                        seen[1] = max(seen[1], doc_id)
            if len(held) > HELD_KEYS:
                yield close()
                held.clear()
        if held:
            yield close()

    counted = docs.mapInArrow(run, "hash long, fingerprint long, n long, last long")
    return counted.groupBy("hash", "fingerprint").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def build_shards(counts: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """shard, arrays (a packed Shard) of the keys in ``counts``, and how many shards they are dealt to, by their hash."""
    held = stored(counts, "line-keys")
    shards = max(1, -(-held.count() // shard_keys))

    def run(batches):
        # Rows come sorted by shard; one shard's keys are held at a time.
        shard, held = None, []

        def close():
            hashes, fingerprints, counts, last = (np.concatenate([h[c] for h in held]) for c in range(4))
            return batch_of(SHARD, [shard], [Shard.of(np.stack([hashes, fingerprints], axis=1), counts, last).pack()])

        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(numbers)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
                if shard is not None and numbers[a] != shard:
                    yield close()
                    held = []
                shard = int(numbers[a])
                held.append([batch.column(c).to_numpy()[a:b].copy() for c in ("hash", "fingerprint", "n", "last")])
        if held:
            yield close()

    dealt = held.withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int")).repartition("shard").sortWithinPartitions("shard")
    return stored(dealt.mapInArrow(run, "shard int, arrays binary"), "line-shards"), shards


@functools.lru_cache(maxsize=KEPT_SHARDS)
def _shard(held) -> Shard:
    """``Broadcast.value`` would keep every shard that was ever read."""
    path = getattr(held, "_path", None)
    return Shard.unpack(held.load_from_path(path) if path else held.value)


def _probe(rows: DataFrame, broadcasts: dict, shards: int, least: int, min_docs: int, last_pass: bool) -> DataFrame:
    """Adds to ``dropped`` the places of lines that a key of the ``broadcasts`` (shard -> arrays) takes away; map-only. The last pass cuts them out.

    The more shards, the more lines are probed together, so that each shard is read for enough of them.
    """
    room = 20_000 * min(len(broadcasts), 16) + 20_000

    def run(batches):
        held: list = []

        def close():
            lines = [r["text"].split("\n") for r in held]
            found = [line_hashes(x, least) for x in lines]
            keys = np.concatenate([k for _, k in found])
            owner = np.repeat(np.arange(len(held)), [len(k) for _, k in found])
            ids = np.array([NO_ID if r["doc_id"] is None else r["doc_id"] for r in held], np.int64)[owner]
            shard, take, many = keys[:, 0] % shards, np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
            for s in np.unique(shard).tolist():
                if s in broadcasts:
                    own = np.flatnonzero(shard == s)
                    holders, last = _shard(broadcasts[s]).probe(keys[own])
                    many[own] = holders
                    take[own] = (holders >= min_docs) & (ids[own] != last)
            ends = np.searchsorted(owner, np.arange(len(held) + 1))
            out = []
            for i, (r, (at, _)) in enumerate(zip(held, found)):
                a, b = ends[i], ends[i + 1]
                gone = np.union1d(np.array(r["dropped"], np.int64), at[take[a:b]])
                most = max(r["n_holders"], int(many[a:b][take[a:b]].max(initial=0)))
                text = r["text"]
                if last_pass and len(gone):
                    stays = np.ones(len(lines[i]), bool)
                    stays[gone] = False
                    text = "\n".join(itertools.compress(lines[i], stays))
                out.append((r["doc_id"], text, len(lines[i]), len(gone), most, gone.astype(np.int32)))
            return batch_of(OUT, *zip(*out))

        n = 0
        for part in slices(batches):
            for r in part.to_pylist():
                held.append(r)
                n += r["text"].count("\n") + 1
                if n >= room or len(held) >= room // 8:
                    yield close()
                    held, n = [], 0
        if held:
            yield close()

    return rows.mapInArrow(run, OUT_DDL)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, least: int = 20, shard_keys: int = SHARD_KEYS, pass_shards: int = PASS_SHARDS) -> DataFrame:
    """doc_id, text, n_lines, n_dropped, n_holders, dropped of every row, without lines that many documents hold.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of ``least`` code points
    or more that ``min_docs`` or more rows hold lose all their lines except those in the largest
    doc_id holding them; ``dropped`` has the places of the lines that went (from 0), n_holders how many
    documents hold the most frequent of them (0: none went). The lines that stay are joined by
    line ends; if none stays the text is empty.

    A null or empty text is one empty line. Repeated rows count as documents of their own; if they
    have the largest doc_id, all of them keep their lines. A null doc_id is smaller than any other.
    An empty table gives none; other columns are not read.

    At most ``pass_shards`` shards of about ``shard_keys`` keys (some 6 MB each) are broadcast at a time;
    more shards take more passes, each over the stored rows of the one before.
    """
    spark = docs.sparkSession
    ship(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    arrays, shards = build_shards(line_counts(own, least).where(F.col("n") >= min_docs), shard_keys)
    rows = own.select("*", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.lit(0).cast("long").alias("n_holders"), F.array().cast("array<int>").alias("dropped"))
    for first in range(0, shards, pass_shards):
        if first:
            rows = stored(rows, "line-pass")
            for shard in held.values():
                shard.destroy()
        # One shard at a time comes to the driver and goes out.
        some = arrays.where(F.col("shard").between(first, first + pass_shards - 1)).toLocalIterator()
        held = {r["shard"]: spark.sparkContext.broadcast(bytes(r["arrays"])) for r in some}
        rows = _probe(rows, held, shards, least, min_docs, first + pass_shards >= shards)
    return rows
