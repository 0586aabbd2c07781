"""Benchmark decontamination: SimHash of item-sized windows, a multi-index over Hamming blocks, exact verification.

A document window counts as a leak of an item if it has the item's number of words and their
multisets of word shingles are similar enough: sum of minima / sum of maxima. Two windows of n
shingles that similar share at least 8 n / 9 of them, in any order. So in each document the
shingles that stand in items of a size are marked, and every start whose window holds enough marks
is looked at. Each such window is fingerprinted from rolling bit counts; the index returns every
item of that size within RADIUS bits: if RADIUS bits are dealt to eight blocks of eight, one block
has at most RADIUS // 8 of them, and for each block and value a bitmap names the items that near.
Then the similarity is computed.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import ascii_words, batch_of, id_texts, keep_rows, slices, stored
from vacancia.llm.simhash import fingerprint, shingle_hashes

WIDTH, SIMILAR, RADIUS = 5, 0.8, 23
#: Items and bytes of item text in one broadcast; a larger benchmark is searched in several passes.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16_000_000
OUT = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("similarity", pa.float64()), ("hamming", pa.int32()), ("start_word", pa.int64())])
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes], width: int = WIDTH) -> Counter:
    return Counter(b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else Counter()


def similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over sum of the larger ones; 0 for two empty ones."""
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 0.0


def _run_keys(ids: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` word numbers; 0 where one of them is 0 (a word no item has)."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(width):
        part = ids[k : k + n]
        key = (key ^ part) * _MULTIPLIER
        key ^= key >> np.uint64(29)
        known &= part != 0
    return np.where(known, key | np.uint64(1), np.uint64(0))


@dataclass
class SizeClass:
    """Items of one number of words: numbers, shingles, fingerprints, and near[block][value], a bitmap of items."""

    items: list[int] = field(default_factory=list)
    shingles: list[Counter] = field(default_factory=list)
    prints: np.ndarray | None = None
    near: np.ndarray | None = None

    def within(self, fp: int) -> list[tuple[int, int]]:
        """(place, distance) of every item within RADIUS bits of ``fp``."""
        rows = [self.near[block, fp >> (8 * block) & 255] for block in range(8)]
        at = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(rows), count=len(self.items)))
        distance = np.bitwise_count(self.prints[at] ^ np.uint64(fp))
        return [(int(i), int(d)) for i, d in zip(at, distance) if d <= RADIUS]


@dataclass
class Index:
    vocabulary: dict[bytes, int]
    classes: dict[int, SizeClass]
    #: width -> (sorted run keys, for each the numbers of words of the items it stands in)
    anchors: dict[int, tuple[np.ndarray, list[list[int]]]]


def build(items: list[tuple[int, str | None]]) -> Index:
    """Index of (item_id, text); items without a word match nothing."""
    index = Index({}, {}, {})
    sizes: dict[int, dict[int, set]] = {}
    for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0])):
        words = ascii_words(text)
        if not words:
            continue
        c = index.classes.setdefault(len(words), SizeClass())
        c.items.append(item_id)
        c.shingles.append(shingles(words))
        ids = np.array([index.vocabulary.setdefault(w, len(index.vocabulary) + 1) for w in words], np.uint64)
        width = min(WIDTH, len(words))
        for key in _run_keys(ids, width).tolist():
            sizes.setdefault(width, {}).setdefault(key, set()).add(len(words))
        fp = fingerprint(shingle_hashes(words, WIDTH))
        c.prints = np.append(np.zeros(0, np.uint64) if c.prints is None else c.prints, np.uint64(fp))
    values = np.arange(256, dtype=np.uint8)[:, None]
    for c in index.classes.values():
        blocks = c.prints.astype("<u8").view(np.uint8).reshape(-1, 8)
        c.near = np.stack([np.packbits(np.bitwise_count(values ^ blocks[:, b][None, :]) <= RADIUS // 8, axis=1) for b in range(8)])
    for width, by_key in sizes.items():
        keys = sorted(by_key)
        index.anchors[width] = (np.array(keys, np.uint64), [sorted(by_key[k]) for k in keys])
    return index


def _starts(marks: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Starts of the windows of ``size`` words that hold enough of ``marks`` (sorted places of shingles of items of that size)."""
    width = min(WIDTH, size)
    n = size - width + 1
    if n_words <= size:  # the whole text is the window; a shorter one can be similar with fewer of them
        return np.zeros(1 if 5 * len(marks) >= 4 * n else 0, np.int64)
    need = -(-8 * n // 9)
    if len(marks) < need or (marks[need - 1 :] - marks[: len(marks) - need + 1]).min() >= n:
        return np.zeros(0, np.int64)
    before = np.zeros(n_words - width + 2, np.int32)
    before[marks + 1] = 1
    before = np.cumsum(before)
    return np.flatnonzero(before[n:] - before[:-n] >= need)


def _window_prints(hashes: np.ndarray, starts: np.ndarray, n: int):
    """(start, fingerprint) of the windows of ``n`` shingles at the sorted ``starts``, by rolling counts of the bits."""
    for group in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
        for at in range(0, len(group), 4096):
            some = group[at : at + 4096]
            part = hashes[some[0] : some[-1] + n]
            counts = np.zeros((len(part) + 1, 64), np.int32)
            np.cumsum(np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1), axis=0, out=counts[1:])
            low = some - some[0]
            high = np.minimum(low + n, len(part))
            bits = 2 * (counts[high] - counts[low]) > (high - low)[:, None]
            yield from zip(some.tolist(), np.packbits(bits, axis=1).view(">u8").reshape(-1).tolist())


def find(index: Index, text: str | None) -> list[tuple[int, float, int, int]]:
    """(item_id, best similarity, its Hamming distance, first word of the first such window) for each item leaked."""
    words = ascii_words(text)
    get = index.vocabulary.get
    ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    marks: dict[int, list[int]] = {}
    for width, (keys, sizes) in index.anchors.items():
        runs = _run_keys(ids, width)
        at = np.flatnonzero(runs)
        if not len(at):
            continue
        spot = np.minimum(np.searchsorted(keys, runs[at]), len(keys) - 1)
        hit = keys[spot] == runs[at]
        for p, s in zip(at[hit].tolist(), spot[hit].tolist()):
            for size in sizes[s]:
                marks.setdefault(size, []).append(p)
    best: dict[int, tuple] = {}
    hashes: dict[int, np.ndarray] = {}
    for size in sorted(marks):
        starts = _starts(np.array(marks[size]), len(words), size)
        if not len(starts):
            continue
        c, width = index.classes[size], min(WIDTH, size)
        if width not in hashes:
            hashes[width] = shingle_hashes(words, width)
        for start, fp in _window_prints(hashes[width], starts, size - width + 1):
            near = c.within(fp)
            if near:
                own = shingles(words[start : start + size])
                for i, distance in near:
                    s = similarity(own, c.shingles[i])
                    if s >= SIMILAR and (c.items[i] not in best or s > best[c.items[i]][0]):
                        best[c.items[i]] = (s, distance, start)
    return [(item, *best[item]) for item in sorted(best, key=lambda x: (x is None, x))]


def _named(benchmark: DataFrame) -> DataFrame:
    """key (of the text), item_id, text of the items that have one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.where("text is not null").select(F.xxhash64("text").alias("key"), "item_id", "text")


def indexes(benchmark: DataFrame, block_items: int, block_bytes: int) -> tuple[int, Iterator[Index]]:
    """How many indexes there are, and one after another, each over a block of the items' distinct texts within the block bounds.

    Items that share a text are in it once, under its key. The driver holds one block.
    """
    texts = stored(_named(benchmark).groupBy("key").agg(F.first("text").alias("text")), "benchmark-texts")
    n, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    block = F.pmod(F.xxhash64("key", F.lit("block")), F.lit(blocks))
    return blocks, (build([tuple(r) for r in (texts.where(block == b) if blocks > 1 else texts).select("key", "text").collect()]) for b in range(blocks))


@functools.lru_cache(maxsize=1)
def _held(broadcast) -> Index:
    return broadcast.value


def leaks(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, similarity, hamming, start_word: every item that a document leaks, with its best window.

    Map-only over whole texts, once for each block of the benchmark; only what was found joins the
    items' ids. A null or blank text leaks nothing; items without a word are never leaked; an
    item of fewer than WIDTH words is one shingle and needs those words in a row. Repeated rows
    each give theirs; equal items are all named; an empty benchmark gives none. Other columns are not read.
    """
    texts = id_texts(docs)
    blocks, made = indexes(benchmark, block_items, block_bytes)
    out = None
    for index in made:
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, held=held):
            index = _held(held)
            for part in slices(batches):
                rows = [(d, *x) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()) for x in find(index, t)]
                yield batch_of(OUT, *(zip(*rows) if rows else [[]] * len(OUT)))

        found = texts.mapInArrow(run, "doc_id long, key long, similarity double, hamming int, start_word long")
        if blocks > 1:  # the block's rows are written and its index is dropped before the next one is built
            found = stored(found, "leaks")
            held.destroy()
        out = found if out is None else out.unionByName(found)
    return out.join(_named(benchmark).select("key", "item_id"), "key").select("doc_id", "item_id", "similarity", "hamming", "start_word")


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` that leak no item; all columns stay. Rows with a null or blank text stay, and all rows for an empty benchmark."""
    blocks, made = indexes(benchmark, block_items, block_bytes)
    for index in made:
        held = docs.sparkSession.sparkContext.broadcast(index)

        def decide(held=held):
            index = _held(held)
            return lambda texts: [not find(index, t) for t in texts]

        docs = keep_rows(docs, decide)
        if blocks > 1:
            docs = stored(docs, "unleaked")
            held.destroy()
    return docs
