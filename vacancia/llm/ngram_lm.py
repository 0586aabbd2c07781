"""Language-model scoring with n-gram counts in a log-frequency Bloom filter.

A pair (word, next word) whose count is c is put into one Bloom filter at levels 1 to
1 + floor(log2 c): the filter holds counts as powers of two. A worker probes level 1, 2, ... until
one is missing and so reads a count that is never above the true one, but for the filter's rare
false positives. P(w | h) = (pair(h, w) + T * P(w)) / (count(h) + T), with P the add-one unigram.

Every pair counts. Pairs of frequent words, which have numbers, are named by those; any other pair,
of rare or long words, by a 62-bit hash. The own counts of words without a number are in the filter
too: no pair is more frequent than its context.

The filter grows with the counts, in parts of equal size that are broadcast one by one; a worker
holds a few of them at a time. Pairs beyond the last part allowed join the texts that miss them.
"""

from __future__ import annotations

import functools
import itertools
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import ascii_words, batch_of, merge_counts, ship, slices, stored
from vacancia.session import work_dir

#: Words that have numbers (the others go by hashes); bits, segments and hashes of a part of the filter.
WORDS, PART_BITS, SEGMENTS, HASHES = 1 << 17, 1 << 27, 256, 4
#: Entries (pair, level) a part takes: ten bits each.
CAPACITY = PART_BITS // 10
SEGMENT_BITS = PART_BITS // SEGMENTS
#: The most parts that are broadcast, 2 GB in all.
PARTS = 128
#: Characters of text whose pairs are probed together: for each part of the filter, and at most.
CHUNK, CHUNKS = 1_000_000, 8_000_000
#: Counts of pairs that one group sums, about.
GROUP = 250_000
#: Pairs a task sorts by segment at a time to put them into the filter.
FILLED = 1_000_000
#: A prime that spreads pairs over segments.
SPREAD = 1_000_003
#: Weight T of the unigram against the pair counts.
SMOOTHING = 8.0
#: The end of a text in the word table; no word can hold a blank.
END = " "
COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
PAIRS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
LISTS = pa.schema([("group", pa.int64()), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
SEGMENT = pa.schema([("segment", pa.int32()), ("bits", pa.binary())])
_RARE = pa.list_(pa.struct([("word", pa.string()), ("held", pa.int64()), ("k", pa.int64())]))
_MISSED = pa.list_(pa.struct([("pair", pa.int64()), ("k", pa.int64()), ("gain", pa.float64()), ("word", pa.string())]))
SCORED = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base", pa.float64()), ("model", pa.float64()), ("rare", _RARE),
    ("missed", _MISSED),
])
SCORED_DDL = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
    "rare array<struct<word:string,held:long,k:long>>, missed array<struct<pair:long,k:long,gain:double,word:string>>"
)


def word_counts(texts: DataFrame) -> DataFrame:
    """word, n over all whole texts (column text), the end of each text counted as the word ``END``."""

    def run(batches):
        seen: Counter = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                seen.update(ascii_words(text))
                seen[END.encode()] += 1
            if len(seen) > 400_000:
                yield batch_of(COUNTS, list(seen), list(seen.values()))
                seen = Counter()
        yield batch_of(COUNTS, list(seen), list(seen.values()))

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_count(levels: list, room: int) -> int:
    """The least count for which at most ``room`` keys have it or more; levels: (count, keys) rows."""
    held, least = 0, None
    for n, keys in sorted(((r[0], r[1]) for r in levels), reverse=True):
        held += keys
        if held > room:
            break
        least = n
    return least if least is not None else 1 << 62


@dataclass
class Vocabulary:
    """Numbers of the frequent words (1 up, in their order) and their counts; ``end`` is the end's number, always there. The numbers are made where they are asked for, in the tasks."""

    words: pa.Array
    counts: np.ndarray
    total: int
    distinct: int

    @functools.cached_property
    def numbers(self) -> dict[bytes, int]:
        return dict(zip(self.words.to_pylist(), itertools.count(1)))

    @property
    def end(self) -> int:
        return self.numbers[END.encode()]


def frequent_words(counts: DataFrame, room: int = WORDS) -> Vocabulary:
    """Numbers for at most ``room`` words of up to 64 bytes (and the end), those with the highest counts, no tie cut: a shorter way, pairs of the others count too."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    levels = counts.where(F.octet_length("word") <= 64).groupBy("n").agg(F.count(F.lit(1))).collect()
    least = least_count(levels, room)
    rows = counts.where((F.col("n") >= least) & (F.octet_length("word") <= 64) | (F.col("word") == END)).orderBy(F.desc("n"), "word").toArrow()
    words, values = rows["word"].cast(pa.binary()).combine_chunks(), [np.zeros(1, np.int64), rows["n"].to_numpy()]
    if pc.index(words, END.encode()).as_py() < 0:
        words = pa.concat_arrays([words, pa.array([END.encode()])])
        values.append(np.zeros(1, np.int64))
    return Vocabulary(words, np.concatenate(values), total, distinct)


def _numbered(v: Vocabulary, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(v.numbers.get, words, itertools.repeat(0)), np.int64, len(words))


def _key(before, word: np.ndarray) -> np.ndarray:
    """Names of pairs that are not of two numbered words, beyond the names of those; of ``before`` 0, of the word alone."""
    return (_mix(_mix(np.asarray(before, np.uint64)) + word) >> np.uint64(2) | np.uint64(1 << 62)).view(np.int64)


@dataclass
class Keyed:
    """Texts' words, each with its end, one after another: first places, numbers (0: none) of each word and of its context (a text's end is that of its first word), names of the pairs, and the words without a number, with places and own names."""

    starts: np.ndarray
    ids: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    at: np.ndarray
    words: list[bytes]
    own: np.ndarray


def _keyed(v: Vocabulary, texts: list[str | None]) -> Keyed:
    words, ends = [], []
    for text in texts:
        words += ascii_words(text)
        words.append(END.encode())
        ends.append(len(words))
    last = np.array(ends, np.int64) - 1
    starts = np.concatenate([[0], last[:-1] + 1])

    def shifted(x):
        out = np.concatenate([x[:1], x[:-1]])
        out[starts] = x[last]
        return out

    ids = _numbered(v, words)
    before = shifted(ids)
    pair, at = before << 20 | ids, np.flatnonzero(ids == 0)
    others = [words[i] for i in at.tolist()]
    codes = ids.astype(np.uint64)
    codes[at] = np.fromiter(map(xxhash.xxh64_intdigest, others), np.uint64, len(others)) | np.uint64(1 << 63)
    named = np.flatnonzero((ids == 0) | (before == 0))
    pair[named] = _key(shifted(codes)[named], codes[named])
    return Keyed(starts, ids, before, pair, at, others, _key(0, codes[at]))


def pair_counts(texts: DataFrame, held, most: int = GROUP) -> DataFrame:
    """pair, n of all pairs of all whole texts, and of the words without a number.

    Tasks send their counts as lists, one for each of so many groups of pairs that a group sums
    about ``most`` counts.
    """

    def lists(keys, counts):
        # Here, in the tasks: read on the driver, the words would stay there.
        groups = held.value.total // most + 1
        group = (_mix(keys.astype(np.uint64)) % np.uint64(groups)).astype(np.min_scalar_type(groups))
        order = np.argsort(group, kind="stable")
        found, first = np.unique(group[order], return_index=True)
        ends = pa.array([*first.tolist(), len(order)], pa.int32())
        columns = [pa.ListArray.from_arrays(ends, pa.array(x[order], pa.int64())) for x in (keys, counts)]
        return batch_of(LISTS, found, *columns)

    def run(batches):
        _part.cache_clear()  # the worker may still hold parts of an earlier filter
        keys, counts, size = [], [], 0
        for part in slices(batches):
            keyed = _keyed(held.value, part.column("text").to_pylist())
            k, c = np.unique(np.concatenate([keyed.pair, keyed.own]), return_counts=True)
            keys.append(k)
            counts.append(c)
            size += len(k)
            if size > 2_000_000:
                k, c = merge_counts(keys, counts)
                if len(k) > 1_000_000:
                    yield lists(k, c)
                    k, c = k[:0], c[:0]
                keys, counts, size = [k], [c], len(k)
        if keys:
            yield lists(*merge_counts(keys, counts))

    def summed(group: pa.Table) -> pa.Table:
        keys, counts = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "counts"))
        return pa.Table.from_batches([batch_of(PAIRS, *merge_counts([keys], [counts]))])

    sent = texts.mapInArrow(run, "group long, keys array<long>, counts array<long>")
    return sent.groupBy("group").applyInArrow(summed, "pair long, n long")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _places(pair: np.ndarray, level: int):
    """Bits within the segment that (pair, level) sets, one array a hash; the segment depends on the pair alone."""
    a = _mix(pair.astype(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    b = _mix(a) | np.uint64(1)
    for k in range(HASHES):
        yield ((a + np.uint64(k) * b) >> np.uint64(20)) & np.uint64(SEGMENT_BITS - 1)


def build_filter(pairs: DataFrame, most: int = PARTS) -> tuple[list, DataFrame | None]:
    """The filter over the pairs (pair, n), as broadcast parts of SEGMENTS rows of bytes, and the pairs it doesn't hold (None: it holds all).

    There are as many parts as the entries need, ``most`` at most; beyond that the most frequent pairs
    are in the filter. Each segment is filled by one task from about a SEGMENTS-th of CAPACITY,
    and the driver holds one part at a time, which it reads in four steps.
    """
    spark = pairs.sparkSession
    level = F.floor(F.log2("n")).cast("long") + 1
    levels = pairs.groupBy("n").agg(F.count(F.lit(1)).alias("keys")).select("n", (F.col("keys") * level).alias("entries")).collect()
    least = least_count(levels, CAPACITY * most)
    entries = sum(r.entries for r in levels if r.n >= least)
    rest = pairs.where(F.col("n") < least) if entries < sum(r.entries for r in levels) else None
    count = -(-entries // CAPACITY)
    if not count:
        return [], rest

    def fill(batches):
        bits: dict[int, np.ndarray] = {}

        def put(rows):
            pair, n, segment = (np.concatenate(c) for c in zip(*rows))
            order = np.argsort(segment, kind="stable")
            found, first = np.unique(segment[order], return_index=True)
            for s, mine in zip(found.tolist(), np.split(order, first[1:])):
                flags = bits.setdefault(s, np.zeros(SEGMENT_BITS, bool))
                p, c = pair[mine], n[mine]
                for l in range(1, int(c.max()).bit_length() + 1):
                    some = p[c >= 1 << (l - 1)]
                    for place in _places(some, l):
                        flags[place] = True

        rows, size = [], 0
        for batch in batches:
            rows.append([batch.column(c).to_numpy() for c in ("pair", "n", "segment")])
            size += batch.num_rows
            if size > FILLED:
                put(rows)
                rows, size = [], 0
        if size:
            put(rows)
        yield batch_of(SEGMENT, list(bits), [np.packbits(f).tobytes() for f in bits.values()])

    segment = (F.col("pair") % SPREAD % (SEGMENTS * count)).cast("int")
    filled = pairs.where(F.col("n") >= least).select("pair", "n", segment.alias("segment")).repartition("segment").mapInArrow(fill, "segment int, bits binary")
    path = work_dir(spark, "llm-filter")
    filled.withColumn("part", F.floor(F.col("segment") / SEGMENTS).cast("int")).write.partitionBy("part").parquet(path)
    table = spark.read.schema("segment int, bits binary, part int").parquet(path)
    parts = []
    for i in range(count):
        rows = np.zeros((SEGMENTS, SEGMENT_BITS // 8), np.uint8)
        for r in table.where(F.col("part") == i).coalesce(4).toLocalIterator():
            rows[r.segment % SEGMENTS] = np.frombuffer(r.bits, np.uint8)
        parts.append(spark.sparkContext.broadcast(rows))
    return parts, rest


@functools.lru_cache(maxsize=4)
def _part(held) -> np.ndarray:
    """A part of the filter. ``Broadcast.value`` would keep every part that was ever read."""
    path = getattr(held, "_path", None)
    return held.load_from_path(path) if path else held.value


def probe(parts: list, pair: np.ndarray) -> np.ndarray:
    """Counts as the filter holds them: 2 ** (levels found in a row - 1), 0 if the first is missing. A repeated pair is looked up once."""
    if not parts:
        return np.zeros(len(pair), np.int64)
    pair, back = np.unique(pair, return_inverse=True)
    out = np.zeros(len(pair), np.int64)
    # In the order of the segments: each is small enough to stay in a processor's cache.
    segment = (pair % SPREAD % (SEGMENTS * len(parts))).astype(np.min_scalar_type(SEGMENTS * len(parts)))
    order = np.argsort(segment, kind="stable")
    ends = np.searchsorted(segment, SEGMENTS * np.arange(1, len(parts)), sorter=order)
    for held, at in zip(parts, np.split(order, ends)):
        if not len(at):
            continue
        bits, level = _part(held).reshape(-1), 1
        keys, first = pair[at], (segment[at] % SEGMENTS).astype(np.uint64) * np.uint64(SEGMENT_BITS)
        while len(at):
            # Most pairs that lack a level lack its first bit.
            places = _places(keys, level)
            there = np.flatnonzero(_set(bits, next(places) + first))
            at, keys, first = at[there], keys[there], first[there]
            there = np.ones(len(at), bool)
            for place in itertools.islice(_places(keys, level), 1, None):
                there &= _set(bits, place + first)
            at, keys, first = at[there], keys[there], first[there]
            out[at] = 1 << (level - 1)
            level += 1
    return out[back]


def _set(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    place = place.view(np.int64)
    return bits.take(place >> 3) << (place & 7).astype(np.uint8) & np.uint8(128) != 0


@functools.lru_cache(maxsize=1)
def _value(held):
    return held.value


@dataclass
class Model:
    vocabulary: object
    parts: list
    rest: DataFrame | None
    counts: DataFrame
    total: int
    distinct: int

    def release(self) -> None:
        """Frees the words and the filter, on the driver too, once all scores are made. They can't be used after that."""
        for held in (self.vocabulary, *self.parts):
            held.destroy()


def train(texts: DataFrame, parts: int = PARTS) -> Model:
    """Counts over all training texts (column text). The driver and the workers hold WORDS words, and parts of the filter one by one."""
    ship(texts.sparkSession)
    counts = stored(word_counts(texts), "word-counts")
    vocabulary = frequent_words(counts)
    held, total, distinct = texts.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.total, vocabulary.distinct
    del vocabulary
    pairs = stored(pair_counts(texts, held), "pair-counts")
    return Model(held, *build_filter(pairs, parts), counts, total, distinct)


def _probed(parts: list, held: list[Keyed]) -> list[np.ndarray]:
    """The counts of each one's pairs as the filter holds them, none above that of a context without a number."""
    ends = np.cumsum([len(x.pair) for x in held])
    counts = probe(parts, np.concatenate([x.pair for x in held]))
    # An end has a number, so the word after one without it is in the same text.
    after = np.concatenate([x.at + 1 + end - len(x.pair) for x, end in zip(held, ends.tolist())])
    found = counts[after] > 0
    after = after[found]
    counts[after] = np.minimum(counts[after], probe(parts, np.concatenate([x.own for x in held])[found]))
    return np.split(counts, ends[:-1])


def _scores(v: Vocabulary, x: Keyed, counts: np.ndarray, list_missed: bool) -> tuple:
    """For each text: tokens, known ones, base and model sums of log10 over numbered words, model's factor for others, those words by their pairs' counts, missed pairs."""
    seen, own = v.counts[x.before].astype(float), v.counts[x.ids]
    # A context's pair counts never sum to more than its own count; false positives are held to it.
    count = np.where(x.before > 0, np.minimum(counts, seen), counts)
    weight = SMOOTHING / (seen + SMOOTHING)
    unigram = (own + 1) / (v.total + v.distinct + 1)
    # A pair's count c raises the probability, from that without any, by the factor 1 + c * gain.
    gain = 1 / (SMOOTHING * unigram)
    numbered = x.ids > 0
    base = np.where(numbered, np.log10(unigram), 0.0)
    model = base + np.log10(np.where(numbered, weight * (1 + count * gain), weight))
    ends = np.append(x.starts[1:], len(x.ids))
    firsts = np.searchsorted(x.at, np.append(x.starts, len(x.ids))).tolist()
    held = counts[x.at].tolist()
    rare = [Counter(zip(x.words[a:b], held[a:b])) for a, b in zip(firsts, firsts[1:])]
    missed = [_missed(x, np.flatnonzero(count[a:b] == 0) + a, gain) if list_missed else [] for a, b in zip(x.starts.tolist(), ends.tolist())]
    known = np.add.reduceat((numbered & (own > 0)).astype(np.int64), x.starts)
    return ends - x.starts, known, np.add.reduceat(base, x.starts), np.add.reduceat(model, x.starts), rare, missed


def _missed(x: Keyed, mine: np.ndarray, gain: np.ndarray) -> list[dict]:
    """The pairs at the places ``mine``; those of a word without a number with the word in the place of its gain."""
    keys, first, k = np.unique(x.pair[mine], return_index=True, return_counts=True)
    at = mine[first]
    words = [None if i else x.words[j] for i, j in zip(x.ids[at].tolist(), np.searchsorted(x.at, at).tolist())]
    return [{"pair": a, "k": b, "gain": c, "word": w} for a, b, c, w in zip(keys.tolist(), k.tolist(), gain[at].tolist(), words)]


def _listed(rare: list[Counter]) -> pa.Array:
    """One list of (word, held, k) for each text."""
    ends = np.cumsum([0, *map(len, rare)])
    words, held = zip(*itertools.chain(*rare)) if ends[-1] else ((), ())
    flat = [words, held, list(itertools.chain(*(r.values() for r in rare)))]
    fields = list(_RARE.value_type)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, fields)], fields=fields), type=_RARE)


def score(docs: DataFrame, held_out, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``held_out`` is a boolean column over docs. Numbered words are scored in the map; the other
    words of each text (rare by choice of the numbered ones) join their exact counts by word, each with the
    counts of the pairs it ends, and come back as one sum a row: a word's count decides both its unigram and its
    weight as a context. So do pairs that the filter missed, where it doesn't hold all pairs. A null text is its end alone. Without training text every token has probability
    1 / (0 + 0 + 1). Repeated rows are scored each on its own; other columns are not read.
    """
    ship(docs.sparkSession)
    vocabulary, parts, list_missed = model.vocabulary, model.parts, model.rest is not None

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        v, chunk = _value(vocabulary), min(CHUNK * max(1, len(parts)), CHUNKS)
        keyed, doc_ids, held, size = [], [], [], 0

        def scored():
            found = zip(*[_scores(v, x, c, list_missed) for x, c in zip(keyed, _probed(parts, keyed))])
            n, known, base, lm = (np.concatenate(next(found)) for _ in range(4))
            rare, missed = (list(itertools.chain(*lists)) for lists in found)
            return batch_of(SCORED, range(row, row + len(doc_ids)), doc_ids, held, n, known, base, lm, _listed(rare), missed)

        for part in slices(batches):
            texts = part.column("text").to_pylist()
            keyed.append(_keyed(v, texts))
            doc_ids += part.column("doc_id").to_pylist()
            held += part.column("held_out").to_pylist()
            size += sum(len(t or "") for t in texts)
            if size > chunk:
                yield scored()
                row += len(doc_ids)
                keyed, doc_ids, held, size = [], [], [], 0
        if keyed:
            yield scored()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(run, SCORED_DDL), "lm-rows")
    room = float(model.total + model.distinct + 1)
    rare = rows.select("row", F.inline("rare")).join(model.counts, "word", "left")
    n = F.coalesce("n", F.lit(0))
    unigram = (n + 1) / F.lit(room)
    # As contexts and as words: T / (n + T), and 1 + c * gain of the count c of the pair that the word ends.
    paired = (SMOOTHING + F.least("held", n) / unigram) / (n + SMOOTHING)
    sums = rare.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(unigram)).alias("rare_log"), F.sum(F.col("k") * F.log10(paired)).alias("rare_pairs"),
        F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("rare_known"),
    )
    rest = F.coalesce("rare_log", F.lit(0.0))
    out, gained = rows.join(sums, "row", "left"), F.coalesce("rare_pairs", F.lit(0.0))
    if model.rest is not None:
        count = F.pow(F.lit(2.0), F.floor(F.log2("n")))
        missed = rows.select("row", F.inline("missed")).join(model.rest, "pair").select("row", "k", "gain", "word", count.alias("count"))
        others = missed.where("word is not null").join(model.counts, "word").select("row", "k", (F.lit(room) / (SMOOTHING * (F.col("n") + 1))).alias("gain"), F.lit(None).cast("string").alias("word"), "count")
        missed = missed.where("word is null").unionByName(others)
        out = out.join(missed.groupBy("row").agg(F.sum(F.col("k") * F.log10(1 + F.col("count") * F.col("gain"))).alias("gained")), "row", "left")
        gained += F.coalesce("gained", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + rest).alias("base_score"), (F.col("model") + rest + gained).alias("score"),
    )
