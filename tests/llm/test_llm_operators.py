"""Each document operator against a plain version over a small table with every odd case."""

import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vacancia.llm import bpe, components, decontamination, language_id, ngram_lm, packing, quality_classifier, quality_rules, range_coder, sharding
from vacancia.llm import queries, simhash_dedup, token_counts, token_files
from vacancia.llm.common import ascii_words, merge_counts
from vacancia.session import work_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, u long, fp long, key string, n long, shard int"
ODD = [
    None, "", " ", "\n\n", "a", "A  b\t c \n", "word " * 3000, "x" * 5000, "<|endoftext|> in a text", "Ünïcödé — ça 日本語 !", "tab\there", " lead", "trail ",
    "same line\nsame line\nsame line", "one two three four five one two three four five six", "$$$ %%% ### words & more", " nbsp em", "a\x1cb  c",
    "# Heading\n* item | cell <b>", "one two three four five one two three four five six",
]


@pytest.fixture(scope="module")
def docs(spark):
    """The given documents plus odd texts, a null id, a repeated row and columns named like inner ones."""
    random.seed(5)
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    near = base[3][1].split(" ")
    copies = []
    for k in range(25):
        words = list(near)
        words[random.randrange(len(words))] = f"changed{k}"
        copies.append(" ".join(words))
    rows = base + [(10_000 + i, t) for i, t in enumerate(ODD + copies)] + [(10_001, ""), base[0], (None, base[1][1]), (None, None)]
    return spark.createDataFrame([(d, t, "en", "s", 1, 2, 3, "k", 4, 5) for d, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_token_counts(spark, docs, rows, empty):
    ids = library_ids([t for _, t in rows])
    want = [(d, len((t or "").encode()), len(i), len(i) > 512) for (d, t), i in zip(rows, ids)]
    same(token_counts.count_tokens(docs, bpe.default_path()).collect(), want)
    same(token_counts.count_tokens(docs, bpe.default_path(), entries=50, sample_docs=20).collect(), want)
    assert token_counts.count_tokens(empty, bpe.default_path()).collect() == []


def test_token_counts_of_other_tokenizers(docs, rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    texts = [t or "" for _, t in rows]
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(e.ids) for e in words.encode_batch(texts, add_special_tokens=False))
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(pieces.encode(t)) for t in texts)


def test_groups_on_random_texts():
    random.seed(1)
    parts = ["a", " ", "  ", "\n", "\t", ".", ",", "é", "1", "'s", "\x1c", " ", "<|endoftext|>", "Foo", "!!", "\r\n", "日"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(4000)]
    assert [list(x) for x in bpe.encode(bpe.default_path(), texts)] == library_ids(texts)


def test_packing(docs, rows, empty):
    got = packing.pack(docs, bpe.default_path(), size=256).collect()
    whole = {}
    for r in got:
        whole.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    joined = Counter()
    for (doc_id, total), pieces in whole.items():
        copies, rest = sum(p.start == 0 for p in pieces), sorted(pieces, key=lambda p: p.start)
        if copies == 1:
            assert [p.start for p in rest] == [0, *np.cumsum([p.length for p in rest])[:-1]]
            joined[doc_id, b"".join(p.ids for p in rest)] += 1
        assert sum(p.length for p in pieces) == copies * total
    want = Counter((d, np.array([*i, 1], "<u4").tobytes()) for (d, _), i in zip(rows, library_ids([t for _, t in rows])))
    assert all(want[k] for k in joined) and len(joined) > len(want) - 8
    sequences = {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == [0, *np.cumsum([p.length for p in pieces])[:-1]]
        used = sum(p.length for p in pieces)
        assert used <= 256 and {p.padded_to for p in pieces} == {used if used & (used - 1) == 0 else 256}
        padding += pieces[0].padded_to - used
    assert padding < 0.06 * sum(r.length for r in got)
    assert packing.pack(empty, bpe.default_path()).collect() == []


def test_plan_is_optimal():
    random.seed(2)
    for _ in range(200):
        positions = sorted(random.sample(range(1, 60), random.randint(8, 20)))
        positions = [0, *positions]
        size = max(12, max(b - a for a, b in zip(positions, positions[1:])))
        penalties = [random.choice([0, 2, 12]) for _ in positions]
        best = [0] + [None] * (len(positions) - 1)
        for j in range(1, len(positions)):
            best[j] = min(best[i] + size - (positions[j] - positions[i]) + penalties[j] for i in range(j) if positions[j] - positions[i] <= size)
        cuts = packing.plan(positions, penalties, size)
        at = {p: i for i, p in enumerate(positions)}
        assert sum(size - (b - a) + penalties[at[b]] for a, b in zip(cuts, cuts[1:])) == best[-1]
        assert all(b - a <= size for a, b in zip(cuts, cuts[1:]))


def slow_print(text, width):
    words = ascii_words(text)
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(rows, width):
    prints = [slow_print(t, width) for _, t in rows]
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for (d, _), p in zip(rows, prints):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [(d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(rows, prints)]


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(docs, rows, empty, width):
    want = slow_groups(rows, width)
    same(simhash_dedup.near_groups(docs, width).collect(), want)
    assert simhash_dedup.near_groups(empty).collect() == []


def test_near_links_of_random_and_dense_prints(spark):
    random.seed(3)
    prints = {random.getrandbits(64) for _ in range(300)}
    for seed in list(prints)[:20]:  # chains, and a dense group
        at = seed
        for _ in range(10):
            for b in random.sample(range(64), random.randint(1, 4)):
                at ^= 1 << b
            prints.add(at)
    centre = random.getrandbits(64)
    prints |= {centre ^ 1 << a ^ 1 << b for a in range(12) for b in range(a)}
    rows = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    frame = spark.createDataFrame(rows, "fp long")
    want = {}
    for part in (20_000, 10):  # whole buckets, and buckets in parts
        ties = {r.u: r.v for r in components.connected(simhash_dedup.near_links(frame, part)).collect()}
        got = {}
        for (x,) in rows:
            got.setdefault(ties.get(x, x), set()).add(x)
        if not want:
            pool = [x for (x,) in rows]
            parent = {x: x for x in pool}

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for i, a in enumerate(pool):
                for b in pool[:i]:
                    if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                        parent[max(find(a), find(b))] = min(find(a), find(b))
            for x in pool:
                want.setdefault(find(x), set()).add(x)
        assert got == want


def test_components_of_a_long_chain(spark):
    chain = list(range(200))
    random.seed(4)
    random.shuffle(chain)
    got = components.connected(spark.createDataFrame(list(zip(chain, chain[1:])) + [(900, 901), (5, 5)], "u long, v long")).collect()
    assert {r.u: r.v for r in got} == {x: 0 for x in range(1, 200)} | {901: 900}
    assert components.connected(spark.createDataFrame([], "u long, v long")).collect() == []


def test_language_model_scores(spark, docs, rows, empty):
    train = docs.where("doc_id % 3 != 0")
    model = ngram_lm.train(train.select("text"))
    counts = Counter(w for d, t in rows if d is not None and d % 3 for w in [*ascii_words(t), "end"])
    n, v = sum(counts.values()), len(counts)
    got = ngram_lm.score(docs, F.coalesce(F.col("doc_id") % 3 == 0, F.lit(False)), model).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    want = {}
    for d, t in rows:
        tokens = [*ascii_words(t), "end"]
        want.setdefault(d, []).append((len(tokens), sum(counts[w] > 0 for w in tokens), sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)))
    for d in want:
        a = sorted((r.n_tokens, r.n_known, r.base_score) for r in got if r.doc_id == d)
        assert all(x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-6 * max(1, abs(y[2])) for x, y in zip(a, sorted(want[d]), strict=True))
    assert all(r.score <= 0 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    nothing = ngram_lm.train(empty.select("text"))
    assert {(r.train_tokens, r.base_score, r.score) for r in ngram_lm.score(docs, F.lit(True), nothing).collect()} == {(0, 0.0, 0.0)}
    assert ngram_lm.score(empty, F.lit(True), model).collect() == []


def test_language_model_with_few_numbered_words(docs, rows, monkeypatch):
    counts = ngram_lm.word_counts(docs.select("text"))
    few = ngram_lm.frequent_words(counts, room=20)
    assert len(few.numbers) <= 21 and ngram_lm.END.encode() in few.numbers


def test_pairs_are_counted_by_groups(spark, docs, rows, monkeypatch):
    counts = ngram_lm.word_counts(docs.select("text"))
    vocabulary = ngram_lm.frequent_words(counts)
    held = spark.sparkContext.broadcast(vocabulary)
    want = Counter()
    for _, t in rows:
        ids = [vocabulary.numbers.get(w.encode() if isinstance(w, str) else w, 0) for w in [*ascii_words(t), ngram_lm.END]]
        want.update(a << 20 | b for a, b in zip([ids[-1], *ids], ids) if a and b)
    for most in (1 << 40, vocabulary.total // 7):
        pairs = ngram_lm.pair_counts(docs.select("text"), held, most)
        got = [(r.pair, r.n) for r in pairs.collect()]
        assert len(got) == len(dict(got)) and {p: n for p, n in got if p < 1 << 62} == want
    # Pairs put into the filter a few at a time, and looked up once however often they are asked.
    monkeypatch.setattr(ngram_lm, "FILLED", 10)
    parts, rest = ngram_lm.build_filter(pairs)
    keys = np.array([*want, *want, *reversed(want)])
    found, places = ngram_lm.probe(parts, keys), []
    assert rest is None and (found >= [1 << want[k].bit_length() - 1 for k in keys.tolist()]).all() and (found <= [want[k] for k in keys.tolist()]).mean() > 0.99
    true = ngram_lm._places
    monkeypatch.setattr(ngram_lm, "_places", lambda pair, level: places.append((len(pair), level)) or true(pair, level))
    assert (ngram_lm.probe(parts, keys) == found).all()
    assert max(n for n, level in places if level == 1) <= len(want)


def test_probes_never_fall_short(spark, monkeypatch):
    pairs = spark.createDataFrame([(i << 20 | i + 1, 1 + i % 70) for i in range(5000)], "pair long, n long")
    numbers = np.array([i << 20 | i + 1 for i in range(5000)])
    true = 1 + np.arange(5000) % 70
    for capacity, n_parts in ((ngram_lm.CAPACITY, 1), (9000, 3)):
        monkeypatch.setattr(ngram_lm, "CAPACITY", capacity)
        parts, rest = ngram_lm.build_filter(pairs)
        assert len(parts) == n_parts and rest is None
        got = ngram_lm.probe(parts, numbers)
        assert (got >= 2 ** np.floor(np.log2(true))).all() and (got <= true).mean() > 0.99
        assert (ngram_lm.probe(parts, numbers + (1 << 41)) > 0).mean() < 0.01
    parts, rest = ngram_lm.build_filter(pairs, 1)
    least = 1 + max(r.n for r in rest.collect())
    assert 1 < least <= 70 and rest.count() == (true < least).sum()
    got = ngram_lm.probe(parts, numbers)
    assert (got[true >= least] > 0).all() and (got[true < least] > 0).mean() < 0.01


def test_scores_do_not_depend_on_the_parts_of_the_filter(docs, monkeypatch):
    def scores(**kw):
        model = ngram_lm.train(docs.select("text"), **kw)
        return len(model.parts), model.rest is None, sorted((r.doc_id is None, r.doc_id, round(r.score, 6)) for r in ngram_lm.score(docs, F.lit(False), model).collect())

    one, all_held, want = scores()
    assert (one, all_held) == (1, True)
    assert scores(parts=0) == (0, False, want)  # every pair by the join
    monkeypatch.setattr(ngram_lm, "CAPACITY", 3000)
    monkeypatch.setattr(ngram_lm, "CHUNK", 500)
    several, all_held, got = scores()
    assert several > 1 and all_held and got == want
    few, all_held, got = scores(parts=1)
    assert few == 1 and not all_held and got == want


def slow_measures(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered), sum(c.isupper() for c in text), sum(c in ".!?" for c in text)


def test_quality_ledger(docs, rows, empty):
    ledger = quality_rules.ledger(docs)
    want = [(d, *slow_measures(t)) for d, t in rows]
    same(ledger.drop("failed_bits").collect(), want)
    full = quality_rules.apply_policy(ledger, "v2").collect()
    for r in full:
        base = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert (r.failed_bits & 3 > 0) == base and not (base and r.kept)
        assert r.kept == (r.failed_bits & quality_rules.policy_mask("v2") == 0)
    for r in quality_rules.ablations(ledger).collect():
        bit = next(x.bit for x in quality_rules.RULES if x.name == r.rule)
        mask = quality_rules.policy_mask(r.policy)
        assert r.n_docs == len(rows) and r.failing == sum(x.failed_bits >> bit & 1 for x in full)
        assert r.alone == sum(x.failed_bits & mask == 1 << bit for x in full) and r.rejected == sum(x.failed_bits & mask > 0 for x in full)
    assert quality_rules.ledger(empty).collect() == [] and {r.n_docs for r in quality_rules.ablations(quality_rules.ledger(empty)).collect()} == {0}


def test_repeats_with_many_words():
    words = [f"w{i}".encode() for i in range(40_000)]
    assert quality_rules.repeated_words(words) == 0
    assert quality_rules.repeated_words(words + words[100:107]) == 14


def test_shards(docs, rows, empty):
    got = sharding.shard_documents(docs).collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (d is not None, d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    ) if all(r.doc_id is not None for r in got) else len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(r.group_key, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r["shard"] < 8
    assert all(len({r["shard"] for r in g}) == 1 for g in groups.values())
    assert len({(r.size, r.text_crc32) for r in got}) <= len(groups)
    for s in range(8):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    sizes = [sum(r["size"] for r in groups[k]) for k in sorted(groups)]

    def fits(capacity):
        shards, room = 1, capacity
        for x in sizes:
            if x > room:
                shards, room = shards + 1, capacity
            room -= x
        return shards <= 8

    least = max(sizes)
    while not fits(least):
        least += 1
    assert max(sum(r["size"] for r in got if r["shard"] == s) for s in range(8)) == least
    assert sharding.shard_documents(empty).collect() == []


def test_cut_points_of_close_keys(spark):
    random.seed(6)
    for trial in range(4):
        keys = sorted({random.getrandbits(64) - (1 << 63) for _ in range(50)} | {(7 << 40) + random.getrandbits(20) for _ in range(120)})
        sizes = [random.choice([1, 5, 100, 2000]) for _ in keys]
        cuts = sharding.cut_points(spark.createDataFrame(list(zip(keys, sizes)), "group_key long, size long"), 8)
        loads = Counter()
        for k, s in zip(keys, sizes):
            loads[sum(k > c for c in cuts)] += s
        low = max(sizes)

        def needs(capacity):
            n, room = 1, capacity
            for x in sizes:
                if x > room:
                    n, room = n + 1, capacity
                room -= x
            return n

        while needs(low) > 8:
            low += 1
        assert max(loads.values()) == low


def test_range_coder():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2047, 2048, 2049, 6000):
        for ids in (rng.integers(0, 50257, n), rng.integers(0, 3, n), np.zeros(n, int)):
            coded = range_coder.encode(ids)
            assert (range_coder.decode(coded) == ids).all()
    assert sum(map(len, coded.payloads)) < 6000 // 10
    coded.payloads[1] = bytes(len(coded.payloads[1]))
    ids = rng.integers(0, 50, 6000)
    coded = range_coder.encode(ids)
    coded.payloads[1] = coded.payloads[0]
    with pytest.raises(ValueError):
        range_coder.decode(coded)


def test_token_files(spark, docs, rows, empty):
    target = work_dir(spark, "ids")
    token_files.write_ids(docs, target, bpe.default_path())
    got = token_files.read_ids(spark, target).collect()
    ids = library_ids([t for _, t in rows])
    stream = sorted(zip([d for d, _ in rows], [t for _, t in rows], ids), key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1]))
    want, at = [], 0
    for d, _, i in stream:
        want.append((d, at, len(i) + 1, np.array([*i, 0], "<u4").tobytes()))
        at += len(i) + 1
    same([(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got], want)
    target = work_dir(spark, "ids")
    token_files.write_ids(empty, target, bpe.default_path())
    assert token_files.read_ids(spark, target).collect() == []


def slow_leaks(rows, items):
    out = []
    for d, t in rows:
        words = ascii_words(t)
        for item, text in items:
            want = ascii_words(text)
            if want and words:
                ngrams = decontamination.shingles(want)
                starts = range(max(1, len(words) - len(want) + 1))
                best = max(decontamination.similarity(decontamination.shingles(words[s : s + len(want)]), ngrams) for s in starts)
                if best >= 0.8:
                    out.append((d, item, round(best, 9)))
    return out


def test_leaks(spark, docs, rows, empty):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][:12] + [(900, None), (901, " "), (902, "three words only"), (903, "Item")]
    random.seed(7)
    passage = items[0][1].split()
    planted = []
    for k in range(40):
        words = list(passage)
        for _ in range(k % 4):
            words[random.choice([0, 1, -1])] = "other"
        if k % 5 == 4:
            words.insert(random.randrange(len(words)), "extra")
        planted.append((5000 + k, " ".join([*"some words before it".split(), *words, "after"])))
    planted += [(5100, "with THREE  words\nonly inside"), (5101, "item"), (5102, "items three words"), (5103, " ".join(passage[:-1]))]
    some = [r for r in rows if r[0] is None or r[0] < 60 or r[0] >= 10_000]
    frame = spark.createDataFrame([(d, t, "x") for d, t in some + planted], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = slow_leaks(some + planted, items)
    got = decontamination.leaks(frame, bench).collect()
    same([(r.doc_id, r.item_id, round(r.similarity, 9)) for r in got], want)
    assert len(want) > 20
    kept = decontamination.keep_unleaked(frame, bench)
    assert kept.columns == frame.columns and kept.count() == len(some + planted) - sum(1 for d, t in some + planted if slow_leaks([(d, t)], items))
    assert decontamination.leaks(empty, bench).collect() == [] and decontamination.leaks(frame, bench.limit(0)).collect() == []


def test_leaks_in_several_passes(spark, docs):
    """One item many times over is one text in its block, and all its ids are named."""
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text")
    one = decontamination.leaks(docs, bench).collect()
    often = bench.where(f"item_id = {one[0].item_id}").crossJoin(spark.range(1000, 1030).withColumnRenamed("id", "other")).selectExpr("other as item_id", "text")
    many = bench.unionByName(often).unionByName(bench.limit(1).selectExpr("cast(null as long) as item_id", "cast(null as string) as text"))
    found = decontamination.leaks(docs, many, block_items=7).collect()
    same([r for r in found if r.item_id < 1000], [tuple(r) for r in one])
    assert sum(r.item_id >= 1000 for r in found) == 30 * sum(r.item_id == one[0].item_id for r in one)
    kept = decontamination.keep_unleaked(docs, many, block_items=7)
    assert kept.columns == docs.columns and kept.count() == decontamination.keep_unleaked(docs, bench).count()


def test_language_id(spark, docs, rows, empty):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(given.where("doc_id % 4 != 2"))
    got = language_id.identify(given.where("doc_id % 4 = 2"), model).join(given, "doc_id").select("lang", "lang_pred", "score").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert language_id.identify(docs, model).count() == len(rows)
    assert [odd[10_000 + i].lang_pred == "und" for i in range(4)] == [True] * 4 and odd[10_004].lang_pred != "und"
    kept = language_id.keep_identified(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)
    assert language_id.identify(empty, model).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs, language_id.train(empty)).collect()} == {"und"}
    assert {r.lang_pred for r in language_id.identify(docs, language_id.train(docs.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


def test_unseen_words_back_off():
    model = language_id.Model(["a", "b"], [{"known": 0}, {}, {"^k": 1, "un": 1}, {"nkn": 2}, {}], np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.8, 0.2]], np.float32)))
    score = language_id.Scorer(model, room=0)
    assert score.score("known")[0] == "a" and score.score("unknown")[0] == "a" and score.score("kun un")[0] == "b" and score.score("1234") == ("und", 0.0)
    assert score.score("zzz") == ("a", 0.5)


def test_quality_classifier(spark, docs, rows, empty):
    given, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_classifier.train(given, labels.where("doc_id % 5 != 0"))
    got = quality_classifier.score_quality(given, model).join(labels.where("doc_id % 5 = 0"), "doc_id").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in got) > 0.9 * len(got) and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.score_quality(docs, model).count() == len(rows)
    kept = quality_classifier.keep_good(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)
    assert quality_classifier.score_quality(empty, model).collect() == []
    none = spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.score_quality(docs, quality_classifier.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r.score > 0.9 for r in quality_classifier.score_quality(docs, quality_classifier.train(docs, one)).collect())
    few = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (2, 0)], "doc_id long, quality int")
    assert quality_classifier.score_quality(docs, quality_classifier.train(docs, few)).count() == len(rows)


def test_language_model_leaves_nothing_on_the_driver(spark, docs, tmp_path, monkeypatch):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    trained, train = [], ngram_lm.train
    monkeypatch.setattr(ngram_lm, "train", lambda texts: trained.append(train(texts)) or trained[0])
    scored = queries.op5_ngram_lm(spark, str(tmp_path))
    (model,) = trained
    # The words were not read back on the driver, and neither they nor the filter are kept for the rows that come.
    assert model.parts and all("_value" not in vars(held) for held in (model.vocabulary, *model.parts))
    assert not any(os.path.exists(held._path) for held in (model.vocabulary, *model.parts))
    assert scored.count() == docs.count()


def test_merged_counts():
    rng = np.random.default_rng(5)
    keys, counts = [rng.integers(-50, 50, n) for n in (0, 300, 1, 700)], [rng.integers(1, 9, n) for n in (0, 300, 1, 700)]
    want = Counter()
    for k, c in zip(np.concatenate(keys).tolist(), np.concatenate(counts).tolist()):
        want[k] += c
    got, sums = merge_counts(keys, counts)
    assert (got.tolist(), sums.tolist()) == (sorted(want), [want[k] for k in sorted(want)])
    assert [x.tolist() for x in merge_counts([keys[0]], [counts[0]])] == [[], []] and sums.dtype == np.int64
    # Sums past the integers that a double holds.
    assert merge_counts([np.array([7, 7])], [np.array([1 << 53, 1])])[1].tolist() == [(1 << 53) + 1]


def test_range_coder_words(monkeypatch):
    """The bytes do not depend on how many steps are modelled ahead; payloads that are cut or swapped fail by their checksum."""
    rng = np.random.default_rng(3)
    for n in (1, 2047, 2049, 3 * 2048, 9001):
        ids = np.where(rng.random(n) < 0.5, rng.zipf(1.3, n) % 50_000, np.arange(n) % 7).astype("<u4")
        coded = range_coder.encode(ids)
        with monkeypatch.context() as patch:
            patch.setattr(range_coder, "AHEAD", 1)
            assert range_coder.encode(ids) == coded
        assert (range_coder.decode(coded) == ids).all()
    for payloads in ([p[: len(p) // 4 * 2] for p in coded.payloads], [b"" for _ in coded.payloads], coded.payloads[::-1], [bytes([255]) * len(p) for p in coded.payloads]):
        with pytest.raises(ValueError):
            range_coder.decode(range_coder.Coded(coded.n_ids, coded.table, payloads, coded.checksums))


def test_range_coder_mixes():
    """One distribution of all three orders: free ids cost little over their entropy, and ids that follow others next to nothing."""
    rng = np.random.default_rng(5)
    ids = (rng.zipf(1.2, 200_000) % 50_000).astype("<u4")
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    coded = range_coder.encode(ids)
    assert (range_coder.decode(coded) == ids).all()
    assert 8 * sum(map(len, coded.payloads)) < 1.02 * -(share * np.log2(share)).sum() * len(ids)
    ids = np.tile(rng.integers(0, 50_000, 300), 400).astype("<u4")
    coded = range_coder.encode(ids)
    assert (range_coder.decode(coded) == ids).all()
    assert 8 * sum(map(len, coded.payloads)) < 0.5 * len(ids)


def test_range_coder_carries():
    """The words are those of whole numbers without a bound, however far a carry goes."""
    top = 1 << range_coder.TOTAL_BITS
    rng = np.random.default_rng(6)
    for last in (0, 1, top - 1):
        steps = [(int(s), int(rng.integers(1, top - s + 1))) for s in rng.integers(0, top, 300)] + [(top - 1, 1)] * 40 + [(0, top)] * 2 + [(last, 1), (top - 2, 2)] * 3
        coder, low, size, words = range_coder.Encoder(2, len(steps)), 0, 1 << 48, 3
        for start, n in steps:
            coder.put(np.array([start, 0]), np.array([n, top]))
            step = size // top
            low, size = low + start * step, n * step
            while size < 1 << 32:
                low, size, words = low << 16, size << 16, words + 1
        want = low + 0xFFFF >> 16
        assert coder.finish()[0] == np.array([want >> 16 * k & 0xFFFF for k in reversed(range(words - 1))], "<u2").tobytes()


def test_blank_runs():
    """Ids of whole texts with runs of blanks, control characters and special strings are the library's."""
    parts = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u200b\u2028\u202f\u205f\u3000aZ9\xe9\u4e2d!'\U0001f642", "'s", "'ll", "  ", "\n\n", "\r\n", " a", "<|endoftext|>"]
    rng = np.random.default_rng(7)
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts), n)) for n in rng.integers(1, 15, 20_000)]
    lib = bpe.Library(bpe.default_path())
    assert lib.ordinary is not None
    assert [x.tolist() for x in bpe.encode(bpe.default_path(), texts)] == lib.encode_all(texts)
    lib.tokenizer.encode_special_tokens = True
    assert [lib.plain_ids(t).tolist() for t in texts] == lib.encode_all(texts)


def test_token_files_time():
    """CPU time of ids and their coding, by that of a loop whose usual time is a millisecond."""

    def took(f, *args):
        times = []
        for _ in range(5):
            start = time.process_time()
            f(*args)
            times.append(time.process_time() - start)
        return min(times)

    loop = took(sum, range(50_000)) * 1000
    ids = (np.random.default_rng(8).zipf(1.3, 1 << 20) % 50_000).astype("<u4")
    coded = range_coder.encode(ids)
    assert took(range_coder.encode, ids) + took(range_coder.decode, coded) < 0.45e-6 * loop * len(ids)
