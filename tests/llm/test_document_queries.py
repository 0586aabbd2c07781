"""The registered queries' own columns (folds, thresholds, checksums), and plain scorers of the trained models."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SF, library_ids, slow_groups, slow_leaks

from vacancia.llm import language_id, ngram_lm, queries
from vacancia.llm.common import ascii_words


def crc(text):
    return zlib.crc32(str(text).encode())


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def test_counts_packing_and_files(spark, given):
    ids = dict(zip([r.doc_id for r in given], library_ids([r.text for r in given])))
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, SF).collect()}
    assert {d: (r.n_bytes, r.n_tokens, r.over_limit) for d, r in got.items()} == {r.doc_id: (len(r.text.encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 512) for r in given}
    pieces = sorted(queries.op2_packing(spark, SF).collect(), key=lambda r: (r.doc_id, r.start))
    at, room = {}, {}
    for p in pieces:
        whole = np.array([*ids[p.doc_id], 1], "<u4")
        assert p.start == at.get(p.doc_id, 0) and p.doc_tokens == len(whole) and p.length > 0
        assert p.ids_crc32 == zlib.crc32(whole[p.start : p.start + p.length].tobytes())
        at[p.doc_id] = p.start + p.length
        room.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert at == {d: len(x) + 1 for d, x in ids.items()}
    for places in room.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1]] and sum(n for _, n in places) <= 2048
    start = 0
    files = {r.doc_id: r for r in queries.op8_token_files(spark, SF).collect()}
    for d in sorted(ids):
        whole = np.array([*ids[d], 0], "<u4")
        assert (files[d].start, files[d].n_tokens, files[d].ids_crc32) == (start, len(whole), zlib.crc32(whole.tobytes()))
        start += len(whole)


def test_duplicates_shards_and_leaks(spark, given):
    rows = [(r.doc_id, r.text) for r in given]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op4_simhash_dedup(spark, SF).collect())
    assert got == sorted(slow_groups(rows, 4))
    shards = queries.op7_sharding(spark, SF).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in shards) == sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in rows)
    assert {r.law for r in shards} == {"bytes"} and all(r.grown_shard is None for r in shards)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in queries.op9_decontamination(spark, SF).collect())
    assert leaked == sorted(slow_leaks(rows, items))


def test_labels_of_the_held_out_fold_teach_nothing(spark, given, tmp_path):
    got = {r.doc_id: r for r in queries.op3_quality_classifier(spark, SF).collect()}
    assert got.keys() == {r.doc_id for r in given}
    assert all(r.held_out == (crc(d) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int")).write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/documents.parquet").withColumns({"lang": F.lit("x"), "source": F.lit("y")}).write.parquet(f"{tmp_path}/documents.parquet")
    turned = {r.doc_id: r.score for r in queries.op3_quality_classifier(spark, str(tmp_path)).collect()}
    assert turned == {d: r.score for d, r in got.items()}


def test_languages(spark, given):
    got = {r.doc_id: r for r in queries.op6_language_id(spark, SF).collect()}
    assert got.keys() == {r.doc_id for r in given} and all(r.held_out == (crc(d) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())
    lang = {r.doc_id: r.lang for r in given}
    assert sum(r.lang_pred == lang[d] for d, r in got.items()) > 0.9 * len(got)


def test_language_scores_by_plain_counts(spark, given):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long_word = "Donaudampfschifffahrtsgesellschaft" * 3  # n-grams come from whole words
    taught = [(r.lang, r.text) for r in given if r.doc_id % 4 != 2] + [("de", long_word)]
    frame = docs.where("doc_id % 4 != 2").select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(999_999, long_word, "de")], "doc_id long, text string, lang string"))
    model = language_id.train(frame, keys_per_table=10**6)
    tables, totals = [{} for _ in range(5)], Counter()
    for name, text in taught:
        for word, n in Counter(language_id.words_of(text)).items():
            for kind, keys in [(0, [word])] + [(k, language_id.grams(word, k)) for k in range(1, 5)]:
                for key in keys:
                    tables[kind].setdefault(key, Counter())[name] += n
                    totals[name, kind] += n
    langs = sorted({name for name, _ in taught})

    def logs(kind, key):
        c = tables[kind][key]
        return np.array([math.log(c[x] / totals[x, kind]) if c[x] else math.log(0.5 / (totals[x, kind] + 1)) for x in langs])

    def plain(text):
        words = language_id.words_of(text)
        if not words:
            return "und", 0.0
        total = np.zeros(len(langs))
        for w in words:
            if w in tables[0]:
                total += logs(0, w)
                continue
            for k in range(4, 0, -1):
                known = [logs(k, g) for g in language_id.grams(w, k) if g in tables[k]]
                if known:
                    total += np.mean(known, axis=0)
                    break
        p = np.exp((mean := total / len(words) * min(len(words), 10)) - mean.max())
        return langs[int(p.argmax())], float(p.max() / p.sum())

    odd = [(5000, None), (5001, "123"), (5002, "zzqx qqxz"), (5003, "schifffahrtsgesellschaftdonau"), (5004, long_word[60:])]
    frame = docs.where("doc_id % 4 = 2").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    rows = {r.doc_id: r.text for r in frame.collect()}
    for r in language_id.identify(frame, model).collect():
        name, score = plain(rows[r.doc_id])
        assert r.score == pytest.approx(score, abs=2e-4) and (r.lang_pred == name or score < 0.5001)


def test_tied_words_keep_their_room(spark):
    """All counts equal: about as many keys stay as there is room for, not none."""
    words = ["".join(chr(97 + (i // 26**k) % 26) for k in range(4)) for i in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(words[i * 100 : i * 100 + 100]), "en") for i in range(30)], "doc_id long, text string, lang string")
    model = language_id.train(docs, keys_per_table=500)
    assert 350 < len(model.tables[0]) < 650 and all(len(t) for t in model.tables)


def test_language_model_by_plain_counts(spark, given):
    got = {r.doc_id: r for r in queries.op5_ngram_lm(spark, SF).collect()}
    taught = [r.text for r in given if crc(r.doc_id) % 7 != 2]
    word, pair = Counter(), Counter()
    for text in taught:
        words = [*ascii_words(text), b" "]
        word.update(words)
        pair.update(zip([words[-1], *words[:-1]], words))
    n, v = sum(word.values()), len(word)
    for r in given:
        words = [*ascii_words(r.text), b" "]
        base = model = 0.0
        for before, w in zip([words[-1], *words[:-1]], words):
            p = (word[w] + 1) / (n + v + 1)
            base += math.log10(p)
            c = pair[before, w]
            held = min(2 ** int(math.log2(c)), word[before]) if c else 0  # counts as the filter keeps them
            model += math.log10((held + ngram_lm.SMOOTHING * p) / (word[before] + ngram_lm.SMOOTHING))
        g = got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (crc(r.doc_id) % 7 == 2, len(words), sum(word[w] > 0 for w in words), n)
        assert g.base_score == pytest.approx(base, rel=1e-9) and g.score == pytest.approx(model, rel=1e-3)


@pytest.mark.parametrize("room, parts", [(20, 128), (0, 128), (20, 0), (20, 1)])
def test_pairs_of_words_without_numbers_count(spark, monkeypatch, room, parts):
    """Few numbered words, long words and equal counts: every text is scored by the counts of all its pairs."""
    long = ["langes" * 20 + str(i) for i in range(3)]
    taught = [f"a{i} b{i} c{i} a{i} b{i} {long[i % 3]} the of {long[i % 3]} the x{i % 7} the" for i in range(120)] + [" ".join(f"p{i} q{i}" for i in range(100))] * 5
    asked = [*taught[::10], "unseen a1 unseen b1 c1 nowhere", f"{long[0]} the {long[1]}", "q3 p3", None, ""]
    monkeypatch.setattr(ngram_lm, "least_count", lambda levels, most, true=ngram_lm.least_count: true(levels, room if most == ngram_lm.WORDS else most))
    if parts == 1:  # the most frequent pairs in the filter, the others by the join
        monkeypatch.setattr(ngram_lm, "CAPACITY", 400)
    model = ngram_lm.train(spark.createDataFrame([(t,) for t in taught], "text string"), parts)
    assert len(model.vocabulary.value.numbers) <= room + 1 and (model.rest is None) == (parts == 128)
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_lm.score(docs, F.lit(True), model).collect()}
    word, pair = Counter(), Counter()
    for text in taught:
        words = [*ascii_words(text), b" "]
        word.update(words)
        pair.update(zip([words[-1], *words[:-1]], words))
    room, smooth = sum(word.values()) + len(word) + 1, ngram_lm.SMOOTHING
    for d, text in enumerate(asked):
        words = [*ascii_words(text), b" "]
        base = model = 0.0
        for before, w in zip([words[-1], *words[:-1]], words):
            p = (word[w] + 1) / room
            held = 2 ** int(math.log2(pair[before, w])) if pair[before, w] else 0
            base, model = base + math.log10(p), model + math.log10((held + smooth * p) / (word[before] + smooth))
        assert (got[d].n_tokens, got[d].n_known) == (len(words), sum(word[w] > 0 for w in words))
        assert got[d].base_score == pytest.approx(base, rel=1e-9) and got[d].score == pytest.approx(model, rel=1e-6)
