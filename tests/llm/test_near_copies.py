"""Near copies at shingle similarity 0.8, against all pairs compared."""

import random

import numpy as np
import pytest

import corpus_pipeline
from vacancia.llm import near_copies, simhash_dedup
from vacancia.llm.common import ascii_words


def slow_sets(text):
    words = ascii_words(text)
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """The smallest id of each group that pairs of 0.8 and more connect."""
    sets = [slow_sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) > 0:
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return set(ids.values())


def changed(words, n):
    """A copy with ``n`` words changed, each at a place of its own."""
    out = list(words)
    for at in random.sample(range(len(out)), n):
        out[at] = f"new{random.getrandbits(40)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    random.seed(11)
    base = [[f"w{random.randrange(3000)}" for _ in range(random.randrange(120, 400))] for _ in range(60)]
    out = [(i, " ".join(w)) for i, w in enumerate(base)]
    for k in range(240):  # similarities around 0.95, 0.9, 0.8 and below
        words = base[k % 60]
        out.append((1000 + k, changed(words, max(1, len(words) * (1 + k // 60) // 200))))
    centre = [f"c{random.randrange(500)}" for _ in range(150)]
    out += [(2000 + k, changed(centre, 1 + k % 5)) for k in range(60)]  # a dense group
    out += [(3000, None), (3001, " "), (3002, "one"), (3003, "One "), (3004, "one two"), (None, " ".join(base[0])), (None, "alone"), (5, out[5][1])]
    return out


@pytest.mark.parametrize("part", [256, 7])
def test_every_similar_pair_is_linked(spark, rows, monkeypatch, part):
    monkeypatch.setattr(near_copies, "PART", part)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, row string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = [r.doc_id for r in kept.collect()]
    want = slow_kept(rows)
    assert sorted(d for d in got if d is not None) == sorted(want) and got.count(None) == 2
    assert 60 < len(want) < len(rows) / 2
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").collect() == []


def test_large_groups_are_compared_by_bucket(spark, rows, monkeypatch):
    """Texts of which half share a licence, in parts of a few sets: the same documents stay, however they are dealt."""
    random.seed(12)
    licence = " ".join(f"licence{i}" for i in range(60))
    tied = [(9000 + i, f"{' '.join(f'own{i}x{k}' for k in range(40))} {licence}") for i in range(60)]
    frame = spark.createDataFrame(rows + tied, "doc_id long, text string")
    want = slow_kept(rows + tied)
    monkeypatch.setattr(near_copies, "PART", 3)
    for by_bucket in (0, 2, 10**6):
        monkeypatch.setattr(near_copies, "BY_BUCKET", by_bucket)
        assert {r.doc_id for r in near_copies.keep_one_of_each(frame).collect()} - {None} == want


def test_simhash_links_are_candidates(spark, rows, monkeypatch):
    """Without any band the SimHash operator's links are left: near copies go if they lie within its bits, and only if they are similar."""
    monkeypatch.setattr(near_copies, "band_keys", lambda shingles: np.zeros(0, np.int64))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} - {None}
    prints = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.near_groups(docs, width=5).collect()}
    texts = {d: slow_sets(t) for d, t in rows}
    similar = {d for d, (_, c) in prints.items() if d is not None and c < d and texts[c] and 5 * len(texts[c] & texts[d]) >= 4 * len(texts[c] | texts[d])}
    assert len({prints[d][0] for d in similar}) > 20 and not got & similar and slow_kept(rows) <= got
