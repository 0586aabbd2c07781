"""Line dedup against a plain version, and the perfect hash on its own."""

from hashlib import sha256

import numpy as np
from test_llm_operators import SF, docs, empty, key, rows, same  # noqa: F401

import check
from vacancia.llm import line_dedup, queries

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_key(line):
    k = line.strip(BLANKS).translate(UPPER)
    return k if len(k) >= 20 else None


def slow_drops(rows, least_docs=3):  # noqa: F811
    """doc_id, kept text, lines, dropped lines, most holders."""
    low = -(2**63)
    holders, last = {}, {}
    texts = [(low if d is None else d, (t or "").split("\n")) for d, t in rows]
    for d, lines in texts:
        for k in {line_key(x) for x in lines} - {None}:
            holders[k] = holders.get(k, 0) + 1
            last[k] = max(last.get(k, low), d)
    out = []
    for d, lines in texts:
        gone = [k is not None and holders[k] >= least_docs and last[k] != d for k in map(line_key, lines)]
        most = max((holders[line_key(x)] for x, g in zip(lines, gone) if g), default=0)
        out.append((None if d == low else d, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone), most))
    return out


LICENCE = "Licensed under the Some Licence, Version 2.0"
LINES = [
    (20_000, f"{LICENCE}\nown line of the first text here"), (20_001, f"  {LICENCE.upper()}\t\nother"), (20_002, f"{LICENCE}\n{LICENCE}\n"), (20_003, LICENCE),
    (20_004, "ÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉÉ\nx"), (20_005, "éééééééééééééééééééé\nx"), (20_006, "exactly twenty chars\nnineteen characters"), (20_007, "Exactly twenty chars\nnineteen characters"),
    (20_008, "exactly twenty chars\r\nnineteen characters"), (20_009, "日" * 19), (20_010, "日" * 20), (20_011, "日" * 20), (20_012, "日" * 20), (20_003, LICENCE), (None, LICENCE),
    (20_013, " " + LICENCE), (None, "only rows without an id hold this line"), (None, "only rows without an id hold this line"), (None, "only rows without an id hold this line"),
    (20_014, "\n".join(["a line that one document holds many times"] * 500)), (20_015, "a line that one document holds many times\x0b"), (20_016, "a line that one document holds many times\nkept"),
]


def test_lines(spark, docs, rows, empty):  # noqa: F811
    more = spark.createDataFrame([(d, t, "en", "s", 1, 2, 3, "k", 4, 5) for d, t in LINES], docs.schema)
    whole, want = docs.unionByName(more), slow_drops(rows + LINES)
    assert sum(w[3] for w in want) > 20
    for arguments in ({}, {"shard_keys": 3, "pass_shards": 2}, {"shard_keys": 2, "pass_shards": 100}):
        got = line_dedup.drop_repeated_lines(whole, **arguments).collect()
        same([tuple(r)[:5] for r in got], want)
        assert all(len(r.dropped) == r.n_dropped for r in got)
    same([tuple(r)[:5] for r in line_dedup.drop_repeated_lines(whole, min_docs=2).collect()], slow_drops(rows + LINES, 2))
    assert line_dedup.drop_repeated_lines(empty).collect() == []


def test_query_on_given_table(spark):
    base = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(d, n, gone, sha256(t.encode()).hexdigest(), most) for d, t, n, gone, most in slow_drops(base)]
    same(queries.op13_line_dedup(spark, SF).collect(), want)


def test_perfect_hash():
    random = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 1000, 70_000):
        keys = np.unique(random.integers(-(2**63), 2**63, (n, 2)), axis=0)
        if n > 2:
            keys[1, 0] = keys[0, 0]  # one hash, two fingerprints
        counts, last = random.integers(1, 2**33, len(keys)), random.integers(0, 99, len(keys))
        index = line_dedup.PerfectHash.of(keys)
        assert sorted(index.numbers(keys).tolist()) == list(range(len(keys)))
        assert sum(8 * len(x) for x in index.levels) < 4 * n + 1500
        shard = line_dedup.Shard.unpack(line_dedup.Shard.of(keys, counts, last).pack())
        holders, ids = shard.probe(keys)
        assert (holders == np.minimum(counts, 2**32 - 1)).all() and (ids == last).all()
        foreign = random.integers(-(2**63), 2**63, (5000, 2))
        assert not shard.probe(foreign)[0].any()


def test_sql_gives_the_same(spark):
    df = queries.op13_line_dedup(spark, SF)
    cur = check.duck(SF).execute(queries.ORACLES["op13_line_dedup"])
    assert check.table([tuple(r) for r in df.collect()], df.columns) == check.table(cur.fetchall(), [c[0] for c in cur.description])
