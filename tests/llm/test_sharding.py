"""Cuts with large groups, many small ones and many equal rows, against filling all groups in order."""

import random

from pyspark.sql import functions as F

from vacancia.llm import sharding


def slow_least(sizes, shards=8):
    def needs(capacity):
        n, room = 1, capacity
        for x in sizes:
            if x > room:
                n, room = n + 1, capacity
            room -= x
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needs(middle) <= shards else (middle + 1, high)
    return low


def loads(groups, cuts):
    out = {}
    for k, s in groups:
        shard = sum(k > c for c in cuts)
        out[shard] = out.get(shard, 0) + s
    return out


def test_large_groups(spark, monkeypatch):
    looked = []
    sums = sharding._sums
    monkeypatch.setattr(sharding, "_sums", lambda *a: looked.append(sums(*a)) or looked[-1])
    random.seed(9)
    for n, shares in ((40_000, [0.2]), (40_000, [0.3]), (30_000, [0.13, 0.13, 0.05]), (5_000, [0.05] * 6 + [0.005] * 30), (20_000, []), (9, [0.3])):
        groups = {random.getrandbits(64) - (1 << 63): random.choice([1, 40, 900, 3000]) for _ in range(n)}
        total = sum(groups.values())
        groups |= {random.getrandbits(64) - (1 << 63): int(total * s / (1 - sum(shares))) for s in shares}
        ordered = sorted(groups.items())
        cuts = sharding.cut_points(spark.createDataFrame(ordered, "group_key long, size long"), 8)
        assert cuts == sorted(cuts) and max(loads(ordered, cuts).values()) == slow_least([s for _, s in ordered])
    assert looked and all(len(x) <= 8 * 2**16 for x in looked)


def test_small_looks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LOOK", 64)
    random.seed(10)
    ordered = sorted({(5 << 50) + random.getrandbits(30): random.choice([3, 70, 800]) for _ in range(3000)}.items()) + [((9 << 50) + 1, 200_000)]
    cuts = sharding.cut_points(spark.createDataFrame(ordered, "group_key long, size long"), 8)
    assert max(loads(ordered, cuts).values()) == slow_least([s for _, s in ordered])


def test_equal_rows_and_one_large_text(spark):
    """A third of the rows are one row, another third share a text."""
    base = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    same = spark.range(1500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one row").alias("text"))
    copies = spark.range(1500).select((F.col("id") + 10_000).alias("doc_id"), F.lit("one text, " * 9).alias("text"))
    got = sharding.shard_documents(base.unionByName(same).unionByName(copies).repartition(5)).collect()
    assert len(got) == 6000 and len({r.shard for r in got if r.size == 91}) == 1
    sizes = {}
    for r in got:
        sizes[r.group_key] = sizes.get(r.group_key, 0) + r["size"]
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r)
    assert max(sum(r["size"] for r in x) for x in by_shard.values()) == slow_least([sizes[k] for k in sorted(sizes)])
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by_shard.values())
