"""The manifest against a plain tree that is held whole."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from test_llm_operators import SF, docs, empty, key  # noqa: F401

import check
from vacancia.llm import merkle_manifest, queries


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(row, more=0):
    values = [row.doc_id, row.source, row.lang, None if row.n_chars is None else row.n_chars + more, row.text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and for each node its (siblings, fold)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for path, i in zip(paths, at):
            run = level[i // 2 * 2 : i // 2 * 2 + 2]
            path.append((run, i % 2))
        level, at = [h(*level[i : i + 2]) for i in range(0, len(level), 2)], [i // 2 for i in at]
    return level[0] if level else None, paths


def slow_manifest(rows, tampered):
    langs = {}
    for r in rows:
        langs.setdefault(r.lang, []).append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted(langs[x], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r))) for x in names}
    trees = {x: tree([leaf(r) for r in own[x]]) for x in names}
    root, tops = tree([trees[x][0] for x in names])
    out = []
    for x, top in zip(names, tops):
        for r, path in zip(own[x], trees[x][1]):
            siblings = [n for run, i in path + top for k, n in enumerate(run) if k != i]
            folded = leaf(r, tampered(r))
            for run, i in path + top:
                folded = h(*(folded if k == i else n for k, n in enumerate(run)))
            out.append((r.doc_id, leaf(r), trees[x][0], root, h(*siblings), folded, folded == root))
    return out


def tampered(r):
    return int(zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 0)


def found(rows):
    return sorted(map(tuple, rows), key=key)


def test_query_on_given_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = slow_manifest(rows, tampered)
    assert found(queries.op12_merkle_manifest(spark, SF).collect()) == found(want)
    assert {v[-1] for v in want} == {True, False}


@pytest.mark.parametrize("step", [1, 2, 8])
def test_odd_rows(spark, docs, empty, step):  # noqa: F811
    odd = docs.withColumn("lang", F.expr("case when doc_id % 10 = 0 then 'é' when doc_id % 10 = 1 then '' when doc_id % 10 < 4 then null when doc_id = 14 then 'one' else lang end"))
    odd = odd.withColumn("n_chars", F.expr("case when doc_id % 3 = 0 then null else n_chars end")).withColumn("source", F.expr("case when doc_id % 5 = 0 then null else source end"))
    odd = odd.unionByName(odd.limit(3)).cache()
    got = merkle_manifest.proofs(merkle_manifest.build(odd, merkle_manifest.leaf_hash({"n_chars": F.col("n_chars") + 1}), step), spark)
    got = got.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256), "folded_root", "verified")
    assert found(got.collect()) == found(slow_manifest(odd.collect(), lambda r: 1))
    honest = merkle_manifest.proofs(merkle_manifest.build(odd, step=step), spark).collect()
    assert all(r.verified and merkle_manifest.fold(r.leaf, r.siblings, r.turns) == r.root for r in honest)
    assert merkle_manifest.proofs(merkle_manifest.build(empty), spark).collect() == []


def test_languages_of_many_rows(spark):
    """Trees whose sizes lie around powers of the stored step, and more languages than one stored block has."""
    sizes = [1, 3, 4, 5, 15, 16, 17, 63, 64, 65] + [1] * 20
    docs = spark.createDataFrame([(1000 * i + k, "t", f"l{i:02}", "s", 1) for i, n in enumerate(sizes) for k in range(n)], "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = merkle_manifest.proofs(merkle_manifest.build(docs, step=2), spark).select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", ""), 256), "folded_root", "verified")
    assert found(got.collect()) == found(slow_manifest(docs.collect(), lambda r: 0))


def test_sql_gives_the_same(spark):
    df = queries.op12_merkle_manifest(spark, SF)
    cur = check.duck(SF).execute(queries.ORACLES["op12_merkle_manifest"])
    assert check.table([tuple(r) for r in df.collect()], df.columns) == check.table(cur.fetchall(), [c[0] for c in cur.description])
