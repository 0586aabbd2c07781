"""A Merkle manifest of a table of documents: only every few levels are stored, the rest is made again for proofs.

Each document is a leaf; the leaves of a language, in order of doc_id, are one tree, and the roots
of these trees, in order of language, are the leaves of a last one. A node is the SHA-256 of its two
(or, at the end of a level, one) children. Level 0, STEP, 2 * STEP, ... of each tree are stored as
tables. A proof needs the levels between as well: the aligned subtree of 2 ** STEP stored nodes that
a leaf lies in is hashed again, gives each of its nodes its siblings, and is dropped. Proofs are put
together from the last tree downwards, so a leaf's subtree only adds its own few siblings to those of
the subtree's root.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import batch_of, ship, stored

#: Levels from one stored level to the next; a subtree that is made again has 2 ** STEP nodes at most.
STEP = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Place of a task's rows: monotonically_increasing_id counts them below this bit.
TASK_BITS = 33
NODE = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("node", pa.string()), ("doc_id", pa.int64()), ("claim", pa.string())])
NODE_DDL = "tree string, idx long, n long, node string, doc_id long, claim string"
PATH = pa.schema([
    ("tree", pa.string()), ("idx", pa.int64()), ("doc_id", pa.int64()), ("node", pa.string()), ("siblings", pa.list_(pa.string())), ("turns", pa.string()),
    ("subroot", pa.string()), ("folded_root", pa.string()),
])
PATH_DDL = "tree string, idx long, doc_id long, node string, siblings array<string>, turns string, subroot string, folded_root string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def steps_above(n: int, tier: int, step: int) -> int:
    """Levels that a subtree at stored level number ``tier`` has above that level, in a tree of n leaves."""
    return max(0, min(step, (n - 1).bit_length() - tier * step))


def levels(nodes: list[str], steps: int) -> list[list[str]]:
    out = [nodes]
    for _ in range(steps):
        last = out[-1]
        out.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return out


def fold(node: str, siblings: list[str], turns: str) -> str:
    """The root that a leaf and its proof give. ``turns`` has a letter a level: the sibling stands left (L), right (R) or is missing (-)."""
    rest = iter(siblings)
    for turn in turns:
        node = digest(next(rest) + node if turn == "L" else node + next(rest) if turn == "R" else node)
    return node


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(changed: dict[str, Column] | None = None) -> Column:
    """A row's leaf, over FIELDS; ``changed`` has other values for some of them."""
    return F.sha2(F.concat(*(_field((changed or {}).get(c, F.col(c))) for c in FIELDS)), 256)


def _placed(leaves: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Adds idx (the leaf's place in its tree, in this order) and n (the tree's leaves).

    Rows are dealt by ranges of their order, so a large tree is spread over many tasks; rows that are
    equal in everything are told apart by their place in the input. Only sums a task and tree are summed up.
    """
    order = ("tree", *order, "tie")
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    held = stored(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-order").withColumn("task", F.shiftright("at", TASK_BITS))
    runs = held.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("held"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "tree", "task", (F.sum("held").over(whole.orderBy("task")) - F.col("held") - F.col("first")).alias("shift"), F.sum("held").over(whole).alias("n")
    )
    return held.join(runs, ["tree", "task"]).select("tree", (F.col("at") + F.col("shift")).alias("idx"), "n", "node", "doc_id", "claim")


def _subtrees(rows: DataFrame) -> DataFrame:
    """Rows of one aligned subtree come to one task one after another, 2 ** step and a path at most."""
    ship(rows.sparkSession)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")


def _each_subtree(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    rows = (r for batch in batches for at in range(0, batch.num_rows, 512) for r in batch.slice(at, 512).to_pylist())
    for key, group in groupby(rows, key=lambda r: (r["tree"], r["block"])):
        yield key, list(group)


def _roots(nodes: DataFrame, tier: int, step: int) -> DataFrame:
    """The roots of the subtrees of a stored level, as nodes of the next stored level."""

    def run(batches):
        for (tree, block), rows in _each_subtree(batches):
            n = rows[0]["n"]
            yield batch_of(NODE, [tree], [block], [n], levels([r["node"] for r in rows], steps_above(n, tier, step))[-1], [None], [None])

    return _subtrees(nodes.withColumn("block", F.shiftright("idx", step))).mapInArrow(run, NODE_DDL)


def _grow(leaves: DataFrame, name: str, step: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees, lowest first, and the trees' roots (tree, node)."""
    tiers, roots = [stored(leaves, f"merkle-{name}-0")], None
    most = tiers[0].agg(F.max("n")).first()[0] or 0
    while True:
        tier = len(tiers) - 1
        made = stored(_roots(tiers[-1], tier, step), f"merkle-{name}-{tier + 1}")
        done = F.col("n") <= 1 << step * (tier + 1)
        ended = made.where(done).select("tree", "node")
        roots = ended if roots is None else roots.unionByName(ended)
        if most <= 1 << step * (tier + 1):
            return tiers, roots
        tiers.append(made.where(~done))


def _paths(tiers: list[DataFrame], above: DataFrame, step: int, check: bool) -> DataFrame:
    """Siblings and turns of each leaf up to the last root, ``above`` holding those of the trees' roots (tree, siblings, turns, subroot).

    With ``check`` the leaves' claims are folded as well.
    """
    below = None
    for tier in range(len(tiers) - 1, -1, -1):
        ends = F.col("n") <= 1 << step * (tier + 1)
        paths = tiers[tier].where(ends & (F.col("idx") == 0)).select("tree").join(above, "tree").withColumn("block", F.lit(0).cast("long"))
        if below is not None:
            paths = paths.unionByName(below.select("tree", "siblings", "turns", "subroot", F.col("idx").alias("block")))

        def run(batches, tier=tier):
            for (tree, _), rows in _each_subtree(batches):
                top, nodes = rows[0], rows[1:]
                made = levels([r["node"] for r in nodes], steps_above(nodes[0]["n"], tier, step))
                out = []
                for place, row in enumerate(nodes):
                    siblings, turns, at = [], "", place
                    for level in made[:-1]:
                        other = at ^ 1
                        if other < len(level):
                            siblings.append(level[other])
                            turns += "L" if other < at else "R"
                        else:
                            turns += "-"
                        at >>= 1
                    siblings, turns = siblings + top["siblings"], turns + top["turns"]
                    folded = fold(row["claim"], siblings, turns) if check and tier == 0 else None
                    out.append((tree, row["idx"], row["doc_id"], row["node"], siblings, turns, top["subroot"], folded))
                yield batch_of(PATH, *zip(*out))

        nodes = tiers[tier].withColumn("block", F.shiftright("idx", step))
        rows = nodes.unionByName(paths.withColumn("idx", F.lit(-1).cast("long")), allowMissingColumns=True)
        below = _subtrees(rows).mapInArrow(run, PATH_DDL)
        if tier:
            below = stored(below, f"merkle-paths-{tier}")
    return below


@dataclass
class Manifest:
    """The stored levels of the trees of languages and of the tree over them, and its root (None: no documents)."""

    tiers: list[DataFrame]
    top_tiers: list[DataFrame]
    root: str | None
    step: int


def build(docs: DataFrame, claim: Column | None = None, step: int = STEP) -> Manifest:
    """The manifest of all rows of ``docs`` (the columns FIELDS; others are not read).

    ``claim`` is a second leaf that is kept beside each own one, to be checked by the own one's
    proof; by default it is the own one. A null language is a tree of its own, before the others.
    Every ``step`` levels one is stored. Null fields are hashed as '-'. Rows without doc_id come first in their tree; rows with one
    doc_id are ordered by leaf, and rows that are equal in every field are leaves each.
    """
    own = docs.select(*(F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string").alias(c) for c in FIELDS))
    leaf = leaf_hash()
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaves = own.select(tree.alias("tree"), leaf.alias("node"), "doc_id", (leaf if claim is None else claim).alias("claim"))
    tiers, roots = _grow(_placed(leaves, ("doc_id", "node")), "languages", step)
    names = roots.select(F.lit("").alias("tree"), "node", F.lit(None).cast("long").alias("doc_id"), F.col("tree").alias("claim"))
    top_tiers, top = _grow(_placed(names, ("claim",)), "all", step)
    row = top.first()
    return Manifest(tiers, top_tiers, row and row["node"], step)


def proofs(manifest: Manifest, spark) -> DataFrame:
    """doc_id, leaf, siblings, turns, subroot, folded_root, verified of every row that was built in.

    siblings are the proof, from the leaf's level to the root, and turns say where each stands (see
    ``fold``); folded_root is what the row's claim and its siblings give, verified whether that is the
    root. No documents give no rows.
    """
    none = spark.createDataFrame([("", [], "", "")], "tree string, siblings array<string>, turns string, subroot string")
    top = _paths(manifest.top_tiers, none, manifest.step, check=False)
    names = manifest.top_tiers[0].select("idx", F.col("claim").alias("name"))
    above = stored(top.join(names, "idx").select(F.col("name").alias("tree"), "siblings", "turns", F.col("node").alias("subroot")), "merkle-subroots")
    found = _paths(manifest.tiers, above, manifest.step, check=True)
    root = F.lit(manifest.root).cast("string")
    return found.select("doc_id", F.col("node").alias("leaf"), "siblings", "turns", "subroot", root.alias("root"), "folded_root", (F.col("folded_root") == root).alias("verified"))
