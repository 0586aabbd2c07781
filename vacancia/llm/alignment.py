"""Alignment of two tokenizers' tokens over the same bytes, by merge paths.

A text's tokens under A and under B are two rising lists of byte ends; where both have an end, a
group of tokens ends. The two lists are merged. A diagonal of the merge (so many steps from its start)
meets its path in one point, found by binary search in the two lists alone, so a long merge is divided
into pieces of PIECE steps that know nothing of each other. Short texts share a piece. Pieces are
rows of a stored table: they are merged wherever Spark puts them, and only the texts that were divided
come together again, as what their pieces found, not as tokens.
"""

from __future__ import annotations

import functools
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm import bpe
from vacancia.llm.common import batch_of, id_texts, merge_counts, slices, stored

#: Merge steps of a piece.
PIECE = 1 << 16
#: Characters of text that are encoded together.
CHUNK = 1_000_000
#: Distinct links a task counts before it gives them on.
HELD_LINKS = 1 << 19
TASK_BITS = 40
_DOC = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int32()), ("n_b", pa.int32())])
PIECES = pa.schema([
    ("divided", pa.bool_()), ("number", pa.int32()), ("last", pa.bool_()), ("docs", pa.list_(_DOC)),
    ("a", pa.binary()), ("b", pa.binary()), ("a_from", pa.int64()), ("b_from", pa.int64()),
])
PIECES_DDL = "divided boolean, number int, last boolean, docs array<struct<row:long,doc_id:long,n_a:int,n_b:int>>, a binary, b binary, a_from long, b_from long"
LINKS = pa.schema([("link", pa.int64()), ("n", pa.int64())])
_COUNTS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())]
ALIGNED = pa.schema([("doc_id", pa.int64()), *_COUNTS, ("groups", pa.string())])
ALIGNED_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_SIDE = pa.list_(pa.string())
PARTS = pa.schema([("row", pa.int64()), ("number", pa.int32()), ("doc_id", pa.int64()), *_COUNTS, ("head", _SIDE), ("groups", pa.string()), ("tail", _SIDE)])
PARTS_DDL = "row long, number int, " + ALIGNED_DDL.replace("groups string", "head array<string>, groups string, tail array<string>")


class Tokens:
    """Both tokenizers, the bytes and lengths of their tokens, and the texts that ids are written as."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = bpe.Library(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: x for x, c in bpe.BYTE_CHARS.items()}
        shown = (self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size()))
        self.bytes_a = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in shown]
        pieces = (self.b.id_to_piece(i) for i in range(len(self.b)))
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        #: How ids are stored.
        self.kind = "<u2" if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else "<u4"
        # Ids as text, followed by what may stand after them in a list of groups.
        self.shown = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for end in ends for i in range(n)]

    def encode_a(self, spaced: str) -> np.ndarray | None:
        """A's ids; None if they don't give the text back."""
        if self.a.ordinary is None:
            ids = self.a.plain_ids(spaced).tolist()
            return np.array(ids, self.kind) if b"".join([self.bytes_a[i] for i in ids]) == spaced.encode() else None
        ids = self.a.plain_ids(spaced).tolist()
        return np.array(ids, self.kind) if self.a.ordinary.decode_bytes(ids) == spaced.encode() else None

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both lists of ids, A's of a space and the text; of texts that are null, empty or not given back by either, none."""
        none, out = np.zeros(0, self.kind), []
        of_b = iter(self.b.encode([t for t in texts if t], num_threads=1))
        for text in texts:
            a = b = None
            if text:
                ids = next(of_b)
                if b"".join(map(self.bytes_b.__getitem__, ids)) == b" " + text.encode("utf-8", "replace"):
                    a, b = self.encode_a(" " + text), np.array(ids, self.kind)
            out.append((none, none) if a is None else (a, b))
        return out


@functools.lru_cache(maxsize=1)
def tokens(path_a: str, path_b: str) -> Tokens:
    """The worker's; they outlive the task."""
    return Tokens(path_a, path_b)


def crossing(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many ends of ``a`` and of ``b`` the first ``diagonal`` steps of their merge take (a's first where they are equal).

    An end that both have is not divided: the steps are one more then.
    """
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[diagonal - middle - 1]:
            low = middle + 1
        else:
            high = middle
    i, j = low, diagonal - low
    return i, j + (0 < i and j < len(b) and a[i - 1] == b[j])


def cut_pieces(docs: DataFrame, path_a: str, path_b: str, piece: int = PIECE) -> DataFrame:
    """Rows of PIECES: several whole texts, or (divided) a part of one with its number, both lists of ids and where their first tokens start."""

    def run(batches):
        t, count = tokens(path_a, path_b), itertools.count(TaskContext.get().partitionId() << TASK_BITS)
        docs, a, b, steps = [], [], [], 0

        def close():
            return batch_of(PIECES, [False], [0], [True], [docs], [b"".join(a)], [b"".join(b)], [0], [0])

        for part in slices(batches):
            ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            ends = np.cumsum([len(x or "") for x in texts])
            edges = [0, *(np.searchsorted(ends, np.arange(CHUNK, ends[-1], CHUNK)) + 1).tolist(), len(texts)]
            for x, y in zip(edges, edges[1:]):
                for doc_id, (own_a, own_b) in zip(ids[x:y], t.encode(texts[x:y])):
                    row, own = next(count), len(own_a) + len(own_b)
                    if own <= piece:
                        if steps + own > piece and docs:
                            yield close()
                            docs, a, b, steps = [], [], [], 0
                        docs.append((row, doc_id, len(own_a), len(own_b)))
                        a.append(own_a.tobytes())
                        b.append(own_b.tobytes())
                        steps += own
                        continue
                    ends_a, ends_b = np.cumsum(t.len_a[own_a]), np.cumsum(t.len_b[own_b])
                    points = [crossing(ends_a, ends_b, d) for d in range(0, own, piece)] + [(len(own_a), len(own_b))]
                    for k, ((i, j), (i2, j2)) in enumerate(zip(points, points[1:])):
                        yield batch_of(
                            PIECES, [True], [k], [k == len(points) - 2], [[(row, doc_id, i2 - i, j2 - j)]], [own_a[i:i2].tobytes()], [own_b[j:j2].tobytes()],
                            [int(ends_a[i - 1]) if i else 0], [int(ends_b[j - 1]) if j else 0],
                        )
        if docs:
            yield close()

    return id_texts(docs).mapInArrow(run, PIECES_DDL)


class Merged:
    """One piece: its ids, and the places in both lists of the ends they share."""

    def __init__(self, row: dict, t: Tokens):
        self.a, self.b = (np.frombuffer(row[c], t.kind).astype(np.int64) for c in "ab")
        ends_a, ends_b = row["a_from"] + np.cumsum(t.len_a[self.a]), row["b_from"] + np.cumsum(t.len_b[self.b])
        _, self.at_a, self.at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        #: A link is the pair of the tokens whose ranges end there, as one number.
        self.links = self.a[self.at_a] * len(t.bytes_b) + self.b[self.at_b]


def link_counts(pieces: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """link, n over all texts; tasks sum up before the shuffle.

    Of two tokens whose ranges end together one's bytes end the other's, so there are no more
    distinct links than such pairs in the two vocabularies (324 302 for the default ones).
    """

    def run(batches):
        t = tokens(path_a, path_b)
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in slices(batches, 16):
            found = [Merged(r, t).links for r in part.to_pylist()]
            fresh, n = np.unique(np.concatenate(found), return_counts=True)
            keys, counts = merge_counts([keys, fresh], [counts, n])
            if len(keys) > HELD_LINKS:
                yield batch_of(LINKS, keys, counts)
                keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(keys):
            yield batch_of(LINKS, keys, counts)

    return pieces.mapInArrow(run, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))


def _table(counts: DataFrame, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links in rising order, their counts, and whether a count is the highest of its B id."""
    rows = counts.toPandas().sort_values("link")
    links, n = rows["link"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    highest = np.zeros(n_b, np.int64)
    np.maximum.at(highest, links % n_b, n)
    return links, n, n == highest[links % n_b]


def _shown(t: Tokens, m: Merged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The piece's groups written out as numbers of ``t.shown``, and the place there of each A and each B token.

    A group's A tokens stand before its B tokens; tokens behind the last shared end are a group of their own.
    """
    group_a, group_b = np.searchsorted(m.at_a, np.arange(len(m.a))), np.searchsorted(m.at_b, np.arange(len(m.b)))
    n = len(m.at_a)
    place_a = np.arange(len(m.a)) + np.concatenate([[0], m.at_b + 1])[group_a]
    place_b = np.arange(len(m.b)) + np.concatenate([m.at_a + 1, [len(m.a)]])[group_b]
    end_a, end_b = np.zeros(len(m.a), np.int64), np.zeros(len(m.b), np.int64)
    end_a[m.at_a], end_b[m.at_b] = 1, 1
    out = np.zeros(len(m.a) + len(m.b), np.int64)
    n_a, n_b = len(t.bytes_a), len(t.bytes_b)
    out[place_a] = m.a + n_a * end_a
    out[place_b] = 2 * n_a + m.b + n_b * end_b
    return out, place_a, place_b


def _sums(m: Merged, table: tuple, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n_best and count_sum of the links from ``lo`` up to ``hi``."""
    links, n, best = table
    at = np.searchsorted(links, m.links)
    best_before, n_before = (np.concatenate([[0], np.cumsum(x[at])]) for x in (best, n))
    return best_before[hi] - best_before[lo], n_before[hi] - n_before[lo]


def _merge_whole(pieces: DataFrame, table: Broadcast, path_a: str, path_b: str) -> DataFrame:
    def run(batches):
        t = tokens(path_a, path_b)
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            m, docs = Merged(row, t), row["docs"]
            n_a, n_b = (np.array([d[c] for d in docs], np.int64) for c in ("n_a", "n_b"))
            end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)
            last = np.searchsorted(m.at_a, end_a)  # shared ends before and, as texts end together, up to each text's end
            first = np.concatenate([[0], last[:-1]])
            n_best, count_sum = _sums(m, table.value, first, last)
            codes = _shown(t, m)[0]
            text = list(map(t.shown.__getitem__, codes.tolist()))
            ends = (end_a + end_b).tolist()
            groups = ["".join(text[x:y])[:-1] for x, y in zip([0, *ends], ends)]
            yield batch_of(ALIGNED, [d["doc_id"] for d in docs], n_a, n_b, last - first, last - first, n_best, count_sum, groups)

    return pieces.where("not divided").mapInArrow(run, ALIGNED_DDL)


def _merge_divided(pieces: DataFrame, table: Broadcast, path_a: str, path_b: str) -> DataFrame:
    """What each piece of a divided text finds: its counts, its groups between the first and the last shared end, and the tokens outside of them."""

    def run(batches):
        t = tokens(path_a, path_b)
        for part in slices(batches, 1):
            row = part.to_pylist()[0]
            m, doc = Merged(row, t), row["docs"][0]
            n = len(m.at_a)
            n_best, count_sum = _sums(m, table.value, np.array([0]), np.array([n]))
            head_a, head_b = (m.at_a[0] + 1, m.at_b[0] + 1) if n else (0, 0)
            tail_a, tail_b = (m.at_a[-1] + 1, m.at_b[-1] + 1) if n else (0, 0)
            inner = _shown(t, m)[0][head_a + head_b : tail_a + tail_b]
            side = lambda x: ",".join(map(str, x.tolist()))
            yield batch_of(
                PARTS, [doc["row"]], [row["number"]], [doc["doc_id"]], [len(m.a)], [len(m.b)], [n], [n], n_best, count_sum, [[side(m.a[:head_a]), side(m.b[:head_b])] if n else None],
                ["".join(map(t.shown.__getitem__, inner.tolist()))], [[side(m.a[tail_a:]), side(m.b[tail_b:])]],
            )

    return pieces.where("divided").mapInArrow(run, PARTS_DDL)


def _stitch(parts: DataFrame) -> DataFrame:
    """One row a divided text: a piece's tail and the next one's head are a group."""

    def run(batches):
        # Parts come sorted by text and number; one text is held at a time.
        held = None

        def close():
            return batch_of(ALIGNED, [held["doc_id"]], *([held[name]] for name, _ in _COUNTS), ["".join(held["text"])[:-1]])

        def joined(x, y):
            return [",".join(filter(None, pair)) for pair in zip(x, y)]

        for part in slices(batches, 16):
            for r in part.to_pylist():
                if held is None or r["row"] != held["row"]:
                    if held is not None:
                        yield close()
                    held = {"row": r["row"], "doc_id": r["doc_id"], "text": [], "open": ["", ""]} | {name: 0 for name, _ in _COUNTS}
                for name, _ in _COUNTS:
                    held[name] += r[name]
                if r["head"] is None:
                    held["open"] = joined(held["open"], r["tail"])
                    continue
                held["text"] += ["|".join(joined(held["open"], r["head"])), ";", r["groups"]]
                held["open"] = r["tail"]
        if held is not None:
            yield close()

    return parts.repartition("row").sortWithinPartitions("row", "number").mapInArrow(run, ALIGNED_DDL)


def align(docs: DataFrame, path_a: str, path_b: str, piece: int = PIECE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups of every text.

    A (a byte-level BPE file) reads a space and the text, B (a sentencepiece model that adds a space)
    the text; special strings are plain text. ``groups`` lists each group's A ids and B ids as
    ``a1,a2|b1;a3|b2,b3``. A link joins the two tokens that end a group; its count is how often it
    occurs over all texts. n_best is how many of a text's links have the highest count that their B id has
    in any link, count_sum the sum of their counts.

    Texts that are null, empty or not given back byte by byte by both tokenizers have no tokens:
    zeros and no groups. Repeated rows are aligned and counted each; an empty table gives none; other
    columns are not read. The links' counts are the only thing broadcast; their number is bounded by
    the vocabularies.
    """
    pieces = stored(cut_pieces(docs, path_a, path_b, piece), "pieces")
    counts = link_counts(pieces, path_a, path_b)
    table = docs.sparkSession.sparkContext.broadcast(_table(counts, len(tokens(path_a, path_b).bytes_b)))
    whole = _merge_whole(pieces, table, path_a, path_b)
    return whole.unionByName(_stitch(_merge_divided(pieces, table, path_a, path_b)))
