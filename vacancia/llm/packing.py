"""Order-preserving packing of token streams by dynamic programming.

The documents of a task, in their order, form one stream of ids, each document closed by an end id.
Sequences are cut from it one after another. Cuts may stand at document ends (free), at sentence
ends (a small penalty) and, so that a long sentence can be passed, every STRIDE ids (a larger one).
The cuts chosen make padding plus penalties least. With positions p, the cost of a cut j is
penalty(j) + size - p(j) + min over cuts i with p(j) - p(i) <= size of cost(i) + p(i): the minimum
of a sliding window, kept by a monotone queue, so each cut is handled once.
"""

from __future__ import annotations

import functools
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm import bpe
from vacancia.llm.common import id_texts, slices

#: Penalties in padding ids.
SENTENCE, TRUNCATION, STRIDE = 2, 12, 32
#: Ids that are planned at a time; the last sequences of a plan are planned anew with what follows.
BLOCK, REDO = 1 << 20, 2
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, padded_to int, ids binary"
OUT = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("padded_to", pa.int32()), ("ids", pa.binary()),
])


@functools.lru_cache(maxsize=1)
def sentence_ends(path: str) -> np.ndarray:
    """For each id whether its token closes a sentence: it ends with . ! or ? or holds a line end."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = [model.id_to_piece(i) for i in range(len(model))]
    else:
        t = bpe.library(path).tokenizer
        tokens = [t.id_to_token(i) or "" for i in range(t.get_vocab_size())]
    newline = bpe.BYTE_CHARS[10]
    return np.array([x.removesuffix("</w>").endswith((".", "!", "?")) or newline in x or "\n" in x for x in tokens], bool)


def plan(positions: list[int], penalties: list[int], size: int) -> list[int]:
    """Positions of the cuts of least cost from 0 to the last position; gaps between positions are at most ``size``."""
    n = len(positions)
    key, back = [0] * n, [0] * n  # cost + position of each cut, and the cut before it
    queue = deque([0])
    key[0] = positions[0]
    for j in range(1, n):
        p = positions[j]
        while positions[queue[0]] < p - size:
            queue.popleft()
        i = queue[0]
        back[j] = i
        k = key[j] = key[i] + size + penalties[j]
        while queue and key[queue[-1]] > k:
            queue.pop()
        queue.append(j)
    cuts, j = [positions[-1]], n - 1
    while j:
        j = back[j]
        cuts.append(positions[j])
    return cuts[::-1]


class Packer:
    """Collects one task's documents and gives finished pieces; memory holds about BLOCK ids, or one document."""

    def __init__(self, ends: np.ndarray, size: int, first_id: int):
        self.ends, self.size, self.next_id = ends, size, first_id
        self.parts: list[tuple[int | None, int, np.ndarray, int]] = []  # doc_id, ids before, ids, document's ids
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.parts.append((doc_id, 0, ids, len(ids)))
        self.held += len(ids)

    def pieces(self, last: bool) -> pa.RecordBatch | None:
        """The pieces planned now; all of them if these documents are the ``last``."""
        if not self.parts:
            return None
        lengths = np.array([len(p[2]) for p in self.parts])
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        stream = np.concatenate([p[2] for p in self.parts])
        penalty = np.full(len(stream) + 1, -1, np.int64)
        penalty[::STRIDE] = TRUNCATION
        penalty[1:][self.ends[np.minimum(stream, len(self.ends) - 1)]] = SENTENCE
        penalty[bounds] = 0
        nodes = np.flatnonzero(penalty >= 0)
        cuts = plan(nodes.tolist(), penalty[nodes].tolist(), self.size)
        if not last:
            cuts = cuts[: max(1, len(cuts) - REDO)]
        done = cuts[-1]
        out = self._cut(stream, bounds, np.array(cuts)) if len(cuts) > 1 else None
        kept = []
        for (doc_id, before, ids, total), a, b in zip(self.parts, bounds[:-1].tolist(), bounds[1:].tolist()):
            if b > done:
                skip = max(0, done - a)
                kept.append((doc_id, before + skip, ids[skip:].copy(), total))
        self.parts, self.held = kept, len(stream) - done
        return out

    def _cut(self, stream: np.ndarray, bounds: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        edges = np.union1d(bounds[bounds <= cuts[-1]], cuts)
        a, b = edges[:-1], edges[1:]
        doc = np.searchsorted(bounds, a, "right") - 1
        sequence = np.searchsorted(cuts, a, "right") - 1
        used = np.diff(cuts)[sequence]
        padded = np.where(used & (used - 1) == 0, used, self.size)
        before = np.array([self.parts[d][1] for d in doc.tolist()])
        data = stream.astype("<u4").tobytes()
        columns = [
            [self.parts[d][0] for d in doc.tolist()], before + a - bounds[doc], b - a, [self.parts[d][3] for d in doc.tolist()],
            sequence + self.next_id, a - cuts[sequence], padded, [data[4 * x : 4 * y] for x, y in zip(a.tolist(), b.tolist())],
        ]
        self.next_id += len(cuts) - 1
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, OUT)], schema=OUT)


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of whole documents in sequences of at most ``size`` ids, as described above; map-only.

    doc_id, start (its document's ids before it), length, doc_tokens (with the end id), sequence_id,
    offset (in the sequence), padded_to (``size``, or the sequence's length if that is a power of
    two), ids (little-endian unsigned 32-bit). Each task packs its own rows in their order, so a
    sequence never spans tasks; a repeated attempt of a task reads the same rows and gives the same
    pieces. A null or empty text is its end id alone; repeated rows are packed each on its own;
    an empty table gives no piece; columns other than doc_id and text are not read.
    """

    def run(batches):
        packer = Packer(sentence_ends(path), size, TaskContext.get().partitionId() << 32)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), bpe.encode(path, texts)):
                packer.add(doc_id, np.append(ids, np.uint32(end_id)).astype("<u4"))
            if packer.held >= BLOCK and (out := packer.pieces(last=False)) is not None:
                yield out
        if (out := packer.pieces(last=True)) is not None:
            yield out

    return id_texts(docs).mapInArrow(run, SCHEMA)
