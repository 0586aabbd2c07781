"""Language identification: words first, shorter and shorter character n-grams for unseen words."""

from __future__ import annotations

import functools
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import batch_of, id_texts, keep_rows, ship, slices, stored

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
LONGEST = 4
#: Words looked up at a time.
CHUNK = 4096
OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
COUNTS = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("key", pa.string()), ("n", pa.int64())])


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams(word: str, size: int) -> list[str]:
    """The n-grams of the word between two marks; a single letter for size 1."""
    padded = word if size == 1 else f"^{word}$"
    return [padded[i : i + size] for i in range(len(padded) - size + 1)]


@dataclass
class Model:
    """Log frequencies: ``tables[0]`` of words, ``tables[k]`` of k-grams; each key has one row of ``logs``."""

    langs: list[str]
    tables: list[dict[str, int]]
    logs: np.ndarray


def _counts(batches):
    """(lang, kind, key, n): kind 0 for words, k for k-grams; flushed whenever many keys have gathered."""
    seen: dict[tuple[str, int], Counter] = {}

    def flush():
        for (lang, kind), c in seen.items():
            yield batch_of(COUNTS, [lang] * len(c), [kind] * len(c), list(c), list(c.values()))
        seen.clear()

    for part in slices(batches):
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            found = Counter(words_of(text))
            seen.setdefault((lang, 0), Counter()).update(found)
            for word, n in found.items():
                for k in range(1, LONGEST + 1):
                    c = seen.setdefault((lang, k), Counter())
                    for g in grams(word, k):
                        c[g] += n
            if sum(map(len, seen.values())) > 400_000:
                yield from flush()
    yield from flush()


def train(labelled: DataFrame, docs_per_lang: int = 2_000, keys_per_table: int = 20_000) -> Model:
    """Model from about ``docs_per_lang`` documents (by a hash of the id) of each language of ``labelled`` (doc_id, text, lang).

    The sample bound is this operator's parameter, as is the model's size: for each language about
    ``keys_per_table`` words, and n-grams of each size, stay, the most frequent ones; among those of the
    least count that still has room, a hash decides. Rows without text or language teach nothing; of no rows
    the model knows no language.
    """
    ship(labelled.sparkSession)
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    near = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 40)) < F.least(F.lit(1.0), docs_per_lang / F.col("n_docs")) * (1 << 40)
    sample = rows.join(F.broadcast(sizes), "lang").where(near).select("lang", "text")
    counts = stored(
        sample.mapInArrow(_counts, "lang string, kind int, key string, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "lang-counts"
    )
    # For each table the last count with room, and the share of its keys that there is room for.
    at_least: dict[tuple[str, int], tuple[int, float]] = {}
    totals: dict[tuple[str, int], int] = {}
    held: Counter = Counter()
    levels = counts.groupBy("lang", "kind", "n").agg(F.count(F.lit(1)).alias("keys")).collect()
    for r in sorted(levels, key=lambda r: -r.n):
        table = (r.lang, r.kind)
        totals[table] = totals.get(table, 0) + r.n * r["keys"]
        if held[table] < keys_per_table:
            at_least[table] = (r.n, min(1.0, (keys_per_table - held[table]) / r["keys"]))
        held[table] += r["keys"]
    if not totals:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0), np.float32))
    spark = labelled.sparkSession
    limits = spark.createDataFrame([(*t, *x) for t, x in at_least.items()], "lang string, kind int, least long, part double")
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < F.col("part") * (1 << 40)
    kept = counts.join(F.broadcast(limits), ["lang", "kind"]).where((F.col("n") > F.col("least")) | (F.col("n") == F.col("least")) & drawn).groupBy("kind", "key").agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")  # one entry a language
    ).collect()
    langs = sorted({lang for lang, _ in totals})
    tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    logs = np.zeros((len(kept), len(langs)), np.float32)
    floor = np.array([[np.log(0.5 / (totals.get((lang, k), 0) + 1)) for lang in langs] for k in range(LONGEST + 1)], np.float32)
    for at, r in enumerate(kept):
        tables[r.kind][r.key] = at
        logs[at] = floor[r.kind]
        for i, lang in enumerate(langs):
            if n := r.by_lang.get(lang):
                logs[at, i] = np.log(n / totals[lang, r.kind])
    return Model(langs, tables, logs)


class Scorer:
    """Scores texts; rows of unseen words are worked out once and remembered up to ``room`` words."""

    def __init__(self, model: Model, room: int = 200_000):
        self.model, self.known = model, len(model.logs)
        self.rows = np.concatenate([model.logs, np.zeros((room + CHUNK, len(model.langs)), np.float32)])
        self.at, self.next = dict(model.tables[0]), self.known

    def _unseen(self, word: str) -> int:
        """The row of an unseen word: the mean over its longest n-grams of which one is known; none: no evidence."""
        row = np.zeros(len(self.model.langs), np.float32)
        for size in range(LONGEST, 0, -1):
            found = [i for g in grams(word, size) if (i := self.model.tables[size].get(g)) is not None]
            if found:
                row = self.model.logs[found].mean(axis=0)
                break
        at = self.at[word] = self.next
        self.rows[at] = row
        self.next += 1
        return at

    def score(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.langs:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.model.langs))
        for start in range(0, len(words), CHUNK):
            some = words[start : start + CHUNK]
            if self.next + len(some) > len(self.rows):  # no room for its unseen words: forget the earlier ones
                self.at, self.next = dict(self.model.tables[0]), self.known
            found = list(map(self.at.get, some))
            if None in found:
                get = self.at.get
                found = [x if x is not None else self._unseen(w) if (y := get(w)) is None else y for w, x in zip(some, found)]
            total += self.rows[found].sum(axis=0, dtype=np.float64)
        return self._verdict(total, len(words))

    def _verdict(self, total: np.ndarray, n: int) -> tuple[str, float]:
        """The best language and its share, each word's evidence counting as a tenth of it in long texts."""
        mean = total / n * min(n, 10)
        p = np.exp(mean - mean.max())
        best = int(p.argmax())
        return self.model.langs[best], float(p[best] / p.sum())


@functools.lru_cache(maxsize=1)
def _scorer(held) -> Scorer:
    return Scorer(held.value)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; map-only, the model is broadcast.

    A text that is null or has no letter gets ``und`` and 0; ties go to the language first by name.
    Repeated rows each get a row; columns other than doc_id and text are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _scorer(held)
        for part in slices(batches):
            found = [scorer.score(t) for t in part.column("text").to_pylist()]
            yield batch_of(OUT, part.column("doc_id"), [x[0] for x in found], [x[1] for x in found])

    return id_texts(docs).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is determined with a score of ``least`` or more; all columns stay.

    Rows whose text is null or has no letter go, as do all rows if the model knows no language.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def decide():
        scorer = _scorer(held)
        return lambda texts: [lang != UNDETERMINED and score >= least for lang, score in map(scorer.score, texts)]

    return keep_rows(docs, decide)
