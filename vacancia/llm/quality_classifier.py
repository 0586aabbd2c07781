"""Quality classifier by compression: which of two zstandard dictionaries shortens a text more."""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import batch_of, id_texts, keep_rows, share, ship, slices, stored

#: Texts are compressed in blocks of so many bytes, so that the dictionary matters in long ones too.
BLOCK = 2048
LEVEL = 3
#: Parts of the labelled sample, each measured with dictionaries from the others; share of the logistic curve, which breaks ties.
FOLDS, SMOOTH = 3, 0.1
PIECES = pa.schema([("quality", pa.int32()), ("fold", pa.int32()), ("block", pa.binary())])
POINTS = pa.schema([("quality", pa.int32()), ("x", pa.float64())])
OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


@dataclass
class Model:
    """Two dictionaries and the calibration: the score is a curve through (knots, levels), mixed with a logistic one."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    knots: np.ndarray
    levels: np.ndarray

    def scores(self, difference: np.ndarray) -> np.ndarray:
        logistic = 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -500, 500)))
        if not len(self.knots):
            return logistic
        return (1 - SMOOTH) * np.interp(difference, self.knots, self.levels) + SMOOTH * logistic


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]


class Compressors:
    def __init__(self, good: bytes, bad: bytes):
        def compressor(data):
            return zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data) if data else None,
                write_content_size=False, write_checksum=False, write_dict_id=False,
            )

        self.good, self.bad = compressor(good), compressor(bad)

    def difference(self, text: str | None) -> float:
        """(compressed with the bad dictionary - with the good one) / size, over all blocks of the text."""
        parts = blocks(text)
        gain = sum(len(self.bad.compress(x)) - len(self.good.compress(x)) for x in parts)
        return gain / max(1, sum(map(len, parts)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, with a light ridge on the slope."""
    scale = float(np.sqrt(np.average(x * x, weights=weight))) or 1.0
    features = np.stack([x / scale, np.ones_like(x)], axis=1)
    theta, ridge = np.zeros(2), np.diag([0.5, 1e-6])

    def loss(t):
        m = features @ t
        return float((weight * (np.logaddexp(0, m) - y * m)).sum() + t @ ridge @ t / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ theta, -40, 40)))
        gradient = features.T @ (weight * (p - y)) + ridge @ theta
        step = np.linalg.solve((features * (weight * p * (1 - p))[:, None]).T @ features + ridge, gradient)
        rate = 1.0
        while rate > 1e-4 and loss(theta - rate * step) > loss(theta):
            rate /= 2
        theta = theta - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return float(theta[0] / scale), float(theta[1])


def fit_steps(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and levels of the rising step function nearest to ``y`` (pooled neighbours), each level drawn a little to the mean."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weight * y, weight * x
    for i in order.tolist():
        pools.append([weight[i], weight[i] * y[i], weight[i] * x[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    mean = float((weight * y).sum() / weight.sum())
    unit = float(weight.mean())
    centres = np.array([p[2] / p[0] for p in pools])
    return centres, np.maximum.accumulate([(p[1] + unit * mean) / (p[0] + unit) for p in pools])


def train(docs: DataFrame, labels: DataFrame, per_label: int = 3_000, dictionary_bytes: int = 112_640, sample_bytes: int = 6_000_000) -> Model:
    """Dictionaries and calibration from ``labels`` (doc_id, quality 0 or 1); labels of other values don't count.

    Two bounded samples are this operator's parameters: about ``per_label`` labelled documents of
    each label (by a hash of the id; they join the documents as a broadcast of that size), and of
    the blocks of their whole texts about ``sample_bytes`` of each label, which the driver builds
    the dictionaries from. The sample is measured in FOLDS parts, each with dictionaries from the
    others, to calibrate; each label weighs by its share among all labels. A doc_id with both
    labels counts as 0.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.col("quality").cast("int")).alias("quality")
    )
    n = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = np.zeros(0)
    if len(n) < 2:
        return Model(b"", b"", 0.0, 0.0 if not n else (4.0 if 1 in n else -4.0), nothing, nothing)
    chosen = known.where(
        (F.col("quality") == 0) & share("doc_id", per_label, n[0]) | (F.col("quality") == 1) & share("doc_id", per_label, n[1])
    )
    fold = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(FOLDS)).cast("int")
    sample = stored(id_texts(docs).where("doc_id is not null").join(F.broadcast(chosen), "doc_id").select("quality", fold.alias("fold"), "text"), "quality-sample")

    def cut(batches):
        for part in slices(batches):
            rows = [(y, f, b) for y, f, t in zip(*(part.column(c).to_pylist() for c in ("quality", "fold", "text"))) for b in blocks(t)]
            yield batch_of(PIECES, *(zip(*rows) if rows else [[]] * 3))

    pieces = stored(sample.mapInArrow(cut, "quality int, fold int, block binary"), "quality-blocks")
    size = {r.quality: r.n for r in pieces.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    near = F.lit(False)
    for label, count in size.items():
        near = near | (F.col("quality") == label) & share("block", sample_bytes // BLOCK, count)
    some = [(r.quality, r.fold, bytes(r.block)) for r in pieces.where(near).collect()]

    def dictionaries(without: int | None) -> tuple[bytes, bytes]:
        return tuple(_dictionary(sorted(b for y, f, b in some if y == label and f != without), dictionary_bytes) for label in (1, 0))

    held = spark.sparkContext.broadcast([dictionaries(f) for f in range(FOLDS)])

    def differ(batches):
        each = [Compressors(*d) for d in held.value]
        for part in slices(batches):
            found = [each[f].difference(t) for f, t in zip(part.column("fold").to_pylist(), part.column("text").to_pylist())]
            yield batch_of(POINTS, part.column("quality"), found)

    points = sample.mapInArrow(differ, "quality int, x double").collect()
    good, bad = dictionaries(None)
    y = np.array([p.quality for p in points], float)
    if len(set(y)) < 2:
        return Model(good, bad, 0.0, math.log((n[1] + 1) / (n[0] + 1)), nothing, nothing)
    each = {v: n[v] / (y == v).sum() for v in (0, 1)}
    weight = np.array([each[int(v)] for v in y])
    weight *= len(y) / weight.sum()
    x = np.array([p.x for p in points])
    return Model(good, bad, *fit_logistic(x, y, weight), *fit_steps(x, y, weight))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; with too little text for its training, the text itself."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@functools.lru_cache(maxsize=1)
def _compressors(held) -> Compressors:
    return Compressors(held.value.good, held.value.bad)


def _scores(held, texts: list[str | None]) -> np.ndarray:
    c = _compressors(held)
    return held.value.scores(np.array([c.difference(t) for t in texts], float))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (calibrated probability of label 1) of every whole text; map-only, the model (two dictionaries) is broadcast.

    A null or empty text has difference 0 and gets the curve's value there. Repeated rows each get
    a row; columns other than doc_id and text are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches):
            yield batch_of(OUT, part.column("doc_id"), _scores(held, part.column("text").to_pylist()))

    return id_texts(docs).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """Rows of ``docs`` with a score of ``least`` or more; all columns stay."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, lambda: lambda texts: (_scores(held, texts) >= least).tolist())
