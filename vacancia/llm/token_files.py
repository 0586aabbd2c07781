"""Token-id files: whole documents in ascending doc_id order, range-coded."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancia.llm import bpe, range_coder
from vacancia.llm.common import batch_of, id_texts, ship, slices
from vacancia.llm.range_coder import Coded

#: Ids after which a stream is closed, at the end of a document.
STREAM = 1 << 21
DDL = """part int, segment int, n_ids long, doc_ids array<long>, doc_lengths array<long>, table binary, payloads array<binary>, checksums array<long>"""
FORMAT = pa.schema([
    ("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64())),
    ("table", pa.binary()), ("payloads", pa.list_(pa.binary())), ("checksums", pa.list_(pa.int64())),
])
READ = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def write_ids(docs: DataFrame, target: str, path: str, end_id: int = 0) -> None:
    """Encodes every whole text, adds ``end_id`` and writes the coded streams to the folder ``target``.

    A file row is one stream of whole documents (part and segment give its place in doc_id order):
    document ids and lengths, the order-0 header, and blocks with their checksums. The
    documents are dealt by ranges of doc_id, so each task writes its own range. A null text is its
    end id alone; rows without doc_id come first; rows with equal doc_id follow one another by
    text; an empty table gives a folder without rows; other columns are not read.
    """

    def run(batches):
        part, segment = TaskContext.get().partitionId(), 0
        names: list = []
        held: list[np.ndarray] = []
        size, end = 0, np.array([end_id], "<u4")

        def close():
            coded = range_coder.encode(np.concatenate(held))
            return batch_of(
                FORMAT, [part], [segment], [coded.n_ids], [names], [[len(x) + 1 for x in held[::2]]], [coded.table], [coded.payloads], [coded.checksums]
            )

        for some in slices(batches):
            for doc_id, ids in zip(some.column("doc_id").to_pylist(), bpe.encode(path, some.column("text").to_pylist())):
                names.append(doc_id)
                held += [ids, end]
                size += len(ids) + 1
                if size >= STREAM:
                    yield close()
                    names, held, size, segment = [], [], 0, segment + 1
        if held:
            yield close()

    texts = id_texts(docs)
    texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, DDL).write.parquet(target)


def read_ids(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) from the files; each block is checked."""

    def run(batches):
        for row in slices(batches, 1):
            r = row.to_pylist()[0]
            ids = range_coder.decode(Coded(r["n_ids"], r["table"], r["payloads"], r["checksums"]))
            lengths = np.array(r["doc_lengths"], np.int64)
            ends = np.cumsum(lengths)
            data = ids.tobytes()
            for at in range(0, len(lengths), 1024):
                a, b = ends[at : at + 1024] - lengths[at : at + 1024], ends[at : at + 1024]
                yield batch_of(
                    READ, [r["part"]] * len(a), [r["segment"]] * len(a), r["doc_ids"][at : at + 1024], a, b - a,
                    [data[4 * x : 4 * y] for x, y in zip(a.tolist(), b.tolist())],
                )

    ship(spark)
    files = spark.read.schema(DDL).parquet(target)
    # Ids before each stream: sums by part (one row a task that wrote), then within the part.
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    starts = sizes.withColumn("own", F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")).join(parts, "part").select(
        "part", "segment", (F.col("first") + F.col("own")).alias("first")
    )
    found = files.mapInArrow(run, "part int, segment int, doc_id long, before long, n_tokens long, ids binary")
    return found.join(F.broadcast(starts), ["part", "segment"]).select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids")
