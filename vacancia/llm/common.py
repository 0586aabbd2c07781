"""Helpers the document operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.session import work_dir

#: Rows a task holds as Python objects at a time.
ROWS = 256
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for an application: their Python workers import it by name."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "vacancia"), "zip", root, "vacancia")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def id_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever other columns there are."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a lost executor costs no recomputation."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def keep_rows(docs: DataFrame, decide: Callable[[], Callable[[list], list[bool]]]) -> DataFrame:
    """Rows of ``docs``, all columns, whose text ``decide()`` (called once per task) keeps. Map-only."""

    def run(batches):
        keeps = decide()
        for part in slices(batches):
            yield part.filter(pa.array(keeps(part.column("text").to_pylist()), pa.bool_()))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def fold(column: str, n: int):
    """crc32 of the id as text, modulo ``n``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def share(column: str, bound: int, rows: int):
    """Condition that is true for about ``bound`` of ``rows`` rows (all, if there are fewer), by a hash of ``column``."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(column, F.lit("share")), F.lit(1 << 40)) < int(bound / rows * (1 << 40))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, in UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their summed counts."""
    k = np.concatenate(keys)
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
    return k[first], np.add.reduceat(np.concatenate(counts)[order], first, dtype=np.int64)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
