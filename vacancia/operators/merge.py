"""Upserts without a table format: pure DataFrame merges and partition rewrites."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancia.schemas import extended
from vacancia.session import drop_folder, shuffles_dropped, work_dir


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Spark keeps one row per key and map task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salt: int = 32, rank: str | None = None) -> DataFrame:
    """The first n rows per key, for any n, without sorting a whole key in one task.

    Rows compete inside salted slices first; only each slice's first n meet per key. ``rank`` names
    a column for a row's place in its key, from 1.
    """
    slice_of = F.pmod(F.xxhash64(*order), F.lit(salt)).cast("int")
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", slice_of).withColumn("_rn", F.row_number().over(local)).filter(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(final)).filter(F.col("_rn") <= n).drop("_slice")
        .withColumnRenamed("_rn", rank or "_rn").drop(*[] if rank else ["_rn"])
    )


def last_per_key(df: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in arrival])


@dataclass(frozen=True)
class Side:
    """Columns of one side of a merge, by their plain names."""

    prefix: str

    def __getitem__(self, name: str) -> Column:
        return F.col(self.prefix + name)

    @property
    def absent(self) -> Column:
        return F.col(self.prefix + "_here").isNull()

    def of(self, df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
        return df.select(
            *keys, *[F.col(c).alias(self.prefix + c) for c in names], F.lit(True).alias(self.prefix + "_here")
        )


def merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    matched: Callable[[Side, Side], dict[str, Column]],
    missing: Callable[[Side], dict[str, Column]] | None = None,
) -> DataFrame:
    """Full-outer merge on unique keys.

    ``matched(t, b)`` gives the changed columns of a row present on both sides,
    ``missing(b)`` the columns of a new row that differ from the batch's own.
    """
    t, b = Side("_t_"), Side("_b_")
    columns = [c for c in target.columns if c not in keys]
    b_columns = [c for c in batch.columns if c not in keys]
    both = t.of(target, keys, columns).join(b.of(batch, keys, b_columns), list(keys), "full_outer")
    changed = matched(t, b)
    added = missing(b) if missing else {}
    types = {f.name: f.dataType for f in target.schema.fields}

    def new_value(name: str) -> Column:
        if name in added:
            return added[name]
        return b[name] if name in b_columns else F.lit(None)

    out = []
    for name in columns:
        if name not in changed and name not in b_columns and name not in added:
            out.append(t[name].alias(name))
            continue
        value = (
            F.when(b.absent, t[name])
            .when(t.absent, new_value(name).cast(types[name]))
            .otherwise(changed[name].cast(types[name]) if name in changed else t[name])
        )
        out.append(value.alias(name))
    return both.select(*keys, *out)


def upsert_last_wins(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], arrival: Sequence[str],
    loaded_at: Column, stamp: str = "loaded_at",
) -> DataFrame:
    """The batch's last row per key overwrites; an existing row keeps its load stamp."""
    one = last_per_key(batch, keys, arrival)
    names = [c for c in target.columns if c not in (*keys, stamp)]
    return merge(
        target, one, keys,
        matched=lambda t, b: {c: b[c] for c in names if c in batch.columns},
        missing=lambda b: {stamp: loaded_at} if stamp in target.columns else {},
    )


def upsert_newest_wins(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str, arrival: Sequence[str],
    loaded_at: Column, stamp: str = "loaded_at",
) -> DataFrame:
    """Overwrite only with a version at least as new; the load stamp then moves too."""
    one = last_per_key(batch, keys, [version, *arrival])
    names = [c for c in target.columns if c not in (*keys, stamp) and c in batch.columns]

    def matched(t: Side, b: Side) -> dict[str, Column]:
        newer = t[version] <= b[version]
        out = {c: F.when(newer, b[c]).otherwise(t[c]) for c in names}
        if stamp in target.columns:
            out[stamp] = F.when(newer, loaded_at).otherwise(t[stamp])
        return out

    return merge(
        target, one, keys, matched,
        missing=lambda b: {stamp: loaded_at} if stamp in target.columns else {},
    )


def merge_delete_insert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows whose keys arrive again, then add all incoming rows."""
    return target.join(incoming.select(*keys), list(keys), "left_anti").unionByName(incoming)


def drift_upsert(log: DataFrame, entries: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """Count unmapped values once per run; a resolved value that returns is a regression."""
    keys = ["dimension", "raw_value", "source"]
    batch = entries.select(*keys).distinct().withColumn("run_id", F.lit(run_id))
    return merge(
        log, batch, keys,
        matched=lambda t, b: {
            "run_id": b["run_id"],
            "frequency": t["frequency"] + 1,
            "last_seen_at": as_of,
            "status": F.when(t["status"] == "resolved", "regression").otherwise(t["status"]),
        },
        missing=lambda b: {
            "frequency": F.lit(1), "first_seen_at": as_of, "last_seen_at": as_of, "status": F.lit("new"),
        },
    )


# ------------------------------------------------------------------ stored tables

def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)



def _only_partitions(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Read only the partitions the batch touches.

    The partition values (board, bucket or day; never row data) become literals,
    so pruning does not depend on a join strategy. There are at most as many as
    the stored table has partitions.
    """
    return stored.filter(_among(touched.columns, touched.distinct().collect()))


def _among(names: Sequence[str], rows: Sequence[tuple]) -> Column:
    """Whether a row's one or two columns hold one of these values."""
    if len(names) == 1:
        return F.col(names[0]).isin([r[0] for r in rows])
    by_first: dict = {}
    for first, second in rows:
        by_first.setdefault(first, []).append(second)
    keep = F.lit(False)
    for first, seconds in by_first.items():
        keep = keep | ((F.col(names[0]) == first) & F.col(names[1]).isin(seconds))
    return keep


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _held(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and folders below a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
    return held.getLength(), held.getDirectoryCount()


#: Bytes of stored rows that one round of a merge shuffles.
ROUND_BYTES = 128 << 20


def merge_in_rounds(
    spark: SparkSession, path: str, batch: DataFrame, key: str, by: str, schema,
    merge_fn: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, round_bytes: int = ROUND_BYTES,
) -> None:
    """merge_into_buckets with bounded shuffles: the batch is staged, and touched partitions are merged some at a time.

    A key lies in one partition, so the rounds do not depend on each other. Each has about ``round_bytes`` of the batch and
    the table, a partition at least, and its shuffle files are gone before the next.
    """
    staged = work_dir(spark, "merge-batch")
    part = [by, "bucket"]
    with shuffles_dropped(spark):
        batch.withColumn("bucket", bucket_of(F.col(key), buckets)).write.partitionBy(by).parquet(staged)
    rows = spark.read.schema(extended(batch.schema, "bucket", "int")).parquet(staged)
    total, turns = _held(spark, staged)[0], [rows]
    kept, folders = _held(spark, path) if exists(spark, path) else (0, 1)
    if total + kept > round_bytes:
        touched = sorted(tuple(r) for r in rows.select(*part).distinct().collect())
        # Of the table, the share of the touched partitions.
        rounds = -(-(total + kept * min(1, len(touched) / folders)) // round_bytes)
        size = max(1, int(len(touched) // rounds))
        turns = [rows.filter(_among(part, touched[i:i + size])) for i in range(0, len(touched), size)] or turns
    for turn in turns:
        with shuffles_dropped(spark):
            merge_into_buckets(spark, path, turn.select(*batch.columns), key, by, schema, merge_fn, buckets)
    drop_folder(spark, staged)


def merge_into_buckets(
    spark: SparkSession, path: str, batch: DataFrame, key: str, by: str, schema,
    merge_fn: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64,
) -> None:
    """Upsert into parquet laid out by (by, bucket of key), rewriting touched partitions only.

    The rewrite uses dynamic partition overwrite, which moves finished files in
    at commit, so a lost executor only repeats its task.
    """
    batch = batch.withColumn("bucket", bucket_of(F.col(key), buckets))
    part = [by, "bucket"]
    if exists(spark, path):
        stored = spark.read.schema(extended(schema, "bucket", "int")).parquet(path)
        target = _only_partitions(stored, batch.select(*part)).select(*schema.names)
    else:
        target = spark.createDataFrame([], schema)
    merged = merge_fn(target, batch.drop("bucket")).withColumn("bucket", bucket_of(F.col(key), buckets))
    # Rebalancing gathers each stored partition in few files and splits an oversized one.
    (
        merged.hint("rebalance", *part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*part).parquet(path)
    )


def rewrite_partition(df: DataFrame, path: str, partition: str) -> None:
    """Replace only the partitions present in df."""
    (
        df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition).parquet(path)
    )


def merge_snapshot_into(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], partition: str) -> None:
    """merge_delete_insert on a stored table: reads and rewrites the incoming days only."""
    if exists(spark, path):
        stored = _only_partitions(spark.read.parquet(path), incoming.select(partition)).select(*incoming.columns)
        incoming = merge_delete_insert(stored, incoming, keys)
    rewrite_partition(incoming, path, partition)
