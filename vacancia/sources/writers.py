"""Sinks: parsed records, quarantine, archive, publishing."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.schemas import REJECTS
from vacancia.session import shuffles_dropped


#: Gzipped lines are read as one piece, so a file holds so many at most.
LINES_PER_FILE = 250_000


def sink_parsed_json(records: DataFrame, path: str) -> None:
    """Parsed records as gzipped JSON lines, one folder per board; the board also stays inside each document."""
    with shuffles_dropped(records.sparkSession):
        (
            records.withColumn("board", F.col("source")).write.mode("append").partitionBy("board").option("ignoreNullFields", False)
            .option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).json(path)
        )


def reject_rows(rejected: DataFrame, as_of: Column) -> DataFrame:
    """Quarantine rows: the whole record as JSON payload beside reason and detail."""
    extra = {"reject_reason", "reject_detail", "object_key", "_corrupt"}
    payload = [c for c in rejected.columns if c not in extra]
    key = F.col("object_key") if "object_key" in rejected.columns else F.lit(None).cast("string")
    return rejected.select(
        "source", "source_job_id", key.alias("object_key"), "parser_version", "reject_reason", "reject_detail",
        F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("payload"),
        as_of.alias("rejected_at"),
    ).select(*REJECTS.names)


def sink_rejects(rejected: DataFrame, path: str, as_of: Column, load_id: str | None = None) -> None:
    """Append only; nothing is ever updated. With a ``load_id`` a load that is repeated under it replaces its own rows."""
    rows = reject_rows(rejected, as_of)
    if load_id is None:
        rows.write.mode("append").parquet(path)
        return
    rows.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path)


def text_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ])


def _write_counted(df: DataFrame, path: str, **options: str) -> int:
    """Replaces the folder by ``df``; returns its rows, counted by the pass that writes them."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").options(**options).parquet(path)
    return seen.get["n"]


def archive_parquet_zstd(tables: dict[str, DataFrame], path: str, at_once: int = 4) -> DataFrame:
    """Write every table as zstd parquet, a few at once; returns (table_name, n_rows) as they were written."""
    def put(item: tuple[str, DataFrame]) -> tuple[str, int]:
        name, df = item
        return name, _write_counted(text_columns(df), f"{path}/{name}", compression="zstd")

    with ThreadPoolExecutor(at_once) as pool:
        counts = list(pool.map(put, tables.items()))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(counts, "table_name string, n_rows bigint")


# ------------------------------------------------------------------ publishing

# The objects the serving side reads.
PUBLISHED = [
    "fct_jobs_daily", "mart_company_hiring", "mart_salary_by_level", "mart_skill_demand",
    "job_features", "silver_job_detail", "silver_skill_long",
]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish_swap(spark: SparkSession, objects: dict[str, DataFrame | None], target: str, at_once: int = 4) -> DataFrame:
    """Publish each object, a few at once: load a staging folder, then swap it in.

    Readers see the old copy until the rename. A missing source keeps the old
    copy. A changed column set needs no special path: the staged files carry the
    source's own types. Returns (object, rows, seconds, missing, rebuilt).
    Between the two renames a reader may find no folder; a crash there leaves
    the previous copy under ``<name>__old``.
    """
    def put(item: tuple[str, DataFrame | None]) -> tuple:
        name, df = item
        start = time.time()
        if df is None:
            return name, 0, 0.0, True, False
        live, staging, old = (f"{target}/{name}{s}" for s in ("", "__staging", "__old"))
        rows = _write_counted(df, staging)
        fs, live_p = _fs(spark, live)
        had = fs.exists(live_p)
        rebuilt = had and set(spark.read.parquet(live).columns) != set(df.columns)
        old_p = _fs(spark, old)[1]
        if fs.exists(old_p):
            fs.delete(old_p, True)
        if had:
            fs.rename(live_p, old_p)
        fs.rename(_fs(spark, staging)[1], live_p)
        if had:
            fs.delete(old_p, True)
        return name, rows, round(time.time() - start, 2), False, rebuilt

    with ThreadPoolExecutor(at_once) as pool:
        report = list(pool.map(put, objects.items()))
    return spark.createDataFrame(
        report, "object string, rows bigint, seconds double, missing boolean, rebuilt boolean"
    )


# ------------------------------------------------------------------ retention

def gfs_retention(
    keys: DataFrame, today: Column, daily_days: int = 14, weekly_weeks: int = 8, monthly_months: int = 12,
    min_keep: int = 0,
) -> DataFrame:
    """Decide (key, kept_as) for archive keys; kept_as NULL means the key may go.

    The date comes from the key. The newest min_keep keys and keys without a
    date always stay.
    """
    day = F.try_to_date(F.nullif(F.regexp_extract("key", r"/(\d{4}-\d{2}-\d{2})/", 1), F.lit("")))
    age = F.datediff(today, F.col("_day"))
    tier = (
        F.when(age < daily_days, "daily")
        .when((F.weekday("_day") == 6) & (age < weekly_weeks * 7), "weekly")
        .when((F.dayofmonth("_day") == 1) & (age < monthly_months * 31), "monthly")
    )
    floor = keys.select("key").orderBy(F.desc("key")).limit(min_keep).withColumn("_floor", F.lit(True))
    return (
        keys.withColumn("_day", day).join(floor, "key", "left")
        .withColumn(
            "kept_as",
            F.when(F.col("_floor"), "floor").when(F.col("_day").isNull(), "undated").otherwise(tier),
        )
        .drop("_day", "_floor")
    )
