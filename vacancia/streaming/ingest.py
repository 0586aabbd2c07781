"""Continuous load of parsed records: file stream to the merged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia.operators.validate import split_valid_rejected
from vacancia.plans.loader import merge_jobs
from vacancia.schemas import PARSED_RECORD, extended
from vacancia.session import drop_folder, work_dir
from vacancia.sources.readers import JSON_FILES
from vacancia.sources.writers import reject_rows


def stream_records(
    spark: SparkSession, prefix: str, files_per_trigger: int | None = None, one_per_object: bool = True,
) -> DataFrame:
    reader = (
        spark.readStream.schema(extended(PARSED_RECORD, "_corrupt")).option("multiLine", one_per_object)
        .option("columnNameOfCorruptRecord", "_corrupt").option("pathGlobFilter", JSON_FILES)
        .option("recursiveFileLookup", True)
    )
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(prefix).withColumn("object_key", F.col("_metadata.file_path"))


def stream_ingest(
    spark: SparkSession, prefix: str, target: str, rejects: str, checkpoint: str, as_of: Column,
    buckets: int = 64, files_per_trigger: int | None = 10_000, one_per_object: bool = True,
):
    """Start a run over everything new, ``files_per_trigger`` objects a batch; the checkpoint replaces a since-date.

    A batch may run twice after a failure. The merge takes only versions at
    least as new, and rejects are stored per batch id and replaced as a whole,
    so a second run changes nothing.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        # Both sides of the split read the batch; it is staged for the length of this call.
        session = batch.sparkSession
        staged = work_dir(session, "stream-batch")
        batch.write.parquet(staged)
        try:
            split = split_valid_rejected(session.read.schema(batch.schema).parquet(staged))
            merge_jobs(session, target, split.valid, ["object_key"], as_of, buckets, newest_wins=True)
            (
                reject_rows(split.rejected, as_of).withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejects)
            )
        finally:
            drop_folder(session, staged)

    return (
        stream_records(spark, prefix, files_per_trigger, one_per_object).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
