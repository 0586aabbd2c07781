"""Load job: archived records to the warehouse table and the quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vacancia.operators import extract, merge, validate
from vacancia.schemas import JOB_TABLE, KEY, LEDGER, PARSED_RECORD
from vacancia.session import shuffles_dropped, stored
from vacancia.sources import readers, writers


def load_job_detail(
    spark: SparkSession, prefix: str, target: str, rejects: str | None, as_of: Column,
    since: dt.datetime | None = None, dry_run: bool = False, validate_payload: bool = True, buckets: int = 64,
    load_id: str | None = None,
) -> DataFrame:
    """Scan, route, merge (last payload wins) and quarantine. Returns one row of counters.

    A load that is repeated under its ``load_id`` leaves one copy of its rejects.
    """
    routed = validate.with_outcome(readers.scan_parsed_json(spark, prefix, since), validate_payload)
    skipped = readers.count_skipped(spark, prefix, since)
    if dry_run:
        return validate.outcome_counters(routed, skipped)
    # The archive is many small objects: read it once, route from the staged copy.
    routed = stored(routed, "routed")
    split = validate.split_routed(routed)
    merge_jobs(spark, target, split.valid, ["object_key"], as_of, buckets)
    if rejects is not None:
        writers.sink_rejects(split.rejected, rejects, as_of, load_id)
    return validate.outcome_counters(routed, skipped)


def merge_jobs(
    spark: SparkSession, target: str, valid: DataFrame, arrival: list[str], as_of: Column,
    buckets: int = 64, newest_wins: bool = False,
) -> None:
    """Upsert valid records into the bucketed table."""
    batch = validate.coerce_record(valid, keep=[c for c in arrival if c not in JOB_TABLE.names])
    # Versions that arrive together are told apart by what they say, so that a repeated load picks the same one.
    batch = batch.withColumn("_tie", F.xxhash64(*batch.columns))
    order = [*arrival, "_tie"]

    def upsert(stored: DataFrame, rows: DataFrame) -> DataFrame:
        if newest_wins:
            return merge.upsert_newest_wins(stored, rows, KEY, "parsed_at", order, as_of)
        return merge.upsert_last_wins(stored, rows, KEY, order, as_of)

    merge.merge_in_rounds(spark, target, batch, "source_job_id", "source", JOB_TABLE, upsert, buckets)


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once; what follows reads it back."""
    return stored(df, name)


#: How each board's archived pages become records.
PARSERS = {
    "itviec": extract.jobposting_itviec, "topcv": extract.jobposting_topcv, "careerviet": extract.jobposting_careerviet,
    "linkedin": extract.jobposting_linkedin, "vietnamworks": extract.vnw_record_map,
}


def parse_and_load_batch(
    spark: SparkSession, pages: dict[str, DataFrame], target: str, as_of: Column, buckets: int = 64,
) -> dict[str, int]:
    """Pages of several boards (board -> key, arrival, html or main_json) to the stored table, rejects counted but not kept.

    Parsing, validation, counting and staging are one pass over the pages; of a job that comes
    several times the last arrival stays. Returns parsed, valid, rejected, and loaded: the jobs of
    the batch that the table holds afterwards.
    """
    records = None
    for board, rows in pages.items():
        found = PARSERS[board](rows, as_of).filter("not failed").drop("failed")
        records = found if records is None else records.unionByName(found)
    seen = Observation()

    def n(outcome: str, name: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(name)

    routed = validate.with_outcome(records).observe(seen, F.count(F.lit(1)).alias("parsed"), n("loaded", "valid"), n("rejected", "rejected"))
    batch = _staged(validate.split_routed(routed).valid, "parsed-batch")
    merge_jobs(spark, target, batch, ["arrival"], as_of, buckets)
    stored = spark.read.schema(JOB_TABLE).parquet(target).select(*KEY)
    return seen.get | {"loaded": stored.join(batch.select(*KEY), KEY, "left_semi").count()}


# ------------------------------------------------------------------ quarantine

def replay_rejects(rejects: DataFrame, rule: Column | None = None) -> validate.Split:
    """Validate quarantined payloads again, newest payload per job, under the given rule."""
    return validate.split_routed(_routed_again(rejects, rule))


def _routed_again(rejects: DataFrame, rule: Column | None, keep: tuple[str, ...] = ("object_key",)) -> DataFrame:
    newest = merge.first_per_key(rejects, KEY, [F.col("rejected_at").desc(), F.col("payload").desc()])
    records = newest.select(F.from_json("payload", PARSED_RECORD).alias("r"), *keep).select("r.*", *keep)
    return validate.with_outcome(records, rule=rule)


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    if not merge.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def open_rejects(spark: SparkSession, rejects: DataFrame, ledger: str) -> DataFrame:
    """Quarantine rows that no replay has settled, with the hash of their payload."""
    hashed = rejects.withColumn("payload_hash", F.sha2("payload", 256))
    return hashed.join(_ledger(spark, ledger), ["payload_hash", *KEY], "left_anti")


def promote_rejects(
    spark: SparkSession, rejects: DataFrame, target: str, ledger: str, replay_id: str, as_of: Column,
    rule: Column | None = None, buckets: int = 64,
) -> dict[str, int]:
    """Validates the open quarantine again, newest payload a job, and merges what passes into the stored table.

    The quarantine stays as it is. A ledger notes each payload that was promoted, and the older
    payloads of the same job as superseded, so no later replay takes them. Rows are marked after they
    are merged, and the merge keeps a stored version that is newer: a replay that died in between
    may run again. Returns examined, promoted, kept (still open) and superseded.
    """
    opened = open_rejects(spark, rejects, ledger)
    routed = _staged(_routed_again(opened, rule, ("object_key", "payload_hash", "rejected_at")), "replay")
    valid = routed.filter("outcome = 'loaded'")
    merge_jobs(spark, target, valid, ["rejected_at"], as_of, buckets, newest_wins=True)
    seen = Observation()
    passed = valid.select(*KEY, F.col("payload_hash").alias("_passed"))
    promoted = F.col("payload_hash") == F.col("_passed")
    marks = opened.select("payload_hash", *KEY).distinct().join(passed, KEY).select(
        "payload_hash", *KEY, F.when(promoted, "promoted").otherwise("superseded").alias("state"),
        as_of.alias("settled_at"), F.lit(replay_id).alias("replay_id"),
    )
    with shuffles_dropped(spark):
        marks.observe(
            seen, F.count_if(F.col("state") == "promoted").alias("promoted"), F.count_if(F.col("state") == "superseded").alias("superseded")
        ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("replay_id").parquet(ledger)
    examined = routed.count()
    return {"examined": examined, "promoted": seen.get["promoted"], "kept": examined - seen.get["promoted"], "superseded": seen.get["superseded"]}
