"""The URL frontier as a stored table: seeding, claims and outcomes that may be repeated after a crash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vacancia.operators import frontier as fr
from vacancia.operators import listing
from vacancia.operators.merge import exists, merge_into_buckets
from vacancia.schemas import FRONTIER, extended
from vacancia.session import work_dir
from vacancia.sources import readers

SCHEMA = extended(FRONTIER, "claim_token")


class FrontierStore:
    """A frontier laid out by (board, bucket of the job id). Every step rewrites the touched parts only.

    Each step gives the same table when it is repeated with the same input: an upsert keeps finished
    and running rows, a claim is first written down under its token and then marked, and an
    outcome sets what it says.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.path = f"{self.root}/frontier"

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(extended(SCHEMA, "bucket", "int")).parquet(self.path).select(*SCHEMA.names)

    def _merge(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        merge_into_buckets(self.spark, self.path, batch, "job_id", "source", SCHEMA, lambda stored, rows: change(stored, rows).select(*SCHEMA.names), self.buckets)

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        path = work_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def enqueue(self, items: DataFrame, as_of: Column, arrival: str = "ordinal") -> None:
        """Inserts (source, job_id, url); rows that succeeded or are running keep their status, the others wait again."""
        self._merge(items, lambda stored, rows: fr.frontier_upsert(stored, rows, as_of, arrival))

    def seed_from_listings(self, prefix: str, as_of: Column, source: str = "vietnamworks", one_per_object: bool = True) -> dict[str, int]:
        """Listing responses below a prefix to pending rows; of a job listed several times the last URL stays.

        One pass reads the responses, counts and stages the links; returns the counters scanned_files,
        enqueued (distinct jobs), skipped (no id or alias) and rejected_url.
        """
        records = readers.scan_listing_json(self.spark, prefix, one_per_object)
        routed = listing.route_listing_records(records)
        seen = Observation()

        def n(route: str) -> Column:
            return F.count_if(F.col("route") == route).alias(route)

        links = routed.observe(seen, n("skipped"), n("rejected_url")).filter("route = 'enqueue'").select(
            F.lit(source).alias("source"), "job_id", "url", F.struct("object_key", "position", "url").alias("ordinal")
        )
        links = self._staged(links, "listing-links")
        self.enqueue(links, as_of)
        jobs = links.select("job_id").distinct().count()
        return {"scanned_files": readers.count_objects(self.spark, prefix), "enqueued": jobs, "skipped": seen.get["skipped"], "rejected_url": seen.get["rejected_url"]}

    def claim(self, n: int, as_of: Column, token: str, source: str | None = None) -> DataFrame:
        """The oldest n pending rows of each source become in_progress for the holder of ``token``; returns them as stored.

        The keys are written down before any row changes. A claim repeated with its token, finished
        or not, marks what is still to be marked and returns the same rows, those that have an
        outcome by now or went back to the queue left out.
        """
        noted = f"{self.root}/claims/{token}"
        if not exists(self.spark, f"{noted}/_SUCCESS"):
            fr.oldest_pending(self.rows(), n, source).write.mode("overwrite").parquet(noted)
        keys = self.spark.read.schema("source string, job_id string").parquet(noted)
        self._merge(keys, lambda stored, rows: fr.mark_claimed(stored, rows, as_of, token))
        # A copy: the frontier's files are replaced by the next step.
        return self._staged(self.rows().filter((F.col("claim_token") == token) & (F.col("status") == "in_progress")), "claimed")

    def finish(self, outcomes: DataFrame, as_of: Column, arrival: str | None = None) -> None:
        """Applies outcomes (see ``frontier.apply_outcomes``); those of jobs that are not there change nothing."""
        self._merge(outcomes, lambda stored, rows: fr.apply_outcomes(stored, rows, as_of, arrival))
