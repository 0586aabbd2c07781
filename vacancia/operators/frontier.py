"""URL frontier: seeding, batch claims, outcomes, sweeps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.operators.merge import first_n_per_key, last_per_key, merge

KEY = ["source", "job_id"]


def frontier_upsert(frontier: DataFrame, items: DataFrame, as_of: Column, arrival: str = "ordinal") -> DataFrame:
    """Enqueue (source, job_id, url): finished and running rows keep their status, the url moves."""
    batch = last_per_key(items, KEY, [arrival]).select(*KEY, "url")
    return merge(
        frontier, batch, KEY,
        matched=lambda t, b: {
            "url": b["url"],
            "status": F.when(t["status"].isin("success", "in_progress"), t["status"]).otherwise("pending"),
        },
        missing=lambda b: {"status": F.lit("pending"), "first_seen_at": as_of, "retry_count": F.lit(0)},
    )


def fresh_rows(frontier: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Fetched successfully within the last days."""
    since = as_of - F.make_dt_interval(F.lit(days))
    return frontier.filter((F.col("status") == "success") & (F.col("crawled_at") >= since))


def not_fresh(items: DataFrame, frontier: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Items worth enqueueing one by one: those without a fresh success."""
    return items.join(fresh_rows(frontier, as_of, days).select(*KEY), KEY, "left_anti")


def oldest_pending(frontier: DataFrame, n: int, source: str | None = None) -> DataFrame:
    """Keys of the oldest n pending rows of each source, by (first_seen_at, job_id); a missing first_seen_at sorts last.

    Counts per source and hour find the hour in which the n-th row lies: earlier hours are taken
    whole, and only that hour's rows are ranked.
    """
    pending = frontier.filter(F.col("status") == "pending")
    if source is not None:
        pending = pending.filter(F.col("source") == source)
    hour = F.coalesce(F.floor(F.unix_seconds("first_seen_at") / 3600), F.lit(2**62))
    aged = pending.select(*KEY, "first_seen_at", hour.alias("_hour"))
    counted = aged.groupBy("source", "_hour").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("_hour")) - F.col("_n")
    hours = counted.withColumn("_room", n - before).filter("_room > 0").select("source", "_hour", "_room", (F.col("_n") <= F.col("_room")).alias("_whole"))
    near = aged.join(hours, ["source", "_hour"])
    ranked = first_n_per_key(near.filter("not _whole"), ["source"], ["first_seen_at", "job_id"], n, rank="_rank")
    return near.filter("_whole").select(*KEY).unionByName(ranked.filter("_rank <= _room").select(*KEY))


def mark_claimed(frontier: DataFrame, keys: DataFrame, as_of: Column, token: str | None = None) -> DataFrame:
    """Pending rows among ``keys`` become in_progress; with a token, rows that carry it already stay as they are."""
    joined = frontier.join(keys.select(*KEY, F.lit(True).alias("_taken")), KEY, "left")
    hit = F.col("_taken").isNotNull() & (F.col("status") == "pending")
    if token is not None:
        hit = hit & ~F.col("claim_token").eqNullSafe(F.lit(token))
    changes = {"status": F.lit("in_progress"), "last_attempt_at": as_of, "retry_count": F.col("retry_count") + 1}
    if token is not None:
        changes["claim_token"] = F.lit(token)
    return joined.select(*[(F.when(hit, changes[c]).otherwise(F.col(c)) if c in changes else F.col(c)).alias(c) for c in frontier.columns])


def claim(frontier: DataFrame, n: int, as_of: Column, source: str | None = None) -> DataFrame:
    """Oldest n pending rows of each source become in_progress."""
    return mark_claimed(frontier, oldest_pending(frontier, n, source), as_of)


def apply_outcomes(frontier: DataFrame, outcomes: DataFrame, as_of: Column, arrival: str | None = None) -> DataFrame:
    """Apply (source, job_id, outcome, http_status, error, raw_object_key, run_id) rows.

    Several outcomes of one key count as if applied one after another in the order of the
    ``arrival`` column (ties, and all rows without it, by their values), reduced to one row a key
    before the join.
    """
    kind = F.col("outcome")
    done, failed, gone = kind == "success", kind == "failed", kind == "expired"
    values = ["outcome", "http_status", "error", "raw_object_key", "run_id"]
    order = F.struct(*([arrival] if arrival else []), *values)

    def last(value: Column, when: Column) -> Column:
        """Boxed value of the last outcome for which ``when`` holds; null if there is none."""
        return F.max_by(F.struct(value.alias("v")), F.when(when, order))

    o = outcomes.groupBy(*KEY).agg(
        last(kind, kind.isNotNull()).alias("_outcome"),
        last(F.when(gone, 404).otherwise(F.col("http_status")), done | failed | gone).alias("_http"),
        last(F.when(failed, F.substring("error", 1, 1000)), done | failed).alias("_error"),
        last(F.col("raw_object_key"), done).alias("_obj"), last(F.col("run_id"), done).alias("_run"),
        F.bool_or(F.coalesce(done | gone, F.lit(False))).alias("_closed"),
    )
    rules = {
        "status": F.coalesce("_outcome.v", "status"),
        "http_status": F.when(F.col("_http").isNotNull(), F.col("_http.v")).otherwise(F.col("http_status")),
        "error_message": F.when(F.col("_error").isNotNull(), F.col("_error.v")).otherwise(F.col("error_message")),
        "raw_object_key": F.when(F.col("_obj").isNotNull(), F.col("_obj.v")).otherwise(F.col("raw_object_key")),
        "crawl_run_id": F.when(F.col("_run").isNotNull(), F.col("_run.v")).otherwise(F.col("crawl_run_id")),
        "crawled_at": F.when(F.col("_closed"), as_of).otherwise(F.col("crawled_at")),
    }
    joined = frontier.join(o, KEY, "left")
    return joined.select(*[rules.get(c, F.col(c)).alias(c) for c in frontier.columns])


def is_stale_claim(as_of: Column, minutes: int = 120) -> Column:
    limit = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return (F.col("status") == "in_progress") & (F.col("last_attempt_at") < limit)


def requeue_stale(frontier: DataFrame, as_of: Column, minutes: int = 120, source: str | None = None) -> DataFrame:
    """Claims nobody resolved go back to pending."""
    stale = is_stale_claim(as_of, minutes)
    if source is not None:
        stale = stale & (F.col("source") == source)
    return frontier.withColumn("status", F.when(stale, "pending").otherwise(F.col("status")))


def stats(frontier: DataFrame, source: str | None = None) -> DataFrame:
    rows = frontier if source is None else frontier.filter(F.col("source") == source)
    return rows.groupBy("status").agg(F.count("*").alias("n"))
