"""Audit, dashboard, health, daily and weekly reports. "Now" is an argument."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.functions.numeric import percent, round_half_even
from vacancia.operators.frontier import is_stale_claim
from vacancia.operators.quantiles import exact_percentiles

JOB = ["source", "source_job_id"]


def _days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def _hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


# ------------------------------------------------------------------ audit

def reject_summary_24h(rejects: DataFrame, as_of: Column) -> DataFrame:
    return rejects.filter(F.col("rejected_at") >= as_of - _hours(24)).groupBy("reject_reason").agg(F.count("*").alias("n"))


def reject_share_7d(rejects: DataFrame, as_of: Column) -> DataFrame:
    """Share of each reason. The window runs over the handful of reasons only."""
    counts = rejects.filter(F.col("rejected_at") >= as_of - _days(7)).groupBy("reject_reason").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("pct", percent(F.col("n"), total))


def reject_detail_top(rejects: DataFrame, reason: str = "OUT_OF_FOCUS", k: int = 10) -> DataFrame:
    return (
        rejects.filter(F.col("reject_reason") == reason).groupBy("reject_detail").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "reject_detail").limit(k)
    )


def rejected_but_clean_before(rejects: DataFrame, jobs: DataFrame) -> DataFrame:
    clean = jobs.select(*JOB, F.col("parsed_at").alias("last_clean_parse"))
    return rejects.join(clean, JOB).select("source_job_id", "reject_reason", "rejected_at", "last_clean_parse")


def coverage_unaccounted(frontier: DataFrame, jobs: DataFrame, rejects: DataFrame) -> DataFrame:
    """Crawled = loaded + rejected + unaccounted; rejects count jobs, not rows."""
    crawled = frontier.agg(F.count_if(F.col("status") == "success").alias("crawled"))
    loaded = jobs.agg(F.count("*")).scalar()
    rejected = rejects.select(*JOB).distinct().agg(F.count("*")).scalar()
    return crawled.select(
        "crawled", loaded.alias("loaded_clean"), rejected.alias("rejected"),
        (F.col("crawled") - loaded - rejected).alias("unaccounted"),
    )


# ------------------------------------------------------------------ dashboards

def kpis(jobs: DataFrame) -> DataFrame:
    return jobs.agg(
        F.count("*").alias("total_jobs"),
        F.countDistinct("company_id").alias("unique_companies"),
        F.count_if("is_salary_visible").alias("salary_visible"),
        percent(F.count_if("is_salary_visible"), F.count("*")).alias("salary_visible_pct"),
        F.count_if("is_expired").alias("expired_jobs"),
        F.max("parsed_at").alias("last_parse"),
    )


def in_function(words: list[str]) -> Column:
    """The board's own function name contains one of the words."""
    name = F.get_json_object(F.when(F.col("job_function").startswith("{"), F.col("job_function")), "$.children[0].name")
    hit = F.lit(False)
    for w in words:
        hit = hit | F.coalesce(name.ilike(f"%{w}%"), F.lit(False))
    return hit


def top_skills(jobs: DataFrame, words: list[str], k: int = 15) -> DataFrame:
    from vacancia.functions.jsontext import array_items

    rows = jobs.filter(in_function(words)).select(F.explode(array_items(F.col("skills"), "name string")).alias("s"))
    return (
        rows.groupBy(F.col("s.name").alias("skill_name")).agg(F.count("*").alias("jobs"))
        .orderBy(F.desc("jobs"), F.col("skill_name").asc_nulls_last()).limit(k)
    )


def salary_buckets(jobs: DataFrame) -> DataFrame:
    """Visible monthly VND salaries by band, lowest band first."""
    low = F.col("salary_min")
    bucket = (
        F.when(low < 10_000_000, "< 10M").when(low < 20_000_000, "10-20M").when(low < 30_000_000, "20-30M")
        .when(low < 50_000_000, "30-50M").otherwise("50M+")
    )
    rows = jobs.filter(F.col("is_salary_visible") & (F.col("salary_currency") == "VND") & (F.col("salary_period_id") == 1))
    return (
        rows.groupBy(bucket.alias("salary_bucket")).agg(F.count("*").alias("jobs"), F.min("salary_min").alias("_low"))
        .orderBy("_low").drop("_low")
    )


def top_companies(jobs: DataFrame, words: list[str], k: int = 10) -> DataFrame:
    return (
        jobs.filter(in_function(words)).groupBy("company_name").agg(
            F.count("*").alias("jobs"), F.max("company_size").alias("size"),
            F.sum("num_of_views").alias("total_views"), F.sum("num_of_applications").alias("total_apps"),
        ).orderBy(F.desc("jobs"), "company_name").limit(k)
    )


def crawl_health(frontier: DataFrame) -> DataFrame:
    n, retries = F.count("retry_count"), F.sum("retry_count")
    return frontier.groupBy("status").agg(
        F.count("*").alias("jobs"),
        F.count_if(F.col("http_status") == 200).alias("http_200"),
        F.count_if(F.col("http_status") >= 400).alias("http_errors"),
        F.max("crawled_at").alias("last_success"),
        F.when(n > 0, F.floor((retries * 200 + n) / (n * 2)) / F.lit(100.0)).alias("avg_retries"),
    )


def mart_tops(demand: DataFrame, k: int = 15) -> DataFrame:
    """Most demanded skills."""
    return demand.select("skill", "n_jobs", "pct_of_jobs", "avg_salary_vnd").orderBy(F.desc("n_jobs"), "skill").limit(k)


def best_paid_skills(demand: DataFrame, k: int = 10) -> DataFrame:
    return (
        demand.filter(F.col("avg_salary_vnd").isNotNull())
        .select("skill", "n_jobs", "avg_salary_vnd", "avg_salary_senior_vnd")
        .orderBy(F.desc("avg_salary_vnd"), "skill").limit(k)
    )


def top_hiring(companies: DataFrame, k: int = 20) -> DataFrame:
    return (
        companies.select("company_id", "company_name", "n_jobs", "primary_city", "avg_views", "avg_salary_vnd")
        .orderBy(F.desc("n_jobs"), F.col("avg_views").desc_nulls_last(), "company_id").limit(k)
    )


def salary_by_level_city(mart: DataFrame) -> DataFrame:
    return mart.select("job_category", "job_level", "city_canonical", "region", "p25_vnd", "p50_vnd", "p75_vnd", "n_visible_jobs")


def active_time_series(fact: DataFrame) -> DataFrame:
    return fact.filter("is_active").groupBy("snapshot_date").agg(
        F.count("*").alias("active_jobs"), round_half_even(F.avg("salary_vnd_monthly_avg")).alias("avg_salary")
    )


def flag_unpivot(features: DataFrame, flags=("has_python", "has_sql", "has_ml_ai", "has_bigdata")) -> DataFrame:
    """Jobs per skill flag, counted in one pass and turned to rows afterwards."""
    counted = features.agg(*[F.count_if(f).alias(f) for f in flags])
    return counted.unpivot([], list(flags), "skill_flag", "n_jobs")


def salary_senior_gap(features: DataFrame) -> DataFrame:
    return features.filter(F.col("salary_vnd_monthly_avg").isNotNull()).groupBy("is_senior").agg(
        F.count("*").alias("n"), F.rint(F.avg("salary_vnd_monthly_avg")).cast("bigint").alias("avg_salary")
    )


def count_by_source(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("source").agg(F.count("*").alias("n"))


def point_lookup(jobs: DataFrame, source: str, source_job_id: str) -> DataFrame:
    return jobs.filter((F.col("source") == source) & (F.col("source_job_id") == source_job_id))


def row_lineage(frontier: DataFrame, jobs: DataFrame, rejects: DataFrame, source: str, job_id: str) -> DataFrame:
    """One job's trail: crawled, loaded, rejected."""
    mine = frontier.filter((F.col("source") == source) & (F.col("job_id") == job_id)).select(
        "source", F.col("job_id").alias("source_job_id"), "status", "http_status", "raw_object_key", "crawled_at"
    )
    loaded = point_lookup(jobs, source, job_id).select(*JOB, "parsed_at", "parser_version")
    refused = point_lookup(rejects, source, job_id).groupBy(*JOB).agg(
        F.count("*").alias("n_rejects"), F.max("reject_reason").alias("last_reject_reason")
    )
    return mine.join(loaded, JOB, "full_outer").join(refused, JOB, "full_outer")


def profile_summary(rows: DataFrame) -> DataFrame:
    """Totals and fill rates of extracted pages (job_id, title, company, level, salary_min, views)."""
    filled = lambda c: F.count_if(F.coalesce(F.col(c) != "", F.lit(False)))
    return rows.agg(
        F.count("*").alias("total"), filled("title").alias("titles"), filled("company").alias("companies"),
        F.count_if(F.coalesce(F.col("salary_min") != 0, F.lit(False))).alias("salary_visible"),
        F.count("views").alias("views_present"),
        F.count_distinct(F.nullif("company", F.lit(""))).alias("unique_companies"),
    )


def value_counts(rows: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Non-empty values by frequency; the k most common."""
    counts = rows.filter(F.coalesce(F.col(column) != "", F.lit(False))).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k) if k else counts


def most_viewed(rows: DataFrame, k: int = 5) -> DataFrame:
    return (
        rows.filter(F.col("views") > 0).select("job_id", "title", "views", F.coalesce("applications", F.lit(0)).alias("applications"))
        .orderBy(F.desc("views"), "job_id").limit(k)
    )


# ------------------------------------------------------------------ health
# Every check: (check_name, source, value, threshold, fired)

def _check(df: DataFrame, name: str, value: Column, threshold: float, fired: Column, source: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"), (source if source is not None else F.lit("all")).alias("source"),
        value.cast("double").alias("value"), F.lit(float(threshold)).alias("threshold"), fired.alias("fired"),
    )


def source_freshness(jobs: DataFrame, as_of: Column) -> DataFrame:
    newest = jobs.groupBy("source").agg(F.max("parsed_at").alias("newest"))
    hours = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp("newest")) / 3600)
    return _check(newest, "source_freshness", hours, 48, F.col("newest") < as_of - _hours(48), F.col("source"))


def queue_status(frontier: DataFrame) -> DataFrame:
    return frontier.groupBy("source", "status").agg(F.count("*").alias("n"))


def stuck_claims(frontier: DataFrame, as_of: Column, limit: int = 500) -> DataFrame:
    n = frontier.groupBy("source").agg(F.count_if(is_stale_claim(as_of)).alias("n"))
    return _check(n, "stuck_claims", F.col("n"), limit, F.col("n") > limit, F.col("source"))


def failing_sources(frontier: DataFrame) -> DataFrame:
    n = frontier.groupBy("source").agg(
        F.count_if(F.col("status") == "failed").alias("bad"), F.count_if(F.col("status") == "success").alias("good")
    )
    return _check(n, "failed_over_success", F.col("bad") - F.col("good"), 0, F.col("bad") > F.col("good"), F.col("source"))


def _snapshot_age(fact: DataFrame, day: Column) -> DataFrame:
    return fact.agg(F.datediff(day, F.max("snapshot_date")).alias("age"))


def snapshot_stale(fact: DataFrame, day: Column) -> DataFrame:
    return _check(_snapshot_age(fact, day), "snapshot_stale", F.col("age"), 1, F.col("age") > 1)


def gold_freshness(fact: DataFrame, day: Column) -> DataFrame:
    return _check(_snapshot_age(fact, day), "gold_freshness", F.col("age"), 2, F.col("age") >= 2)


def quality_drift(silver: DataFrame) -> DataFrame:
    shares = silver.agg(
        percent(F.count_if(F.col("job_category") == "Other"), F.count("*")).alias("pct_other"),
        percent(F.count_if(F.col("city_canonical").isNull()), F.count("*")).alias("pct_no_city"),
    )
    return _check(shares, "pct_other", F.col("pct_other"), 35, F.col("pct_other") > 35).unionByName(
        _check(shares, "pct_no_city", F.col("pct_no_city"), 15, F.col("pct_no_city") > 15)
    )


def generation_size(generations: DataFrame, limit: int = 20_000) -> DataFrame:
    n = generations.agg(F.count("*").alias("n"))
    return _check(n, "generation_size", F.col("n"), limit, F.col("n") > limit)


def extraction_coverage(log: DataFrame, jobs: DataFrame, least: float = 0.5) -> DataFrame:
    total = jobs.agg(F.count("*")).scalar()
    done = log.agg(F.count("*").alias("done")).select("done", total.alias("total"))
    return _check(
        done, "extraction_coverage", F.col("done") / F.nullif("total", F.lit(0)), least,
        F.col("done") < F.lit(least) * F.col("total"),
    )


def never_expire(jobs: DataFrame, as_of: Column, limit: int = 300) -> DataFrame:
    n = jobs.groupBy("source").agg(
        F.count_if(F.col("expired_at").isNull() & (F.col("posted_at") < as_of - _days(45))).alias("n")
    )
    return _check(n, "never_expire", F.col("n"), limit, F.col("n") > limit, F.col("source"))


def archive_age(keys: DataFrame, as_of: Column, hours: int = 26) -> DataFrame:
    """(key, modified_at) listing; the newest object must be younger than ``hours``."""
    newest = keys.agg(F.max("modified_at").alias("newest"))
    age = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp("newest")) / 3600)
    return _check(newest, "archive_age", age, hours, F.col("newest") < as_of - _hours(hours))


# ------------------------------------------------------------------ daily brief

def intake_24h_vs_7d(jobs: DataFrame, as_of: Column) -> DataFrame:
    parsed = F.col("parsed_at")
    n = jobs.groupBy("source").agg(
        F.count_if(parsed >= as_of - _hours(24)).alias("last_24h"),
        F.count_if(parsed >= as_of - _days(7)).alias("_week"),
    )
    return n.select(
        "source", "last_24h", F.floor((F.col("_week") * 2 + 7) / 14).alias("avg_per_day_7d"),
        (F.col("last_24h") * 14 < F.col("_week")).alias("below_half"),
    )


def inventory_delta(fact: DataFrame, day: Column) -> DataFrame:
    """Jobs and active jobs of the last days with the change to the day before.

    The ordering window covers at most three aggregated rows.
    """
    days = fact.filter(F.col("snapshot_date").between(F.date_sub(day, 2), day)).groupBy("snapshot_date").agg(
        F.count("*").alias("jobs"), F.count_if("is_active").alias("active")
    )
    w = Window.orderBy("snapshot_date")
    return days.withColumn("active_delta", F.col("active") - F.lag("active").over(w))


def quality_delta(fact: DataFrame, day: Column, points: float = 3.0) -> DataFrame:
    days = fact.filter(F.col("snapshot_date").between(F.date_sub(day, 1), day)).groupBy("snapshot_date").agg(
        percent(F.count_if(F.col("job_category") == "Other"), F.count("*")).alias("pct_other"),
        percent(F.count_if(F.col("city_canonical").isNull()), F.count("*")).alias("pct_no_city"),
        percent(F.count("salary_vnd_monthly_avg"), F.count("*")).alias("pct_salary"),
    )
    w = Window.orderBy("snapshot_date")
    names = ["pct_other", "pct_no_city", "pct_salary"]
    moved = F.lit(False)
    for n in names:
        moved = moved | F.coalesce(F.abs(F.col(n) - F.lag(n).over(w)) > points, F.lit(False))
    return days.withColumn("moved", moved)


def publish_compare(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Row count and newest day of both copies."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.agg(F.count("*").alias(f"{tag}_rows"), F.max("snapshot_date").alias(f"{tag}_newest"))
    other = side(theirs, "web")
    return side(ours, "warehouse").select(
        "warehouse_rows", "warehouse_newest",
        other.select("web_rows").scalar().alias("web_rows"), other.select("web_newest").scalar().alias("web_newest"),
    ).withColumn(
        "differs", (F.col("warehouse_rows") != F.col("web_rows")) | ~F.col("warehouse_newest").eqNullSafe(F.col("web_newest"))
    )


# ------------------------------------------------------------------ weekly market

def weekly_skill_change(fact: DataFrame, skills: DataFrame, day: Column, least: int = 5) -> DataFrame:
    """Mentions this week against the week before, in one join and one aggregation."""
    today = fact.filter((F.col("snapshot_date") == day) & (F.col("posted_at") >= F.date_sub(day, 14))).select(
        *JOB, (F.col("posted_at") >= F.date_sub(day, 7)).alias("_this")
    )
    rows = skills.select(*JOB, "skill_name").join(today, JOB)
    n = rows.groupBy("skill_name").agg(
        F.countDistinct(F.when(F.col("_this"), F.col("source_job_id"))).alias("this_week"),
        F.countDistinct(F.when(~F.col("_this"), F.col("source_job_id"))).alias("prev_week"),
    )
    return n.filter(F.col("this_week") >= least).withColumn("change", F.col("this_week") - F.col("prev_week"))


def risers_and_fallers(change: DataFrame, k: int = 5) -> DataFrame:
    up = change.orderBy(F.desc("change"), "skill_name").limit(k).withColumn("direction", F.lit("up"))
    down = change.orderBy(F.asc("change"), "skill_name").limit(k).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def weekly_salary_by_level(fact: DataFrame, day: Column) -> DataFrame:
    """Median of the active postings of a day, in millions to one decimal (ties to even)."""
    rows = fact.filter((F.col("snapshot_date") == day) & F.col("is_active")).select("job_level", "salary_vnd_monthly_avg")
    n = rows.groupBy("job_level").agg(F.count("salary_vnd_monthly_avg").alias("with_salary"))
    mid = exact_percentiles(rows, ["job_level"], "salary_vnd_monthly_avg", {"median": 0.5}, 1_000_000.0).select("job_level", "median")
    return n.join(mid, "job_level", "left").select(
        "job_level", "with_salary", (F.rint(F.col("median") / F.lit(1e5)) / F.lit(10.0)).alias("median_m_vnd")
    )


def hiring_top(fact: DataFrame, day: Column, k: int = 10) -> DataFrame:
    return (
        fact.filter((F.col("snapshot_date") == day) & F.col("is_active")).groupBy("company_name")
        .agg(F.count("*").alias("open_roles")).orderBy(F.desc("open_roles"), "company_name").limit(k)
    )


def weekly_top_hiring(fact: DataFrame, day: Column, before: Column, k: int = 10) -> DataFrame:
    """Top hirers of a day, and who entered or left the list since an earlier day."""
    now = hiring_top(fact, day, k)
    then = hiring_top(fact, before, k).withColumnRenamed("open_roles", "open_roles_before")
    return now.join(then, "company_name", "full_outer").withColumn(
        "movement",
        F.when(F.col("open_roles_before").isNull(), "entered").when(F.col("open_roles").isNull(), "left").otherwise("stayed"),
    )


def weekly_unclassified_titles(fact: DataFrame, day: Column, k: int = 15) -> DataFrame:
    rows = fact.filter(
        (F.col("snapshot_date") == day) & (F.col("job_category") == "Other") & (F.col("posted_at") >= F.date_sub(day, 7))
    )
    return rows.groupBy("title").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "title").limit(k)
