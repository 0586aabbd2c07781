"""Bronze to feature models. Every model is a plain function of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.functions import salary as sal
from vacancia.functions.dates import is_expired
from vacancia.functions.jsontext import array_items, blank_to_null, literal_map
from vacancia.functions.numeric import (
    in_millions_1dp, mean_1dp, percent, round_half_even, round_half_up,
)
from vacancia.operators.merge import first_per_key
from vacancia.operators.quantiles import exact_percentiles
from vacancia.operators.rules import first_match
from vacancia.session import stored

JOB = ["source", "source_job_id"]
SALARY_RANGE = 1_000_000.0  # width of the value ranges used for exact percentiles


@dataclass
class Lookups:
    """Rule and lookup tables of the silver layer."""

    city_map: DataFrame
    title_map: DataFrame
    function_map: DataFrame
    level_map: DataFrame
    fx_rates: DataFrame
    periods: DataFrame
    degrees: DataFrame
    sizes: DataFrame
    raw_levels: dict[str, str] = field(default_factory=lambda: seeds.as_dict(seeds.RAW_LEVELS))


# ------------------------------------------------------------------ bronze

def stg_job_detail(jobs: DataFrame, as_of: Column, stale_days: int = 45) -> DataFrame:
    flagged = jobs.withColumn(
        "is_expired_calc", is_expired(F.col("posted_at"), F.col("expired_at"), as_of, stale_days)
    )
    return flagged.withColumn("is_active_calc", ~F.col("is_expired_calc"))


# ------------------------------------------------------------------ silver

def title_order(value: str) -> list[Column]:
    """Total order of title rules: priority, longest keyword, keyword, value."""
    return [F.col("priority"), F.length("keyword").desc(), F.col("keyword"), F.col(value)]


def join_dimensions(df: DataFrame, look: Lookups) -> DataFrame:
    """Left joins to the four lookups; the planner broadcasts them by their known size."""
    fx = look.fx_rates.select(F.col("currency").alias("salary_currency"), "vnd_rate")
    return (
        df.join(fx, "salary_currency", "left")
        .join(look.periods.select("salary_period_id", "period_label", "months_multiplier"), "salary_period_id", "left")
        .join(look.degrees, "highest_degree_id", "left")
        .join(look.sizes, "company_size_id", "left")
    )


def city_exact_then_fuzzy(df: DataFrame, city_map: DataFrame) -> DataFrame:
    """Exact alias (case counts), else the longest alias contained in the place (case does not)."""
    exact = city_map.select(
        F.col("city_raw_en"), F.col("city_canonical").alias("_city_x"), F.col("region").alias("_region_x")
    )
    joined = df.join(exact, "city_raw_en", "left")
    fuzzy = first_match(
        joined, "city_raw_en", city_map, "city_raw_en",
        {"city_canonical": "_city_f", "region": "_region_f"},
        [F.length("city_raw_en").desc(), F.col("city_raw_en"), F.col("city_canonical")],
    )
    found = F.col("_city_x").isNotNull()
    return fuzzy.withColumns({
        "city_canonical": F.when(found, F.col("_city_x")).otherwise(F.col("_city_f")),
        "region": F.when(found, F.col("_region_x")).otherwise(F.col("_region_f")),
    }).drop("_city_x", "_region_x", "_city_f", "_region_f")


def function_category(df: DataFrame, function_map: DataFrame) -> DataFrame:
    """Category of the first board's own function name: adds fn_category, fn_beats_title."""
    fm = function_map.select(
        F.col("vnw_function").alias("_fn"), F.col("job_category").alias("fn_category"),
        F.col("beats_title").alias("fn_beats_title"),
    )
    name = F.when(
        F.col("source") == "vietnamworks", F.get_json_object("job_function", "$.children[0].name")
    )
    return df.withColumn("_fn", name).join(fm, "_fn", "left").drop("_fn")


def category_resolve(df: DataFrame, look: Lookups) -> DataFrame:
    """Trusted function, title keyword, other function, normalization engine, 'Other'."""
    rows = function_category(df, look.function_map)
    rows = first_match(
        rows, "title", look.title_map, "keyword", {"job_category": "_title_category"}, title_order("job_category")
    )
    return rows.withColumn(
        "job_category",
        F.coalesce(
            F.when(F.col("fn_beats_title"), F.col("fn_category")),
            F.col("_title_category"), F.col("fn_category"), F.col("norm_job_category"), F.lit("Other"),
        ),
    ).drop("fn_category", "fn_beats_title", "_title_category")


def level_resolve(df: DataFrame, look: Lookups) -> DataFrame:
    """Known raw value, title keyword, 'Mid-level'. Adds job_level, keeps job_level_raw."""
    rows = first_match(
        df, "title", look.level_map, "keyword", {"job_level": "_title_level"}, title_order("job_level")
    )
    known = literal_map(look.raw_levels)
    return rows.withColumn("job_level_raw", F.col("job_level")).withColumn(
        "job_level",
        F.coalesce(F.try_element_at(known, F.col("job_level_raw")), F.col("_title_level"), F.lit("Mid-level")),
    ).drop("_title_level")


def latest_normalization(generations: DataFrame) -> DataFrame:
    latest = first_per_key(generations, JOB, [F.col("run_at").desc(), F.col("run_id").desc()])
    return latest.select(*JOB, F.col("job_category").alias("norm_job_category"))


SILVER_COLUMNS = """
source source_job_id title alias company_id company_name company_logo_url company_color
company_size_id company_size_label company_size_bucket is_salary_visible salary_currency
salary_period_id salary_period_label salary_vnd_monthly_min salary_vnd_monthly_max
salary_vnd_monthly_avg job_level job_level_raw years_of_experience employment_type job_function
locations industries skills benefits services job_description_text job_requirement_text posted_at
expired_at last_updated_at is_expired is_active online_on num_of_views num_of_applications
num_of_recruits working_days working_from_hour working_to_hour highest_degree_id degree_label
job_category language_selected language_selected_vi range_age required_resume required_cover_letter
primary_address contact_name contact_email canonical_slug source_url city_raw_en city_raw_vi
primary_address_extracted city_canonical region parser_version parsed_at loaded_at
""".split()


def silver_job_detail(staged: DataFrame, generations: DataFrame, look: Lookups) -> DataFrame:
    """One row per job. One shuffle join (to the latest normalization); the rest is map-side."""
    rows = staged.join(latest_normalization(generations), JOB, "left")
    rows = rows.withColumns({
        "city_raw_en": blank_to_null(F.get_json_object("locations", "$[0].city")),
        "city_raw_vi": blank_to_null(F.get_json_object("locations", "$[0].city_vi")),
        "primary_address_extracted": blank_to_null(F.get_json_object("locations", "$[0].address")),
    })
    rows = join_dimensions(rows, look)
    rows = city_exact_then_fuzzy(rows, look.city_map)
    rows = category_resolve(rows, look)
    rows = level_resolve(rows, look)

    visible, rate = F.col("is_salary_visible"), F.col("vnd_rate")
    low, high, period = F.col("salary_min"), F.col("salary_max"), F.col("salary_period_id")
    factor = sal.salary_multiplier(period, low, rate, F.col("months_multiplier"))
    return rows.withColumns({
        "salary_vnd_monthly_min": sal.to_vnd_monthly(visible, low, rate, factor),
        "salary_vnd_monthly_max": sal.to_vnd_monthly(visible, high, rate, factor),
        "salary_vnd_monthly_avg": sal.to_vnd_monthly(visible, (low + high) / F.lit(2.0), rate, factor),
        "salary_period_label": F.col("period_label"),
        "company_size_label": F.col("size_label"),
        "company_size_bucket": F.col("size_bucket"),
        "is_expired": F.col("is_expired_calc"),
        "is_active": F.col("is_active_calc"),
    }).withColumn("salary_period_id", sal.fixed_period(period, low, rate)).select(*SILVER_COLUMNS)


def silver_company_dim(silver: DataFrame) -> DataFrame:
    """Latest attributes and averages per company, in one aggregation.

    The count covers all postings, as the published column does.
    """
    latest = F.max_by(
        F.struct(
            "company_name", "company_logo_url", "company_color", "company_size_id", "company_size_label",
            "company_size_bucket", "city_canonical", "region", "parsed_at",
        ),
        F.struct("parsed_at", *JOB),
    )
    per_company = silver.filter(F.col("company_id").isNotNull()).groupBy("company_id").agg(
        latest.alias("l"),
        F.count("*").alias("n_active_jobs"),
        round_half_even(F.avg("salary_vnd_monthly_avg")).alias("avg_salary_vnd"),
        round_half_up(F.avg("num_of_views")).alias("avg_views"),
        round_half_up(F.avg("num_of_applications")).alias("avg_apps"),
    )
    return per_company.select(
        "company_id", "l.company_name", "l.company_logo_url", "l.company_color", "l.company_size_id",
        "l.company_size_label", "l.company_size_bucket", F.col("l.city_canonical").alias("primary_city"),
        "l.region", "n_active_jobs", "avg_salary_vnd", "avg_views", "avg_apps",
        F.col("l.parsed_at").alias("last_seen_at"),
    )


def skill_tags() -> Column:
    """The source tags of a row as an array of names, lower-cased and without blanks around them."""
    items = array_items(F.col("skills"), "id string, name string, weight string")
    named = F.filter(items, lambda s: F.trim(s["name"]) != "")
    return F.transform(named, lambda s: F.lower(F.trim(s["name"])))


def silver_skill_long(silver: DataFrame) -> DataFrame:
    """One row per (job, source tag)."""
    tags = array_items(F.col("skills"), "id string, name string, weight string")
    rows = silver.select(
        *JOB, "company_id", "company_name", "city_canonical", "region", "salary_vnd_monthly_avg",
        "job_level", "parsed_at", F.explode(tags).alias("s"),
    ).filter(F.trim("s.name") != "")
    return rows.select(
        *JOB, "company_id", "company_name", "city_canonical", "region", "salary_vnd_monthly_avg", "job_level",
        F.col("s.id").try_cast("bigint").alias("skill_id"),
        F.lower(F.trim("s.name")).alias("skill_name_norm"),
        F.col("s.name").alias("skill_name_raw"),
        F.coalesce(F.col("s.weight").try_cast("int"), F.lit(0)).alias("skill_weight"),
        "parsed_at",
    )


def silver_skill_enriched(skill_log: DataFrame) -> DataFrame:
    """One row per (job, extracted skill), with defaults."""
    items = array_items(
        F.col("skills_json"),
        "name string, name_raw string, category string, importance string, confidence string",
    )
    rows = skill_log.select(*JOB, "model_used", "extracted_at", F.explode(items).alias("s")).filter(
        F.trim("s.name") != ""
    )
    return rows.select(
        *JOB,
        F.lower(F.trim("s.name")).alias("skill_name"),
        F.col("s.name_raw").alias("skill_name_raw"),
        F.coalesce("s.category", F.lit("other")).alias("skill_category"),
        F.coalesce("s.importance", F.lit("mentioned")).alias("importance"),
        F.coalesce("s.confidence", F.lit("medium")).alias("confidence"),
        "model_used", "extracted_at",
    )


def silver_skill_unified(skill_long: DataFrame, skill_enriched: DataFrame) -> DataFrame:
    """Best row per (job, skill): highest weight; on a tie the source tag, then the raw name."""
    tags = skill_long.select(
        *JOB, F.col("skill_name_norm").alias("skill_name"), "skill_name_raw",
        F.lit("source_tag").alias("extraction_method"), "skill_weight",
        F.lit(None).cast("string").alias("skill_category"), F.lit(None).cast("string").alias("importance"),
        F.col("parsed_at").alias("extracted_at"),
    )
    weight = F.when(F.col("importance") == "required", 80).when(F.col("importance") == "preferred", 50).otherwise(20)
    extracted = skill_enriched.select(
        *JOB, "skill_name", "skill_name_raw", F.lit("llm").alias("extraction_method"),
        weight.alias("skill_weight"), "skill_category", "importance", "extracted_at",
    )
    return first_per_key(
        tags.unionByName(extracted), [*JOB, "skill_name"],
        [
            F.col("skill_weight").desc(), F.col("extraction_method").desc(),
            F.col("skill_name_raw").asc_nulls_last(), F.col("skill_category").asc_nulls_last(),
            F.col("importance").asc_nulls_last(),
        ],
    )


# ------------------------------------------------------------------ gold

FACT_COLUMNS = """
title job_category company_id company_name company_size_bucket salary_vnd_monthly_min
salary_vnd_monthly_max salary_vnd_monthly_avg job_level city_canonical region degree_label is_active
is_expired num_of_views num_of_applications posted_at expired_at parsed_at
""".split()


def fct_jobs_snapshot(silver: DataFrame, day: Column) -> DataFrame:
    """The rows one day contributes to the daily fact (merge with merge_delete_insert)."""
    return silver.select(*JOB, day.alias("snapshot_date"), *FACT_COLUMNS)


def mart_company_hiring(silver: DataFrame, day: Column) -> DataFrame:
    """City and region come from the alias table, so the mode buffers stay small."""
    return silver.filter(F.col("company_id").isNotNull()).groupBy("company_id").agg(
        F.max("company_name").alias("company_name"),
        F.max("company_size_bucket").alias("company_size"),
        F.max("company_size_label").alias("company_size_label"),
        F.expr("mode() within group (order by city_canonical)").alias("primary_city"),
        F.expr("mode() within group (order by region)").alias("primary_region"),
        F.count("*").alias("n_jobs"),
        round_half_up(F.avg("num_of_views")).alias("avg_views"),
        round_half_up(F.avg("num_of_applications")).alias("avg_apps"),
        round_half_even(F.avg("salary_vnd_monthly_avg")).alias("avg_salary_vnd"),
        round_half_even(F.min("salary_vnd_monthly_min")).alias("min_salary_vnd"),
        round_half_even(F.max("salary_vnd_monthly_max")).alias("max_salary_vnd"),
        F.max("parsed_at").alias("last_seen_at"),
    ).withColumn("snapshot_date", day)


def mart_salary_by_level(silver: DataFrame, day: Column) -> DataFrame:
    keys = ["job_category", "job_level", "city_canonical", "region"]
    rows = silver.filter(F.col("job_level").isNotNull() & F.col("salary_vnd_monthly_avg").isNotNull()).select(
        F.coalesce("job_category", F.lit("Other")).alias("job_category"), "job_level",
        F.coalesce("city_canonical", F.lit("Unknown")).alias("city_canonical"),
        F.coalesce("region", F.lit("Unknown")).alias("region"),
        "salary_vnd_monthly_avg", "salary_vnd_monthly_min", "salary_vnd_monthly_max",
    )
    spread = exact_percentiles(
        rows, keys, "salary_vnd_monthly_avg", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, SALARY_RANGE,
        lows=["salary_vnd_monthly_min"], highs=["salary_vnd_monthly_max"],
    )
    return spread.select(
        *keys, F.col("n").alias("n_visible_jobs"),
        *[round_half_even(F.col(p)).alias(f"{p}_vnd") for p in ("p25", "p50", "p75")],
        round_half_even(F.col("mean")).alias("avg_salary_vnd"),
        round_half_even(F.col("salary_vnd_monthly_min")).alias("min_salary_vnd"),
        round_half_even(F.col("salary_vnd_monthly_max")).alias("max_salary_vnd"),
    ).withColumn("snapshot_date", day)


def mart_skill_demand(silver: DataFrame, skill_long: DataFrame, day: Column) -> DataFrame:
    """Demand in the six tracked categories.

    Jobs are matched by the bare job id, as published: ids shared by several
    boards multiply. Jobs are first reduced to one row per (id, level, salary)
    with a count, which keeps the published averages and shrinks hot ids.
    """
    jobs = silver.filter(F.col("job_category").isin(seeds.DEMAND_CATEGORIES))
    total = jobs.agg(F.count("*")).scalar()
    by_id = jobs.groupBy("source_job_id").agg(
        F.count("*").alias("j_n"),
        F.count("salary_vnd_monthly_avg").alias("s_n"),
        F.sum("salary_vnd_monthly_avg").alias("s_sum"),
        *[
            agg(F.when(F.col("job_level").isin(*levels), F.col("salary_vnd_monthly_avg"))).alias(f"{tag}_{kind}")
            for tag, levels in (("m", ("Manager", "Director+")), ("e", ("Senior",)))
            for kind, agg in (("n", F.count), ("sum", F.sum))
        ],
    )
    # Skills of one id collapse too, so a shared id costs one row per skill.
    tags = skill_long.groupBy("source_job_id", "skill_name_norm").agg(
        F.count("*").alias("t_n"), F.sum("skill_weight").alias("w_sum")
    )
    rows = tags.join(by_id, "source_job_id")

    def mean(prefix: str) -> Column:
        n = F.sum(F.col("t_n") * F.col(f"{prefix}_n"))
        return round_half_even(F.when(n > 0, F.sum(F.col("t_n") * F.col(f"{prefix}_sum")) / n))

    per_skill = rows.groupBy(F.col("skill_name_norm").alias("skill")).agg(
        F.count("*").alias("n_jobs"),  # one row per (skill, id) by now
        mean("s").alias("avg_salary_vnd"),
        mean("m").alias("avg_salary_manager_vnd"),
        mean("e").alias("avg_salary_senior_vnd"),
        mean_1dp(F.sum(F.col("w_sum") * F.col("j_n")), F.sum(F.col("t_n") * F.col("j_n"))).alias("avg_weight"),
    ).filter(F.col("n_jobs") >= 2)
    return per_skill.select(
        "skill", "n_jobs", percent(F.col("n_jobs"), total).alias("pct_of_jobs"),
        "avg_salary_vnd", "avg_salary_manager_vnd", "avg_salary_senior_vnd", "avg_weight",
        day.alias("snapshot_date"),
    )


def mart_skill_demand_v2(silver: DataFrame, skills: DataFrame, day: Column) -> DataFrame:
    """All categories, joined on the full job key.

    Both inputs are staged with the columns that count, one after the other, so their shuffles are not on disk
    together. One shuffle by job id then serves the join and the counts of distinct ids.
    """
    jobs = stored(silver.select(*JOB, "job_level", "salary_vnd_monthly_avg"), "demand-jobs")
    marks = stored(skills.select(*JOB, "skill_name", "skill_category", "importance", "extraction_method"), "demand-skills")
    total = jobs.agg(F.count("*")).scalar()
    job, mark = (F.struct(*[c for c in df.columns if c not in JOB]) for df in (jobs, marks))
    keyed = [
        jobs.select(*JOB, job.alias("job")).withColumn("mark", F.lit(None).cast(marks.select(mark.alias("x")).schema["x"].dataType)),
        marks.select(*JOB, mark.alias("mark")).withColumn("job", F.lit(None).cast(jobs.select(job.alias("x")).schema["x"].dataType)),
    ]
    both = keyed[0].unionByName(keyed[1]).filter("source is not null and source_job_id is not null").repartition("source_job_id")
    rows = both.groupBy(*JOB).agg(F.collect_list("job").alias("jobs"), F.collect_list("mark").alias("marks")).select(
        "source_job_id", "marks", F.inline("jobs")
    ).select("source_job_id", "job_level", F.col("salary_vnd_monthly_avg").alias("pay"), F.inline("marks"))
    level = F.col("job_level")
    paid = {"pay": F.lit(True), "lead": level.isin("Manager", "Director+"), "senior": level == "Senior"}
    named = {
        "n_required": F.col("importance") == "required", "n_preferred": F.col("importance") == "preferred",
        "n_llm_extracted": F.col("extraction_method") == "llm", "n_source_tagged": F.col("extraction_method") == "source_tag",
    }
    by_id = rows.groupBy(F.col("skill_name").alias("skill"), "source_job_id").agg(
        F.max("skill_category").alias("skill_category"),
        *[f(F.when(only, F.col("pay"))).alias(f"{n}_{kind}") for n, only in paid.items() for kind, f in (("sum", F.sum), ("n", F.count))],
        *[F.count_if(c).alias(n) for n, c in named.items()],
    )

    def mean(name: str) -> Column:
        n = F.sum(f"{name}_n")
        return round_half_even(F.when(n > 0, F.sum(f"{name}_sum") / n))

    per_skill = by_id.groupBy("skill").agg(
        F.max("skill_category").alias("skill_category"),
        F.count("*").alias("n_jobs"),  # one row per (skill, id) by now
        mean("pay").alias("avg_salary_vnd"), mean("lead").alias("avg_salary_manager_vnd"), mean("senior").alias("avg_salary_senior_vnd"),
        *[F.sum(n).alias(n) for n in named],
    ).filter(F.col("n_jobs") >= 2)
    return per_skill.withColumn("pct_of_jobs", percent(F.col("n_jobs"), total)).withColumn("snapshot_date", day)


def mart_skill_cooccurrence(skills: DataFrame, day: Column, min_jobs: int = 3) -> DataFrame:
    """Skill pairs named together by a board's job, counted by bare job id, at least min_jobs of them.

    One shuffle by job id serves all that follows but the counts: a job's skills become a sorted
    array, its pairs are made from the array, boards that share an id agree on its distinct pairs in
    place, and plain counts are summed up before they move.
    """
    by_id = skills.select(*JOB, "skill_name").filter("skill_name is not null").repartition("source_job_id")
    named = by_id.groupBy(*JOB).agg(F.array_sort(F.collect_set("skill_name")).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(
        F.slice("s", i + 2, F.size("s")), lambda b: F.struct(a.alias("skill_a"), b.alias("skill_b"))
    )))
    once = named.select("source_job_id", F.explode(pairs).alias("p")).select("source_job_id", "p.*").distinct()
    return (
        once.groupBy("skill_a", "skill_b").agg(F.count("*").alias("cooccurrence_count"))
        .filter(F.col("cooccurrence_count") >= min_jobs)
        .withColumn("snapshot_date", day)
    )


def mart_skill_trend(fact: DataFrame, skills: DataFrame) -> DataFrame:
    """Skill by ISO week over the active rows of the daily fact."""
    days = fact.filter("is_active").select(*JOB, "salary_vnd_monthly_avg", "snapshot_date")
    rows = skills.select(*JOB, "skill_name").join(days, JOB)
    return (
        rows.groupBy(F.col("skill_name").alias("skill"), F.trunc("snapshot_date", "week").alias("week"))
        .agg(
            F.countDistinct("source_job_id").alias("n_jobs"),
            in_millions_1dp(F.avg("salary_vnd_monthly_avg")).alias("avg_salary_m"),
        )
        .filter(F.col("n_jobs") >= 2)
    )


# ------------------------------------------------------------------ features

# Substring patterns, matched anywhere in the skill name.
FLAG_PATTERNS = {
    "has_aws_cloud": "aws|cloud|azure|gcp",
    "has_ml_ai": "ml|ai|llm|machine|deep",
    "has_bigdata": "spark|hadoop|kafka|flink",
    "has_bi_tool": "power bi|tableau|looker|qlik",
}
FLAGS = ["has_python", "has_sql", *FLAG_PATTERNS]


def skill_flags(skill_long: DataFrame) -> DataFrame:
    name = F.col("skill_name_norm")
    return skill_long.groupBy(*JOB).agg(
        F.bool_or(name == "python").alias("has_python"),
        F.bool_or(name == "sql").alias("has_sql"),
        *[F.bool_or(name.rlike(f"(?i){p}")).alias(c) for c, p in FLAG_PATTERNS.items()],
        F.count("*").alias("n_skills"),
    )


def job_features(silver: DataFrame, skill_long: DataFrame, day: Column) -> DataFrame:
    """One feature row per job."""
    flags = skill_flags(skill_long)
    companies = (
        silver.filter(F.col("company_id").isNotNull()).groupBy("company_id")
        .agg(F.count("*").alias("_company_jobs")).withColumn("_spread", F.lit(0))
    )
    # Most boards send no company id; those rows get a spread key so they do not share one task.
    spread = F.when(F.col("company_id").isNull(), F.pmod(F.xxhash64(*JOB), F.lit(4096)).cast("int")).otherwise(0)
    rows = (
        silver.withColumn("_spread", spread).join(flags, JOB, "left")
        .join(companies, ["company_id", "_spread"], "left")
    )
    remote = F.coalesce("employment_type", F.lit("")).ilike("%remote%") | F.col("title").rlike(
        "(?i)remote|wfh|work from home"
    )
    return rows.select(
        *JOB, day.alias("snapshot_date"), "salary_vnd_monthly_avg",
        F.col("is_salary_visible").alias("has_salary_visible"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in FLAGS],
        F.coalesce("n_skills", F.lit(0)).alias("n_skills"),
        F.col("job_level").isin("Senior", "Manager", "Director+").alias("is_senior"),
        remote.alias("is_remote"),
        "job_level", "city_canonical", "region", "degree_label", "company_size_bucket",
        F.coalesce("_company_jobs", F.lit(1)).alias("company_n_active_jobs"),
        F.coalesce("num_of_views", F.lit(0)).alias("num_of_views"),
        F.coalesce("num_of_applications", F.lit(0)).alias("num_of_applications"),
        F.datediff(day, F.col("posted_at").cast("date")).alias("days_since_posted"),
        "parsed_at",
    )
