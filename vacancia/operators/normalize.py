"""What a normalization run computes, and the rule tables it is seeded with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.operators.merge import first_per_key
from vacancia.operators.rules import TitleRule, classify_title


def classified_jobs(
    jobs: DataFrame, rules: Sequence[TitleRule], run_id: str, as_of: Column, since: Column | None = None,
) -> DataFrame:
    """One generation of results over the jobs loaded since a moment; drift_value is the title that no rule knows."""
    rows = jobs if since is None else jobs.filter(F.col("loaded_at") >= since)
    classified = classify_title(rows, rules, seeds.as_dict(seeds.FUNCTION_CATEGORIES))
    unknown = F.substring(F.coalesce("title", F.lit("")), 1, 200)
    return classified.select(
        "source", "source_job_id", F.lit(run_id).alias("run_id"), as_of.alias("run_at"),
        "job_category", "category_method", "category_confidence", "category_matched_on",
        F.when(F.col("category_method") == "default", unknown).alias("drift_value"),
    )


def drift_entries(generation: DataFrame) -> DataFrame:
    """The unmapped values of a generation, as the drift log takes them."""
    return generation.filter("drift_value is not null").select(
        F.lit("category").alias("dimension"), F.col("drift_value").alias("raw_value"), "source"
    )


# ------------------------------------------------------------------ rule seeding

def category_rules(spark: SparkSession, title_map: DataFrame) -> DataFrame:
    """Title CSV without the unsafe keywords, then the extra rules; first row per rule wins."""
    unsafe = [r[0] for r in seeds.lines(seeds.UNSAFE_TITLE_KEYWORDS)]
    from_csv = title_map.filter(~F.lower(F.trim("keyword")).isin(unsafe)).select(
        F.trim("keyword").alias("pattern"), F.trim("job_category").alias("job_category"),
        "priority", F.lit(0).alias("_part"),
    )
    extra = seeds.table(
        spark, seeds.lines(seeds.EXTRA_CATEGORY_RULES), "pattern string, job_category string, priority int"
    ).withColumn("_part", F.lit(1))
    merged = first_per_key(
        from_csv.unionByName(extra), ["pattern", "job_category"], [F.col("_part"), F.col("priority")]
    )
    return merged.select(
        "pattern", "job_category", "priority",
        F.lit("word_boundary").alias("match_mode"), F.lit(True).alias("is_active"),
    )


def level_rules(spark: SparkSession, level_map: DataFrame) -> DataFrame:
    """Title keywords, raw values and years of experience as one rule table."""
    titles = level_map.select(
        F.lit("title_keyword").alias("signal_type"), F.trim("keyword").alias("pattern"),
        F.trim("job_level").alias("job_level"), "priority", F.lit(0.80).alias("confidence"),
    )
    ddl = "pattern string, job_level string, confidence double"

    def fixed(text: str, signal: str, priority: int) -> DataFrame:
        return seeds.table(spark, seeds.lines(text), ddl).select(
            F.lit(signal).alias("signal_type"), "pattern", "job_level",
            F.lit(priority).alias("priority"), "confidence",
        )

    rows = (
        titles.unionByName(fixed(seeds.RAW_LEVEL_RULES, "raw_field_value", 5))
        .unionByName(fixed(seeds.EXPERIENCE_LEVEL_RULES, "experience_range", 50))
    )
    return first_per_key(rows, ["signal_type", "pattern", "job_level"], [F.col("priority")])


def city_aliases(spark: SparkSession, city_map: DataFrame) -> DataFrame:
    """City CSV plus extra spellings; one row per alias and board, a missing board counts as equal."""
    from_csv = city_map.select(
        F.trim("city_canonical").alias("city_canonical"), F.trim("region").alias("region"),
        F.trim("city_raw_en").alias("alias"), F.lit(None).cast("string").alias("source"), F.lit(0).alias("_part"),
    )
    extra = seeds.table(
        spark, seeds.lines(seeds.EXTRA_CITY_ALIASES),
        "city_canonical string, region string, alias string, source string",
    ).withColumn("source", F.nullif("source", F.lit(""))).withColumn("_part", F.lit(1))
    return first_per_key(
        from_csv.unionByName(extra), ["alias", "source"], [F.col("_part"), F.col("city_canonical")]
    ).drop("_part")


def skill_synonyms(spark: SparkSession) -> DataFrame:
    """(canonical_name, synonym), unique by synonym in listed order."""
    rows = [(str(i), c, s) for i, (c, s) in enumerate(seeds.synonym_pairs())]
    ranked = seeds.table(spark, rows, "ordinal int, canonical_name string, synonym string")
    return first_per_key(ranked, ["synonym"], [F.col("ordinal")]).drop("ordinal")
