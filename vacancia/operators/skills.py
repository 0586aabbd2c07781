"""Skill extraction: work list, taxonomy matching, response parsing, log upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions.jsontext import is_non_blank
from vacancia.functions.text import joined_text, truncate
from vacancia.operators.merge import first_per_key, upsert_last_wins

KEY = ["source", "source_job_id"]


def unprocessed(jobs: DataFrame, log: DataFrame) -> DataFrame:
    """Jobs with text that the extraction log does not know."""
    has_text = is_non_blank(F.col("job_description_text")) | is_non_blank(F.col("job_requirement_text"))
    return jobs.filter(has_text).join(log.select(*KEY), KEY, "left_anti")


def unprocessed_batch(jobs: DataFrame, log: DataFrame, limit: int = 100) -> DataFrame:
    """The newest ``limit`` of them."""
    return (
        unprocessed(jobs, log)
        .orderBy(F.col("parsed_at").desc_nulls_last(), *KEY).limit(limit)
        .select(*KEY, "job_description_text", "job_requirement_text")
    )


def count_unprocessed(jobs: DataFrame, log: DataFrame) -> DataFrame:
    return unprocessed(jobs, log).agg(F.count("*").alias("n"))


def job_text(max_chars: int | None = None) -> Column:
    """Description and requirement joined; cut only when a remote model needs it."""
    text = joined_text(F.col("job_description_text"), F.col("job_requirement_text"))
    return truncate(text, max_chars) if max_chars else text


def extract_by_taxonomy(docs: DataFrame, keys: list[str], text: str, taxonomy: DataFrame) -> DataFrame:
    """Taxonomy terms named in a text: keys + (skill, category).

    Every text becomes its distinct word n-grams, up to the longest term, which
    are equi-joined with the terms. Whole texts are read; no rule list is
    scanned per row, so the taxonomy may grow.
    """
    words_of = lambda c: F.filter(F.split(F.lower(c), r"(?U)[^\w+#.\-/]+|[.,;:]+(?=\s|$)"), lambda w: w != "")
    terms = taxonomy.select(
        F.array_join(words_of(F.col("skill")), " ").alias("_gram"), F.lower(F.trim("skill")).alias("skill"), "category",
    )
    longest = terms.agg(F.max(F.size(F.split("_gram", " ")))).first()[0] or 1
    words = F.col("_words")

    def grams_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        made = words if n == 1 else F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
        return F.when(F.size(words) >= n, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))

    grams = F.flatten(F.array(*[grams_of(n) for n in range(1, longest + 1)]))
    rows = docs.select(*keys, words_of(F.col(text)).alias("_words")).select(*keys, F.explode(grams).alias("_gram"))
    return rows.join(terms, "_gram").select(*keys, "skill", "category").distinct()


def parse_extraction_response(responses: DataFrame) -> DataFrame:
    """(source, source_job_id, content, model_used, tokens_used) to log columns.

    Invalid JSON means no skills; entries that are not objects and empty names
    are dropped; names are lower-cased.
    """
    doc = F.try_parse_json("content")
    skill = lambda x, name: F.try_variant_get(x, f"$.{name}", "string")
    has = lambda x, name: F.try_variant_get(x, f"$.{name}", "variant").isNotNull()
    default = lambda x, name, value: F.when(has(x, name), skill(x, name)).otherwise(F.lit(value))
    entries = F.filter(
        F.try_variant_get(F.col("_doc"), "$.skills", "array<variant>"),
        lambda x: F.schema_of_variant(x).startswith("OBJECT"),
    )
    parsed = F.transform(entries, lambda x: F.struct(
        F.trim(F.lower(default(x, "name", ""))).alias("name"),
        default(x, "name_raw", "").alias("name_raw"),
        default(x, "category", "other").alias("category"),
        default(x, "importance", "mentioned").alias("importance"),
        default(x, "confidence", "medium").alias("confidence"),
    ))
    named = F.filter(parsed, lambda s: s["name"] != "")
    return responses.withColumn("_doc", doc).select(
        *KEY,
        F.coalesce(F.to_json(named), F.lit("[]")).alias("skills_json"),
        F.coalesce(F.size(named), F.lit(0)).alias("n_skills"),
        F.try_variant_get("_doc", "$.experience_years_min", "int").alias("experience_years_min"),
        F.try_variant_get("_doc", "$.seniority_level", "string").alias("seniority_level"),
        "model_used", F.coalesce("tokens_used", F.lit(0)).alias("tokens_used"),
    )


def skill_log_upsert(log: DataFrame, parsed: DataFrame, as_of: Column, arrival: list[str]) -> DataFrame:
    """Store results that found at least one skill; the rest stay unprocessed."""
    batch = parsed.filter(F.col("n_skills") > 0).withColumn("extracted_at", as_of)
    return upsert_last_wins(log, batch, KEY, arrival, as_of)


def apply_synonyms(skills: DataFrame, synonyms: DataFrame, column: str) -> DataFrame:
    """Replace a skill by its canonical name where one is known (exact, else lower case)."""
    exact = synonyms.select(F.col("synonym").alias(column), F.col("canonical_name").alias("_c1"))
    lower = first_per_key(
        synonyms.select(F.lower("synonym").alias("_low"), F.col("canonical_name").alias("_c2")), ["_low"], [F.col("_c2")]
    )
    return (
        skills.join(exact, column, "left").withColumn("_low", F.lower(column)).join(lower, "_low", "left")
        .withColumn("canonical_skill", F.coalesce("_c1", "_c2", F.col(column))).drop("_c1", "_c2", "_low")
    )
