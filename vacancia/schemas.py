"""Record and table schemas. JSON-valued columns stay JSON text."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["source", "source_job_id"]

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
}


def struct_of(ddl: str) -> T.StructType:
    """Flat DDL to a schema without needing a running session."""
    parts = [p.split() for p in ddl.split(",")]
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in parts])

def extended(schema: T.StructType, name: str, kind: str = "string") -> T.StructType:
    """A copy of the schema with one more field."""
    return T.StructType([*schema.fields, T.StructField(name, _TYPES[kind])])


# The columns of the common posting record, in table order.
_JOB_COLUMNS = """
source string
source_job_id string
source_url string
parser_version string
parsed_at timestamp
loaded_at timestamp
title string
alias string
company_id bigint
company_name string
company_logo_url string
company_profile_text string
salary_min double
salary_max double
salary_currency string
is_salary_visible boolean
pretty_salary string
job_level string
years_of_experience int
employment_type string
job_function string
locations string
industries string
skills string
benefits string
job_description_text string
job_requirement_text string
posted_at timestamp
expired_at timestamp
last_updated_at timestamp
is_expired boolean
num_of_views int
num_of_applications int
company_size string
company_size_id int
company_color string
num_of_recruits int
salary_period_id int
pretty_salary_vi string
pretty_salary_en string
working_days string
working_from_hour string
working_to_hour string
highest_degree_id int
language_selected string
language_selected_vi string
range_age string
required_resume boolean
required_cover_letter boolean
primary_address string
contact_name string
contact_email string
services string
canonical_slug string
is_active boolean
online_on timestamp
"""

JOB_COLUMNS: list[tuple[str, str]] = [
    tuple(line.split(" ", 1)) for line in _JOB_COLUMNS.strip().splitlines()
]
JSON_COLUMNS = ["job_function", "locations", "industries", "skills", "benefits", "services"]
TIMESTAMP_COLUMNS = ["parsed_at", "posted_at", "expired_at", "last_updated_at", "online_on"]
# JSON columns the table declares as "not null, default empty array".
LIST_COLUMNS = ["locations", "industries", "skills", "benefits", "services"]
UPDATABLE_COLUMNS = [c for c, _ in JOB_COLUMNS if c not in (*KEY, "loaded_at")]

#: raw.job_detail
JOB_TABLE = struct_of(", ".join(f"{c} {t}" for c, t in JOB_COLUMNS))

#: A parsed record as archived: timestamps are still ISO text, nested values JSON text.
PARSED_RECORD = struct_of(
    ", ".join(
        f"{c} {'string' if c in TIMESTAMP_COLUMNS else t}"
        for c, t in JOB_COLUMNS
        if c != "loaded_at"
    )
)

#: raw.job_detail_rejects
REJECTS = struct_of(
    "source string, source_job_id string, object_key string, parser_version string, "
    "reject_reason string, reject_detail string, payload string, rejected_at timestamp"
)

#: What replays of the quarantine have settled
LEDGER = struct_of(
    "payload_hash string, source string, source_job_id string, state string, settled_at timestamp, replay_id string"
)

#: raw.crawl_log
FRONTIER = struct_of(
    "job_id string, source string, status string, url string, first_seen_at timestamp, "
    "last_attempt_at timestamp, crawled_at timestamp, retry_count int, http_status int, "
    "error_message string, raw_object_key string, crawl_run_id string"
)

#: raw.skill_extraction_log
SKILL_LOG = struct_of(
    "source string, source_job_id string, skills_json string, experience_years_min int, "
    "seniority_level string, model_used string, tokens_used int, extracted_at timestamp"
)

#: normalization.job_normalization (category part; the other parts are never written)
NORMALIZATION = struct_of(
    "source string, source_job_id string, run_id string, run_at timestamp, job_category string, "
    "category_method string, category_confidence double, category_matched_on string"
)

#: normalization.drift_log
DRIFT = struct_of(
    "run_id string, dimension string, raw_value string, source string, frequency int, "
    "first_seen_at timestamp, last_seen_at timestamp, status string"
)

#: Social post as archived
POST = struct_of(
    "id string, text string, media_type string, permalink string, timestamp string, "
    "username string, has_replies boolean, is_quote_post boolean, is_reply boolean"
)

# Seed tables, one schema per CSV.
SEEDS = {
    "city_map": "city_raw_en string, city_canonical string, region string",
    "company_size_map": "company_size_id int, size_label string, size_bucket string",
    "degree_map": "highest_degree_id int, degree_label string",
    "fx_rates": "currency string, vnd_rate double, updated_at date",
    "job_level_map": "keyword string, job_level string, priority int",
    "job_title_category_map": "keyword string, job_category string, priority int",
    "salary_period_map": "salary_period_id int, period_label string, months_multiplier double",
    "vnw_function_category_map": "vnw_function string, job_category string, beats_title boolean",
}
