"""Posting-shaped frames projected from the provided tables.

The tables hold no postings, so every frame here is a projection of them. One
expression text serves Spark and the checking SQL; the operators on top are
written twice, independently.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.plans import models
from vacancia.session import pin_utc

AS_OF = "2001-06-30 00:00:00"
AS_OF_DAY = "2001-06-30"
PREV_DAY = "2001-06-29"
AS_OF_EVENTS = "2024-01-30 00:00:00"

BOARDS = "vietnamworks|itviec|linkedin|topcv|careerviet"
ROLES = (
    "Senior Data Engineer|Data Analyst Intern|AI Engineer|Junior Backend Developer|Head of Sales|"
    "Marketing Executive|DevOps Lead|Giám đốc kinh doanh|QA Manager|Business Analyst|Chief Accountant|"
    "Fresher Java Developer|Sales Engineer|HTML/CSS Designer|C++ Developer|Nhân viên kế toán|"
    "Data Scientist|Product Owner|Network Engineer|Backend Engineer (Golang)|Trưởng phòng nhân sự|"
    "Operator|Staff Machine Learning Engineer|SQL Developer"
)
N_ROLES = len(ROLES.split("|"))
SKILLS = (
    "Python|SQL|AWS|Power BI|Spark|Kafka|Tableau|Java|Azure Cloud|Machine Learning|HTML|Excel|Docker|"
    "Kubernetes|Airflow|dbt|Looker|Hadoop|Deep Learning|Go|React|Linux|Git|Scrum|ETL|Snowflake|GCP|Flink|"
    "LLM|Communication"
)
N_SKILLS = len(SKILLS.split("|"))

TITLE_RULES = [
    ("data engineer", "Data Engineer", 10), ("data analyst", "Data Analyst", 10),
    ("ai engineer", "AI Engineer", 10), ("backend", "Backend Developer", 20),
    ("sales engineer", "Technical Sales", 15), ("sales", "Business Development", 30),
    ("marketing", "Marketing", 30), ("devops", "DevOps Engineer", 15),
    ("kế toán", "Accounting & Finance", 25), ("accountant", "Accounting & Finance", 25),
    ("business analyst", "Business Analyst", 10), ("java", "Backend Developer", 25),
    ("data scientist", "Data Scientist", 10), ("machine learning", "AI Engineer", 15),
    ("html", "Frontend Developer", 30), ("css", "Frontend Developer", 30),
    ("widget", "Manufacturing & Engineering", 40), ("gear", "Manufacturing & Engineering", 40),
    ("small gear", "Research & Development", 40), ("anvil", "Other", 40), ("c++", "Embedded Engineer", 20),
    ("red", "Creative Design", 40), ("ring", "Creative Design", 40), ("ring", "Real Estate", 40),
]
FUNCTION_RULES = [
    ("Brand#1", "Business Development", "true"), ("Brand#2", "Technical Sales", "true"),
    ("Brand#3", "Business Analyst", "true"), ("Brand#4", "Data Analyst", "false"),
    ("Brand#5", "Marketing", "false"), ("Brand#6", "Human Resources", "false"),
    ("Brand#7", "Accounting & Finance", "false"), ("Brand#8", "Other", "false"),
]


def nth(words: str, index: str) -> str:
    """SQL for the index-th (0-based) word of a '|' list."""
    return f"split_part('{words}', '|', cast({index} as int) + 1)"


def skill(index: str) -> str:
    return nth(SKILLS, f"({index}) % {N_SKILLS}")


_SOURCE = nth(BOARDS, "o_orderkey % 5")
_ID = "cast(cast(floor(o_orderkey / 5) as bigint) as string)"
_TS = "cast(o_orderdate as timestamp)"
_SALARY_MIN = (
    "case c_mktsegment when 'MACHINERY' then floor(o_totalprice / 100) "
    "when 'HOUSEHOLD' then floor(o_totalprice) else floor(o_totalprice * 100) end"
)


def _tag(key: str, name: str, weight: str) -> str:
    """One element of the skills array: ids, blank names, NULL names, missing weights."""
    return (
        "'{\"id\":' || cast(" + key + " as string) || ',\"name\":' || case when " + key + " % 41 = 0 then 'null' "
        "when " + key + " % 37 = 0 then '\"  \"' when " + key + " % 5 = 0 then '\" ' || upper(" + name + ") || '\"' "
        "else '\"' || " + name + " || '\"' end || case when " + key + " % 3 = 0 then '' "
        "else ',\"weight\":' || cast(cast(" + weight + " as int) as string) end || '}'"
    )


_TAGS = " || ',' || ".join([
    _tag("pk_min", skill("pk_min"), "q_min"), _tag("pk_max", skill("pk_max * 7"), "q_max"),
    _tag("sk_min", skill("sk_min * 3"), "q_max"), _tag("sk_max", skill("sk_max + n_lines"), "q_min"),
])

POSTING: dict[str, str] = {
    "ordinal": "o_orderkey",
    "source": _SOURCE,
    "source_job_id": _ID,
    "source_url": f"'https://jobs.example.com/' || {_SOURCE} || '/' || {_ID}",
    "parser_version": nth("v2|itviec-v1|linkedin-v1|topcv-v1|careerviet-v1", "o_orderkey % 5"),
    "parsed_at": f"{_TS} + interval 1 day",
    "loaded_at": f"{_TS} + interval 2 day",
    "title": (
        f"case when o_orderkey % 97 = 0 then null else {nth(ROLES, f'(o_orderkey * 7) % {N_ROLES}')} || ' ' || "
        "coalesce(p_name, 'generalist') || case when o_orderkey % 11 = 0 then ' (Remote)' else '' end end"
    ),
    "alias": f"'job-' || {_ID}",
    "company_id": "case when o_orderkey % 5 in (0, 3) then o_custkey end",
    "company_name": "case when o_orderkey % 83 = 0 then '' else c_name end",
    "company_logo_url": "case when o_custkey % 4 = 0 then null else 'https://img.example.com/' || cast(o_custkey as string) || '.png' end",
    "company_profile_text": "cast(null as string)",
    "salary_min": f"cast({_SALARY_MIN} as double)",
    "salary_max": f"cast(case when o_orderkey % 89 = 0 then {_SALARY_MIN} - 1 when o_orderkey % 31 = 0 then null else {_SALARY_MIN} + (o_orderkey % 7) * 1001 end as double)",
    "salary_currency": "case c_mktsegment when 'MACHINERY' then 'USD' when 'HOUSEHOLD' then 'JPY' when 'FURNITURE' then 'EUR' else 'VND' end",
    "is_salary_visible": "o_orderstatus <> 'P'",
    "pretty_salary": "cast(null as string)",
    "job_level": "case o_orderpriority when '1-URGENT' then 'Director and above' when '2-HIGH' then 'Senior' when '3-MEDIUM' then 'Associate' end",
    "years_of_experience": "cast(o_orderkey % 9 as int)",
    "employment_type": nth("Full-time|Part-time|Remote contract|Contract", "o_orderkey % 4"),
    "job_function": (
        "case when o_orderkey % 43 = 0 then null when o_orderkey % 5 = 0 then "
        "'{\"parentId\":' || cast(o_orderkey % 30 as string) || ',\"children\":[{\"id\":' || cast(o_orderkey % 50 as string) || ',\"name\":\"' || coalesce(p_brand, '?') || '\"}]}' "
        "when o_orderkey % 5 = 1 then 'Data Analyst' when o_orderkey % 5 = 2 then 'Engineering and IT' "
        "when o_orderkey % 10 = 3 then '[1,2]' else '7' end"
    ),
    "locations": (
        "case when o_orderkey % 19 = 0 then '[]' when o_orderkey % 23 = 0 then '[{\"city\":\"Vietnam\"}]' "
        "when o_orderkey % 3 = 0 then '[{\"city\":\"' || n_name || '\",\"city_vi\":\"\",\"address\":\"' || c_name || '\"}]' "
        "when o_orderkey % 3 = 1 then '[{\"city\":\"' || lower(n_name) || ', ' || r_name || '\"},{\"city\":\"Hanoi\"}]' "
        "else '[{\"city\":\"' || n_name || ', ' || r_name || '\"}]' end"
    ),
    "industries": "'[]'",
    "skills": f"case when pk_min is null then '[]' when o_orderkey % 101 = 0 then {_tag('pk_min', skill('pk_min'), 'q_min')} else '[' || {_TAGS} || ']' end",
    "benefits": "'[]'",
    "job_description_text": (
        "case when o_orderkey % 13 = 0 then null when o_orderkey % 11 = 0 then '   ' else "
        f"'Build ' || lower(coalesce(p_type, 'any')) || ' systems with ' || {skill('o_custkey')} || ' and ' || {skill('o_custkey * 3 + 1')} || '.' end"
    ),
    "job_requirement_text": f"case when o_orderkey % 6 = 0 then null else 'Required: ' || lower({skill('o_orderkey')}) || '; team player' end",
    "posted_at": f"case when o_orderkey % 71 = 0 then null else {_TS} end",
    "expired_at": f"case when o_orderstatus = 'F' then {_TS} + interval 30 day when o_orderkey % 67 = 0 then {_TS} - interval 3 day end",
    "last_updated_at": f"{_TS} + interval 1 day",
    "is_expired": "o_orderstatus = 'F'",
    "num_of_views": "cast(o_custkey % 500 as int)",
    "num_of_applications": "case when o_custkey % 3 = 0 then null else cast(o_custkey % 40 as int) end",
    "company_size": nth("1-9|10-24|25-99|100-499", "o_custkey % 4"),
    "company_size_id": "cast(o_custkey % 12 as int)",
    "company_color": "cast(null as string)",
    "num_of_recruits": "cast(o_orderkey % 5 as int)",
    "salary_period_id": "cast(o_orderkey % 4 as int)",
    "pretty_salary_vi": "cast(null as string)",
    "pretty_salary_en": "cast(null as string)",
    "working_days": "'Mon-Fri'",
    "working_from_hour": "'8:00'",
    "working_to_hour": "'17:00'",
    "highest_degree_id": "cast(o_custkey % 14 as int)",
    "language_selected": "'Any'",
    "language_selected_vi": "cast(null as string)",
    "range_age": "cast(null as string)",
    "required_resume": "o_orderkey % 2 = 0",
    "required_cover_letter": "o_orderkey % 3 = 0",
    "primary_address": "c_name",
    "contact_name": "cast(null as string)",
    "contact_email": "cast(null as string)",
    "services": "'[]'",
    "canonical_slug": f"'job-' || {_ID}",
    "is_active": "o_orderstatus <> 'F'",
    "online_on": _TS,
}

_LOG_SKILLS = " || ',' || ".join([
    "'{\"name\":\"' || " + skill("pk_max") + " || '\",\"name_raw\":\"' || " + skill("pk_max") + " || '\",\"category\":\"cat' || cast(pk_max % 4 as string) || '\",\"importance\":\"required\",\"confidence\":\"high\"}'",
    "'{\"name\":\" ' || lower(" + skill("sk_min * 3") + ") || ' \",\"name_raw\":\"' || " + skill("sk_min * 3") + " || '\",\"importance\":\"preferred\"}'",
    "'{\"name\":\"' || " + skill("o_custkey") + " || '\",\"name_raw\":null,\"category\":null}'",
    "'{\"name\":\"\",\"name_raw\":\"x\"}'",
])

SKILL_LOG: dict[str, str] = {
    "source": _SOURCE,
    "source_job_id": _ID,
    "skills_json": "case when pk_max is null then '[]' when o_orderkey % 103 = 0 then '{\"name\":\"object\"}' else '[' || " + _LOG_SKILLS + " || ']' end",
    "experience_years_min": "cast(o_orderkey % 6 as int)",
    "seniority_level": "cast(null as string)",
    "model_used": "'model-a'",
    "tokens_used": "cast(o_orderkey % 900 as int)",
    "extracted_at": f"{_TS} + interval 2 day",
}

GENERATION: dict[str, str] = {
    "source": _SOURCE,
    "source_job_id": _ID,
    "run_id": "'run' || cast(r as string)",
    "run_at": "cast('2001-06-20 00:00:00' as timestamp) + r * interval 1 day",
    "job_category": nth("Other|Product Manager|Software Engineer|Other|QA Engineer", "(o_orderkey + r) % 5"),
    "category_method": nth("default|title_keyword|title_keyword|default|title_keyword", "(o_orderkey + r) % 5"),
    "category_confidence": "cast(0.5 as double)",
    "category_matched_on": "cast(null as string)",
}

FRONTIER: dict[str, str] = {
    "job_id": "cast(event_id as string)",
    "source": nth(BOARDS, "user_id % 5"),
    "status": "case event_type when 'purchase' then 'success' when 'error' then 'failed' when 'view' then 'pending' when 'click' then 'in_progress' else 'expired' end",
    "url": f"'https://jobs.example.com/' || cast(event_id as string)",
    "first_seen_at": "cast(ts as timestamp) - interval 2 day",
    "last_attempt_at": "case when event_type = 'view' then null else cast(ts as timestamp) end",
    "crawled_at": "case when event_type in ('purchase', 'signup') then cast(ts as timestamp) end",
    "retry_count": "cast(cast(floor(value) as bigint) % 4 as int)",
    "http_status": "case event_type when 'purchase' then 200 when 'error' then cast(403 + user_id % 2 as int) when 'signup' then 404 end",
    "error_message": "case when event_type = 'error' then 'blocked ' || props end",
    "raw_object_key": "case when event_type = 'purchase' then 'raw/' || cast(event_id as string) end",
    "crawl_run_id": "cast(null as string)",
}


# ------------------------------------------------------------------ Spark side

_opened: dict[tuple[str, str], DataFrame] = {}
# Tables with per-row work, and the key they are dealt by where the run asks for it.
_SPREAD = {"orders": "o_orderkey", "documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; its footer is looked at once per session."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _opened:
        table = spark.read.parquet(key[1])
        parts = int(os.environ.get("SUITE_PARTITIONS", "0"))  # a run over small one-split tables may ask for more
        _opened[key] = table.repartition(parts, _SPREAD[name]) if parts and name in _SPREAD else table
    return _opened[key]


def project(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} as {n}" for n, e in exprs.items()])


def order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with customer, place and a bounded summary of their lines."""
    pin_utc(spark)
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("pk_min"), F.max("l_partkey").alias("pk_max"),
        F.min("l_suppkey").alias("sk_min"), F.max("l_suppkey").alias("sk_max"),
        F.min("l_quantity").alias("q_min"), F.max("l_quantity").alias("q_max"),
        F.count("*").alias("n_lines"),
    )
    return (
        read(spark, sf_dir, "orders")
        .join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(read(spark, sf_dir, "part"), F.col("pk_min") == F.col("p_partkey"), "left")
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(order_base(spark, sf_dir), POSTING)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings that passed the record checks."""
    return postings(spark, sf_dir).filter("title is not null and company_name <> ''")


def skill_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(order_base(spark, sf_dir), SKILL_LOG)


def half_done_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which every second posting is still to be done, for the queries that look for those."""
    return project(order_base(spark, sf_dir).filter("o_orderkey % 2 = 0"), SKILL_LOG)


def generations(spark: SparkSession, sf_dir: str, runs: int = 4) -> DataFrame:
    numbers = ", ".join(str(i) for i in range(1, runs + 1))
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.expr(f"explode(array({numbers}))").alias("r")
    )
    pin_utc(spark)
    return project(rows, GENERATION)


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return project(read(spark, sf_dir, "events"), FRONTIER)


def city_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("city_raw_en"),
            F.expr("'City ' || cast(n_nationkey % 12 as string)").alias("city_canonical"),
            F.col("r_name").alias("region"),
        )
    )


def title_map(spark: SparkSession) -> DataFrame:
    return seeds.table(
        spark, [(k, c, str(p)) for k, c, p in TITLE_RULES], "keyword string, job_category string, priority int"
    )


def function_map(spark: SparkSession) -> DataFrame:
    return seeds.table(spark, FUNCTION_RULES, "vnw_function string, job_category string, beats_title boolean")


_lookups: dict[tuple[str, str], models.Lookups] = {}


def lookups(spark: SparkSession, sf_dir: str) -> models.Lookups:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lookups:
        _lookups[key] = _build_lookups(spark, sf_dir)
    return _lookups[key]


def _build_lookups(spark: SparkSession, sf_dir: str) -> models.Lookups:
    return models.Lookups(
        city_map=city_map(spark, sf_dir),
        title_map=title_map(spark),
        function_map=function_map(spark),
        level_map=seeds.seed(spark, "job_level_map"),
        fx_rates=seeds.seed(spark, "fx_rates"),
        periods=seeds.seed(spark, "salary_period_map"),
        degrees=seeds.seed(spark, "degree_map"),
        sizes=seeds.seed(spark, "company_size_map"),
    )


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def day():
    return F.lit(AS_OF_DAY).cast("date")


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_job_detail(jobs(spark, sf_dir), as_of())


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_job_detail(staged(spark, sf_dir), generations(spark, sf_dir), lookups(spark, sf_dir))


def skill_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_skill_long(silver(spark, sf_dir))


def skill_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_skill_enriched(skill_log(spark, sf_dir))


def skill_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.silver_skill_unified(skill_long(spark, sf_dir), skill_enriched(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fact after two consecutive days: yesterday lacks every 7th job, today every 9th."""
    from vacancia.operators.merge import merge_delete_insert

    s = silver(spark, sf_dir)
    number = F.col("source_job_id").cast("bigint")
    yesterday = models.fct_jobs_snapshot(s.filter(number % 7 != 0), F.lit(PREV_DAY).cast("date"))
    today = models.fct_jobs_snapshot(s.filter(number % 9 != 0), day())
    return merge_delete_insert(yesterday, today, ["source", "source_job_id", "snapshot_date"])


# ------------------------------------------------------------------ SQL side

def _select(exprs: dict[str, str], frm: str) -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in exprs.items()) + " from " + frm


def values(rows: list, names: str) -> str:
    def lit(x) -> str:
        if x is None:
            return "null"
        return str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"select * from (values {body}) v({names})"


_first = (
    "(select r.{out} from {table} r where contains(lower({text}), r.keyword) "
    "order by r.priority, length(r.keyword) desc, r.keyword, r.{out} limit 1)"
)
_fuzzy = (
    "(select r.{out} from city_map r where contains(lower({text}), lower(r.city_raw_en)) "
    "order by length(r.city_raw_en) desc, r.city_raw_en, r.city_canonical limit 1)"
)


def _band(amount: str) -> str:
    f = f"round_even({amount} * vnd_rate * factor, 0)"
    return f"case when is_salary_visible and {f} between 1000000 and 5000000000 then {f} end"


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


cte("lines", [], """select l_orderkey, min(l_partkey) pk_min, max(l_partkey) pk_max, min(l_suppkey) sk_min,
  max(l_suppkey) sk_max, min(l_quantity) q_min, max(l_quantity) q_max, count(*) n_lines from lineitem group by 1""")
cte("order_base", ["lines"], """select * from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  left join lines on o_orderkey = l_orderkey left join part on pk_min = p_partkey""")
cte("postings", ["order_base"], _select(POSTING, "order_base"))
cte("jobs", ["postings"], "select * from postings where title is not null and company_name <> ''")
cte("skill_log", ["order_base"], _select(SKILL_LOG, "order_base"))
cte("half_done_log", ["order_base"], _select(SKILL_LOG, "order_base where o_orderkey % 2 = 0"))
cte("generations", [], _select(GENERATION, "(select o_orderkey, unnest([1, 2, 3, 4]) as r from orders)"))
cte("frontier", [], _select(FRONTIER, "events"))
cte("city_map", [], """select n_name as city_raw_en, 'City ' || cast(n_nationkey % 12 as string) as city_canonical,
  r_name as region from nation join region on n_regionkey = r_regionkey""")
cte("title_map", [], values(TITLE_RULES, "keyword, job_category, priority"))
cte("function_map", [], values([(f, c, b) for f, c, b in FUNCTION_RULES], "vnw_function, job_category, beats_title"))
cte("level_map", [], values([(k, v, int(p)) for k, v, p in seeds.lines(seeds.JOB_LEVEL_KEYWORDS)], "keyword, job_level, priority"))
cte("raw_levels", [], values(seeds.lines(seeds.RAW_LEVELS), "raw_level, level"))
cte("fx", [], "select currency, cast(vnd_rate as double) as vnd_rate from ("
    + values([(c, r) for c, r, _ in seeds.lines(seeds.FX_RATES)], "currency, vnd_rate") + ")")
cte("periods", [], values([(int(i), n, m) for i, n, m in seeds.lines(seeds.SALARY_PERIODS)], "period_id, period_label, months"))
cte("degrees", [], values([(int(i), n) for i, n in seeds.lines(seeds.DEGREES)], "degree_id, degree_label"))
cte("sizes", [], values([(int(i), a, b) for i, a, b in seeds.lines(seeds.COMPANY_SIZES)], "size_id, size_label, size_bucket"))
cte("staged", ["jobs"], f"""select *, not is_expired_calc as is_active_calc from (select *,
  case when expired_at is not null then expired_at < timestamp '{AS_OF}'
       when posted_at is not null then posted_at < timestamp '{AS_OF}' - interval 45 day
       else false end as is_expired_calc from jobs)""")
cte("norm", ["generations"], """select source, source_job_id, arg_max(job_category, run_at) as norm_category
  from generations group by all""")
cte("silver_in", ["staged", "norm", "fx", "periods", "degrees", "sizes", "function_map"], """select s.*, n.norm_category,
  fx.vnd_rate, p.period_label, p.months, d.degree_label, z.size_label, z.size_bucket,
  f.job_category as fn_category, f.beats_title,
  nullif(json_extract_string(locations, '$[0].city'), '') as city_raw_en,
  nullif(json_extract_string(locations, '$[0].city_vi'), '') as city_raw_vi,
  nullif(json_extract_string(locations, '$[0].address'), '') as primary_address_extracted,
  coalesce(s.salary_period_id = 2 and s.salary_min * coalesce(fx.vnd_rate, 1) > 10000000, false) as hourly_wrong,
  case when s.salary_period_id = 2 and s.salary_min * coalesce(fx.vnd_rate, 1) > 10000000 then 1.0::double
       else coalesce(cast(p.months as double), 1.0) end as factor
  from staged s left join norm n using (source, source_job_id)
  left join fx on fx.currency = s.salary_currency left join periods p on p.period_id = s.salary_period_id
  left join degrees d on d.degree_id = s.highest_degree_id left join sizes z on z.size_id = s.company_size_id
  left join function_map f on s.source = 'vietnamworks' and f.vnw_function = json_extract_string(
    case when s.source = 'vietnamworks' then s.job_function end, '$.children[0].name')""")
cte("silver_all", ["silver_in", "city_map", "title_map", "level_map", "raw_levels"], f"""select i.* exclude (is_expired, is_active, job_level, salary_period_id),
  is_expired_calc as is_expired, is_active_calc as is_active, i.job_level as job_level_raw,
  case when hourly_wrong then 1 else i.salary_period_id end as salary_period_id,
  period_label as salary_period_label, size_label as company_size_label, size_bucket as company_size_bucket,
  {_band('salary_min')} as salary_vnd_monthly_min, {_band('salary_max')} as salary_vnd_monthly_max,
  {_band('((salary_min + salary_max) / 2.0)')} as salary_vnd_monthly_avg,
  coalesce(cx.city_canonical, {_fuzzy.format(out='city_canonical', text='i.city_raw_en')}) as city_canonical,
  coalesce(cx.region, {_fuzzy.format(out='region', text='i.city_raw_en')}) as region,
  coalesce(rl.level, {_first.format(out='job_level', table='level_map', text='i.title')}, 'Mid-level') as job_level,
  coalesce(case when cast(beats_title as boolean) then fn_category end,
    {_first.format(out='job_category', table='title_map', text='i.title')}, fn_category, norm_category, 'Other') as job_category
  from silver_in i left join city_map cx on cx.city_raw_en = i.city_raw_en
  left join raw_levels rl on rl.raw_level = i.job_level""")
cte("silver", ["silver_all"], "select " + ", ".join(models.SILVER_COLUMNS) + " from silver_all")
cte("skill_long", ["silver"], """select source, source_job_id, company_id, company_name, city_canonical, region,
  salary_vnd_monthly_avg, job_level, try_cast(s->>'id' as bigint) as skill_id,
  lower(trim(s->>'name')) as skill_name_norm, s->>'name' as skill_name_raw,
  coalesce(try_cast(s->>'weight' as int), 0) as skill_weight, parsed_at
  from (select *, unnest(cast(case when json_type(skills) = 'ARRAY' then skills else '[]' end as json[])) as s from silver)
  where trim(s->>'name') <> ''""")
cte("skill_enriched", ["skill_log"], """select source, source_job_id, lower(trim(s->>'name')) as skill_name,
  s->>'name_raw' as skill_name_raw, coalesce(s->>'category', 'other') as skill_category,
  coalesce(s->>'importance', 'mentioned') as importance, coalesce(s->>'confidence', 'medium') as confidence,
  model_used, extracted_at
  from (select *, unnest(cast(case when json_type(skills_json) = 'ARRAY' then skills_json else '[]' end as json[])) as s from skill_log)
  where trim(s->>'name') <> ''""")
cte("skill_unified", ["skill_long", "skill_enriched"], """select source, source_job_id, skill_name, skill_name_raw,
  extraction_method, skill_weight, skill_category, importance, extracted_at from (
  select *, row_number() over (partition by source, source_job_id, skill_name order by skill_weight desc,
    extraction_method desc, skill_name_raw nulls last, skill_category nulls last, importance nulls last) as rn from (
    select source, source_job_id, skill_name_norm as skill_name, skill_name_raw, 'source_tag' as extraction_method,
      skill_weight, null::varchar as skill_category, null::varchar as importance, parsed_at as extracted_at from skill_long
    union all
    select source, source_job_id, skill_name, skill_name_raw, 'llm',
      case importance when 'required' then 80 when 'preferred' then 50 else 20 end,
      skill_category, importance, extracted_at from skill_enriched)) where rn = 1""")
cte("fact", ["silver"], "select source, source_job_id, snapshot_date, " + ", ".join(models.FACT_COLUMNS) + f""" from (
  select *, date '{PREV_DAY}' as snapshot_date from silver where cast(source_job_id as bigint) % 7 <> 0
  union all select *, date '{AS_OF_DAY}' from silver where cast(source_job_id as bigint) % 9 <> 0)""")


def sql(body: str, *deps: str) -> str:
    """body with the CTEs it needs, in dependency order."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for d in CTES[name][0]:
            visit(d)
        if name not in needed:
            needed.append(name)

    for d in deps:
        visit(d)
    if not needed:
        return body
    head = ",\n".join(f"{n} as ({CTES[n][1]})" for n in needed)
    if body.lstrip().lower().startswith("with recursive "):
        return f"with recursive {head},\n{body.lstrip()[15:]}"
    if body.lstrip().lower().startswith("with "):
        return f"with {head},\n{body.lstrip()[5:]}"
    return f"with {head}\n{body}"
