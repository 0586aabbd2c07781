"""The end-to-end models."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import testbed as tb
from suite.registry import register
from vacancia.plans import graph, models
from vacancia.session import work_dir

DAY = f"date '{tb.AS_OF_DAY}' as snapshot_date"


def _cols(names) -> str:
    return ", ".join(names)


register(
    "stg_job_detail",
    lambda s, d: tb.staged(s, d).select(
        "source", "source_job_id", "title", "posted_at", "expired_at", "parsed_at", "is_expired_calc", "is_active_calc"
    ),
    tb.sql("select source, source_job_id, title, posted_at, expired_at, parsed_at, is_expired_calc, is_active_calc from staged", "staged"),
)
register("silver_job_detail", tb.silver, tb.sql("select * from silver", "silver"))
register(
    "silver_company_dim",
    lambda s, d: models.silver_company_dim(tb.silver(s, d)),
    tb.sql("""select l.company_id, company_name, company_logo_url, company_color, company_size_id, company_size_label,
      company_size_bucket, city_canonical as primary_city, region, n_active_jobs, avg_salary_vnd, avg_views, avg_apps,
      parsed_at as last_seen_at
    from (select *, row_number() over (partition by company_id order by parsed_at desc, source desc, source_job_id desc) rn
          from silver where company_id is not null) l
    join (select company_id, count(*) n_active_jobs, round_even(avg(salary_vnd_monthly_avg), 0) avg_salary_vnd,
          round(avg(num_of_views)) avg_views, round(avg(num_of_applications)) avg_apps
          from silver where company_id is not null group by 1) a on a.company_id = l.company_id
    where rn = 1""", "silver"),
)
register("silver_skill_long", tb.skill_long, tb.sql("select * from skill_long", "skill_long"))
register("silver_skill_enriched", tb.skill_enriched, tb.sql("select * from skill_enriched", "skill_enriched"))
register("silver_skill_unified", tb.skill_unified, tb.sql("select * from skill_unified", "skill_unified"))
register("fct_jobs_daily", tb.fact, tb.sql("select * from fact", "fact"))
register(
    "mart_company_hiring",
    lambda s, d: models.mart_company_hiring(tb.silver(s, d), tb.day()),
    tb.sql(f"""select company_id, max(company_name) company_name, max(company_size_bucket) company_size,
      max(company_size_label) company_size_label, mode(city_canonical order by city_canonical) primary_city,
      mode(region order by region) primary_region, count(*) n_jobs, round(avg(num_of_views)) avg_views,
      round(avg(num_of_applications)) avg_apps, round_even(avg(salary_vnd_monthly_avg), 0) avg_salary_vnd,
      round_even(min(salary_vnd_monthly_min), 0) min_salary_vnd, round_even(max(salary_vnd_monthly_max), 0) max_salary_vnd,
      max(parsed_at) last_seen_at, {DAY} from silver where company_id is not null group by company_id""", "silver"),
)
register(
    "mart_salary_by_level",
    lambda s, d: models.mart_salary_by_level(tb.silver(s, d), tb.day()),
    tb.sql(f"""select job_category, job_level, coalesce(city_canonical, 'Unknown') city_canonical,
      coalesce(region, 'Unknown') region, count(*) n_visible_jobs,
      round_even(quantile_cont(salary_vnd_monthly_avg, 0.25), 0) p25_vnd,
      round_even(quantile_cont(salary_vnd_monthly_avg, 0.5), 0) p50_vnd,
      round_even(quantile_cont(salary_vnd_monthly_avg, 0.75), 0) p75_vnd,
      round_even(avg(salary_vnd_monthly_avg), 0) avg_salary_vnd, round_even(min(salary_vnd_monthly_min), 0) min_salary_vnd,
      round_even(max(salary_vnd_monthly_max), 0) max_salary_vnd, {DAY}
    from silver where salary_vnd_monthly_avg is not null group by 1, 2, 3, 4""", "silver"),
)

def _mean(total: str, n: str) -> str:
    return f"round_even(sum({total}) / nullif(sum({n}), 0), 0)"


# Jobs and tags are summed up by id first; an id that several boards share multiplies its sums.
tb.cte("salaries_by_id", ["silver"], """select source_job_id, count(*) jobs, sum(salary_vnd_monthly_avg) total, count(salary_vnd_monthly_avg) paid,
    sum(salary_vnd_monthly_avg) filter (where job_level in ('Manager', 'Director+')) lead_total, count(salary_vnd_monthly_avg) filter (where job_level in ('Manager', 'Director+')) lead_paid,
    sum(salary_vnd_monthly_avg) filter (where job_level = 'Senior') senior_total, count(salary_vnd_monthly_avg) filter (where job_level = 'Senior') senior_paid
  from silver where job_category in ('Data Engineer', 'Data Analyst', 'AI Engineer', 'Data Scientist', 'Backend Developer', 'Other') group by source_job_id""")
tb.cte("tags_by_id", ["skill_long"], "select source_job_id, skill_name_norm skill, count(*) tags, sum(skill_weight) weight from skill_long group by all")
tb.cte("mart_demand", ["salaries_by_id", "tags_by_id"], f"""select skill, count(*) n_jobs, floor((2000 * count(*) + whole) / (2 * whole)) / 10 pct_of_jobs,
    {_mean('tags * total', 'tags * paid')} avg_salary_vnd, {_mean('tags * lead_total', 'tags * lead_paid')} avg_salary_manager_vnd, {_mean('tags * senior_total', 'tags * senior_paid')} avg_salary_senior_vnd,
    floor((20 * sum(weight * jobs) + sum(tags * jobs)) / (2 * sum(tags * jobs))) / 10 avg_weight, {DAY}
  from tags_by_id join salaries_by_id using (source_job_id), (select sum(jobs) whole from salaries_by_id) group by skill, whole having count(*) > 1""")
register(
    "mart_skill_demand",
    lambda s, d: models.mart_skill_demand(
        (silver := tb.silver(s, d)), models.silver_skill_long(silver), tb.day()
    ),
    tb.sql("select * from mart_demand", "mart_demand"),
)

_PAY = "salary_vnd_monthly_avg"
register(
    "mart_skill_demand_v2",
    lambda s, d: models.mart_skill_demand_v2(
        (silver := tb.silver(s, d)),
        models.silver_skill_unified(models.silver_skill_long(silver), tb.skill_enriched(s, d)), tb.day(),
    ),
    tb.sql(f"""with marked as (select u.*, {_PAY} pay, case when job_level in ('Manager', 'Director+') then {_PAY} end lead_pay, case when job_level = 'Senior' then {_PAY} end senior_pay
        from skill_unified u join silver using (source, source_job_id)),
    by_id as (select skill_name, source_job_id, max(skill_category) kind, sum(pay) pay, count(pay) paid, sum(lead_pay) lead_pay, count(lead_pay) lead_paid, sum(senior_pay) senior_pay,
        count(senior_pay) senior_paid, sum((importance = 'required')::int) must, sum((importance = 'preferred')::int) nice, sum((extraction_method = 'llm')::int) llm, count(*) marks
      from marked group by skill_name, source_job_id)
    select skill_name skill, max(kind) skill_category, count(*) n_jobs, floor((2000 * count(*) + whole) / (2 * whole)) / 10 pct_of_jobs, {_mean('pay', 'paid')} avg_salary_vnd,
      {_mean('lead_pay', 'lead_paid')} avg_salary_manager_vnd, {_mean('senior_pay', 'senior_paid')} avg_salary_senior_vnd, cast(coalesce(sum(must), 0) as bigint) n_required,
      cast(coalesce(sum(nice), 0) as bigint) n_preferred, cast(sum(llm) as bigint) n_llm_extracted, cast(sum(marks) - sum(llm) as bigint) n_source_tagged, {DAY}
    from by_id, (select count(*) whole from silver) group by skill_name, whole having count(*) > 1""", "silver", "skill_unified"),
)
register(
    "mart_skill_cooccurrence",
    lambda s, d: models.mart_skill_cooccurrence(tb.skill_unified(s, d), tb.day()),
    tb.sql(f"""select a.skill_name skill_a, b.skill_name skill_b, count(distinct a.source_job_id) cooccurrence_count, {DAY}
    from skill_unified a join skill_unified b on a.source = b.source and a.source_job_id = b.source_job_id
      and a.skill_name < b.skill_name group by 1, 2 having count(distinct a.source_job_id) >= 3""", "skill_unified"),
)
register(
    "mart_skill_trend",
    lambda s, d: models.mart_skill_trend(tb.fact(s, d), tb.skill_unified(s, d)),
    tb.sql("""select skill_name skill, cast(date_trunc('week', snapshot_date) as date) as week,
      count(distinct d.source_job_id) n_jobs, floor(avg(salary_vnd_monthly_avg) / 100000.0::double + 0.5::double) / 10.0::double avg_salary_m
    from skill_unified s join fact d on d.source = s.source and d.source_job_id = s.source_job_id
    where is_active group by 1, 2 having count(distinct d.source_job_id) >= 2""", "skill_unified", "fact"),
)
# One text of all a job's skills, so that a flag is one search in it.
tb.cte("skill_texts", ["skill_long"], "select source, source_job_id, '|' || string_agg(skill_name_norm, '|') || '|' names, count(*) n_skills from skill_long group by all")


def _named_any(*parts: str) -> str:
    return " or ".join(f"coalesce(contains(names, '{p}'), false)" for p in parts)


register(
    "job_features",
    lambda s, d: models.job_features((silver := tb.silver(s, d)), models.silver_skill_long(silver), tb.day()),
    tb.sql(f"""select source, source_job_id, {DAY}, salary_vnd_monthly_avg, is_salary_visible has_salary_visible, {_named_any('|python|')} has_python, {_named_any('|sql|')} has_sql,
      {_named_any(*'aws cloud azure gcp'.split())} has_aws_cloud, {_named_any(*'ml ai llm machine deep'.split())} has_ml_ai, {_named_any(*'spark hadoop kafka flink'.split())} has_bigdata,
      {_named_any('power bi', 'tableau', 'looker', 'qlik')} has_bi_tool, coalesce(n_skills, 0) n_skills, list_contains(['Senior', 'Manager', 'Director+'], job_level) is_senior,
      contains(lower(coalesce(employment_type, '')), 'remote') or regexp_matches(lower(title), 'remote|wfh|work from home') is_remote,
      job_level, city_canonical, region, degree_label, company_size_bucket, case when company_id is null then 1 else count(*) over (partition by company_id) end company_n_active_jobs,
      coalesce(num_of_views, 0) num_of_views, coalesce(num_of_applications, 0) num_of_applications, date '{tb.AS_OF_DAY}' - cast(posted_at as date) days_since_posted, parsed_at
    from silver left join skill_texts using (source, source_job_id)""", "silver", "skill_texts"),
)


# ------------------------------------------------------------------ the stored graph

STORED = [("stg_job_detail", "view"), ("silver_skill_enriched", "view")]
_BUILT_AGAIN = "fct_jobs_daily mart_company_hiring mart_salary_by_level mart_skill_demand mart_skill_demand_v2 mart_skill_cooccurrence mart_skill_trend job_features".split()


def _graph(s, d):
    """Three runs of the stored graph, the second unchanged, the third a day later: what each did, and tables read back."""
    tables = [f"{d}/{t}.parquet" for t in ("orders", "lineitem", "customer", "nation", "region", "part")]
    mark = graph.files_fingerprint(s, *tables)
    sources = {n: graph.Source(f(s, d), mark) for n, f in (("jobs", tb.jobs), ("generations", tb.generations), ("skill_log", tb.skill_log))}
    stored = graph.Graph(s, work_dir(s, "graph"), graph.warehouse(tb.lookups(s, d)))
    said = []
    for run, day in (("run1", tb.PREV_DAY), ("run2", tb.PREV_DAY), ("run3", tb.AS_OF_DAY)):
        done = stored.run(sources, {"as_of": f"timestamp '{tb.AS_OF}'", "day": f"date '{day}'"})
        said += [(run, name, action) for name, action in done]
    report = s.createDataFrame(said, "part string, name string, detail string").selectExpr("*", "cast(null as bigint) as n", "cast(null as double) as v")
    trend = stored.frames["mart_skill_trend"].selectExpr("'trend' as part", "skill as name", "cast(week as string) as detail", "n_jobs as n", "cast(avg_salary_m as double) as v")
    days = stored.frames["fct_jobs_daily"].groupBy("snapshot_date").agg(F.count("*").alias("n"), F.max("salary_vnd_monthly_avg").alias("v")).selectExpr(
        "'fact' as part", "cast(snapshot_date as string) as name", "cast(null as string) as detail", "n", "v")
    pay = stored.frames["mart_salary_by_level"].selectExpr(
        "'salary' as part", "concat_ws('|', job_category, job_level, city_canonical, region) as name", "cast(snapshot_date as string) as detail", "n_visible_jobs as n", "p50_vnd as v")
    return report.unionByName(trend).unionByName(days).unionByName(pay)


def _said() -> list[tuple[str, str, str]]:
    names = [x.name for x in graph.warehouse(None)]
    out = []
    for run in ("run1", "run2", "run3"):
        for name in names:
            changed = run == "run1" or run == "run3" and name in _BUILT_AGAIN
            out.append((run, name, dict(STORED).get(name, "built" if changed else "kept")))
    return out


register(
    "model_graph", _graph,
    tb.sql("select part, name, detail, null::bigint n, null::double v from (" + tb.values(_said(), "part, name, detail") + f""")
    union all select 'trend', skill_name, cast(cast(date_trunc('week', {DAY.split(' as ')[0]}) as date) as varchar), count(distinct source_job_id), floor(avg(salary_vnd_monthly_avg) / 100000.0::double + 0.5::double) / 10.0::double
      from skill_unified join silver using (source, source_job_id) where is_active group by skill_name having count(distinct source_job_id) > 1
    union all select 'fact', cast(day as varchar), null, count(*), max(salary_vnd_monthly_avg) from silver, (select unnest([date '{tb.PREV_DAY}', date '{tb.AS_OF_DAY}']) as day) group by day
    union all select 'salary', concat_ws('|', job_category, job_level, coalesce(city_canonical, 'Unknown'), coalesce(region, 'Unknown')), '{tb.AS_OF_DAY}', count(*), round_even(quantile_cont(salary_vnd_monthly_avg, 0.5), 0)
      from silver where salary_vnd_monthly_avg is not null group by job_category, job_level, city_canonical, region""", "silver", "skill_unified"),
)


def _part_of_graph(name, *others):
    """One model of the graph, built with those it needs and read as a reader of the graph does."""
    def run(s, d):
        stored = graph.Graph(s, work_dir(s, "graph"), [x for x in graph.warehouse(tb.lookups(s, d)) if x.name in (name, *others)])
        stored.run({"jobs": graph.Source(tb.jobs(s, d), "once"), "generations": graph.Source(tb.generations(s, d), "once")}, {"as_of": f"timestamp '{tb.AS_OF}'", "day": f"date '{tb.AS_OF_DAY}'"})
        return stored.frames[name]
    return run


register(
    "sink_view",
    lambda s, d: _part_of_graph("stg_job_detail")(s, d).select("source", "source_job_id", "title", "is_expired_calc", "is_active_calc"),
    tb.sql("select source, source_job_id, title, is_expired_calc, is_active_calc from staged", "staged"),
)
register(
    "sink_table",
    lambda s, d: _part_of_graph("silver_skill_long", "stg_job_detail", "silver_job_detail")(s, d),
    tb.sql("select * from skill_long", "skill_long"),
)
