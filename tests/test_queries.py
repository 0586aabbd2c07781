"""Registered queries against their SQL. SUITE=all runs every one of them."""

import os

import pytest

import check
from suite import registry

SF = "/root/testdata/sf0.001"
registry.load()
CORE = """
silver_job_detail silver_company_dim silver_skill_unified fct_jobs_daily mart_salary_by_level mart_skill_demand
mart_skill_cooccurrence mart_skill_trend job_features upsert_last_wins upsert_newest_wins merge_delete_insert
drift_upsert frontier_upsert frontier_claim frontier_apply_outcomes validate_focus split_valid_rejected
classify_title extract_skills_by_taxonomy parse_extraction_response jobposting_careerviet jobposting_linkedin
html_to_text search_dedup_counters seed_from_urls_topcv report_kpis weekly_skill_change alert_match alert_cap
dq_run_checks gfs_retention append_generation prune_keep_newest_runs normalize_run seed_from_listings frontier_stored_cycle
parse_and_load_batch replay_rejects model_graph classify_level resolve_city first_match_by_join job_clusters best_jobs
archive_parquet_zstd scan_html_gz scan_function_taxonomy
""".split()
NAMES = list(registry.QUERIES) if os.environ.get("SUITE") == "all" else CORE


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = check.table([tuple(r) for r in df.collect()], df.columns)
    cur = con.execute(registry.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert got == check.table(cur.fetchall(), cols)
    assert got[1]


def test_every_query_has_sql():
    assert not set(registry.QUERIES) - set(registry.ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns[:2] == ["job_category", "job_level"]
    assert set(e.oracle_sql()) <= set(e.queries())
