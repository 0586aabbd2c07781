"""Stored tables, scans, publishing, streaming, alerts, percentiles."""

import datetime as dt
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vacancia.functions.dates import parse_since
from vacancia.operators import alerts, frontier, merge, skills
from vacancia.operators.quantiles import exact_percentiles
from vacancia.plans import loader
from vacancia.schemas import JOB_TABLE
from vacancia.sources import readers, writers
from vacancia.streaming.ingest import stream_ingest


def record(job, **over):
    return {"source": "itviec", "source_job_id": job, "parser_version": "v", "parsed_at": "2024-01-01T00:00:00Z", "title": "T",
            "company_name": "C", "locations": [{"city": "Hanoi"}], "job_function": {"children": [{"id": 1}]}, **over}


def put(folder, name, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(body if isinstance(body, str) else json.dumps(body))


def jobs(spark, path):
    return {r.source_job_id: r for r in spark.read.schema(JOB_TABLE).parquet(path).collect()}


def test_load_job(spark, as_of, tmp_path):
    src, target, rejects = (str(tmp_path / n) for n in ("in", "jobs", "rejects"))
    put(src, "1.json", record("1"))
    put(src, "2.json", record("2", title=""))
    put(src, "3.json", "{not json")
    put(src, "4.json", record(""))
    put(src, "note.txt", "skip me")
    old = os.path.join(src, "5.json")
    put(src, "5.json", record("5"))
    os.utime(old, (1_600_000_000, 1_600_000_000))
    since = parse_since("2021-01-01")
    dry = loader.load_job_detail(spark, src, target, rejects, as_of(), since=since, dry_run=True, buckets=2).first().asDict()
    assert dry == {"loaded": 1, "rejected": 1, "skipped": 1, "failed": 2} and not os.path.exists(target)
    loader.load_job_detail(spark, src, target, rejects, as_of(), since=since, buckets=2)
    got = jobs(spark, target)
    assert list(got) == ["1"] and json.loads(got["1"].locations) == [{"city": "Hanoi"}] and got["1"].skills == "[]"
    q = spark.read.parquet(rejects).first()
    assert (q.source_job_id, q.reject_reason, json.loads(q.payload)["company_name"]) == ("2", "MISSING_TITLE", "C")
    split = loader.replay_rejects(spark.read.parquet(rejects), F.lit(None).cast("struct<reason:string,detail:string>"))
    assert split.valid.count() == 1
    put(src, "1.json", record("1", title="new", parsed_at="2020-01-01T00:00:00Z"))
    loader.load_job_detail(spark, src, target, rejects, as_of("2025-01-01 00:00:00"), buckets=2)
    got = jobs(spark, target)
    assert got["1"].title == "new" and got["1"].loaded_at.year == 2024 and set(got) == {"1", "5"}


def test_repeated_load_rejects_once(spark, as_of, tmp_path):
    src, target, rejects = (str(tmp_path / n) for n in ("in", "jobs", "rejects"))
    put(src, "1.json", record("1"))
    put(src, "2.json", record("2", title=""))
    for load in ("monday", "monday", "tuesday"):
        loader.load_job_detail(spark, src, target, rejects, as_of(), buckets=2, load_id=load)
    assert sorted(r.load_id for r in spark.read.parquet(rejects).collect()) == ["monday", "tuesday"] and set(jobs(spark, target)) == {"1"}


def test_stream_ingest_newest_wins(spark, as_of, tmp_path):
    src, target, rejects, ck = (str(tmp_path / n) for n in ("in", "jobs", "rejects", "ck"))
    put(src, "a.json", record("1", title="old", parsed_at="2024-01-02T00:00:00Z"))
    put(src, "b.json", record("2", title=""))
    stream_ingest(spark, src, target, rejects, ck, as_of(), buckets=2).awaitTermination()
    put(src, "c.json", record("1", title="older", parsed_at="2024-01-01T00:00:00Z"))
    put(src, "d.json", record("3"))
    stream_ingest(spark, src, target, rejects, ck, as_of(), buckets=2).awaitTermination()
    got = jobs(spark, target)
    assert got["1"].title == "old" and set(got) == {"1", "3"}
    assert spark.read.parquet(rejects).count() == 1


def test_scans(spark, tmp_path):
    folder = str(tmp_path / "html")
    os.makedirs(folder)
    with gzip.open(os.path.join(folder, "77.html.gz"), "wb") as f:
        f.write("<p>xin chào\nline</p>".encode() + b"\xff")
    row = readers.scan_pages_gz(spark, folder).first()
    assert row.key == "77" and row.html.startswith("<p>xin chào\nline</p>")
    posts = str(tmp_path / "posts")
    os.makedirs(posts)
    with gzip.open(os.path.join(posts, "p1.json.gz"), "wt") as f:
        f.write(json.dumps({"id": "", "text": "t"}, indent=1))
    assert readers.scan_posts_json_gz(spark, posts).first().key == "p1"
    put(str(tmp_path / "l"), "x.json", {"data": [{"jobId": 5, "alias": "a"}], "meta": {"nbPages": 3}})
    r = readers.scan_listing_json(spark, str(tmp_path / "l")).first()
    assert (r.job_id, r.alias, r.nb_pages) == ("5", "a", 3)
    tax = {
        "data": [{"id": 1, "attributes": {"nameEn": "G"}, "relationships": {"jobFunction": {"data": [{"type": "jobFunction", "id": 9}]}}}],
        "included": [{"id": 9, "type": "jobFunction", "attributes": {"nameEn": "F"}}],
    }
    put(str(tmp_path / "t"), "t.json", tax)
    assert tuple(readers.scan_function_taxonomy(spark, str(tmp_path / "t")).select("group_name", "function_name").first()) == ("G", "F")


def test_parse_since():
    utc = dt.timezone.utc
    assert parse_since(None) is None
    assert parse_since("2024-01-02") == dt.datetime(2024, 1, 2, tzinfo=utc)
    assert parse_since("2024-01-02T03:00:00Z") == dt.datetime(2024, 1, 2, 3, tzinfo=utc)
    with pytest.raises(ValueError):
        parse_since("soon")


def test_snapshot_keeps_vanished_rows(spark, tmp_path):
    path, keys = str(tmp_path / "fact"), ["id", "day"]
    def day(d, *rows):
        return spark.createDataFrame([(i, dt.date.fromisoformat(d), v) for i, v in rows], "id int, day date, v string")
    for part in (day("2024-01-01", (1, "a")), day("2024-01-02", (1, "b"), (2, "b")), day("2024-01-02", (1, "c"))):
        merge.merge_snapshot_into(spark, path, part, keys, "day")
    got = sorted((r.id, str(r.day), r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "2024-01-01", "a"), (1, "2024-01-02", "c"), (2, "2024-01-02", "b")]


def test_archived_records_keep_their_board(spark, tmp_path):
    records = spark.createDataFrame([("itviec", "1", "A"), ("topcv", "2", "B")], "source string, source_job_id string, title string")
    writers.sink_parsed_json(records, str(tmp_path / "parsed"))
    rows = readers.scan_parsed_json(spark, str(tmp_path / "parsed"), one_per_object=False).collect()
    assert sorted((r.source, r.source_job_id, r._corrupt) for r in rows) == [("itviec", "1", None), ("topcv", "2", None)]


def test_outcomes_of_one_key_apply_in_order(spark, as_of):
    board = spark.createDataFrame(
        [("a", str(i), "in_progress", 0, None, None, None, None) for i in range(50)],
        "source string, job_id string, status string, http_status int, error_message string, raw_object_key string, crawl_run_id string, crawled_at timestamp",
    )
    said = spark.createDataFrame(
        [("a", "1", "success", 200, None, "obj", "run", 1), ("a", "1", "failed", 500, "boom", None, None, 2), ("a", "2", "failed", 500, "boom", None, None, 1),
         ("a", "2", "success", 200, None, "o2", "r2", 2), ("a", "3", "expired", None, None, None, None, 1)],
        "source string, job_id string, outcome string, http_status int, error string, raw_object_key string, run_id string, n int",
    )
    got = frontier.apply_outcomes(board, said, as_of(), "n")
    assert got.count() == 50
    rows = {r.job_id: r for r in got.collect()}
    assert (rows["1"].status, rows["1"].http_status, rows["1"].error_message, rows["1"].raw_object_key) == ("failed", 500, "boom", "obj")
    assert (rows["2"].status, rows["2"].http_status, rows["2"].error_message, rows["2"].raw_object_key) == ("success", 200, None, "o2")
    assert (rows["3"].status, rows["3"].http_status) == ("expired", 404) and rows["3"].crawled_at and rows["4"].status == "in_progress"


def test_first_n_for_a_hot_key(spark):
    df = spark.range(3000).selectExpr("case when id < 2900 then 'hot' else 'b' end as k", "id")
    got = merge.first_n_per_key(df, ["k"], ["id"], 1500)
    assert got.filter("k = 'hot'").agg(F.count("*"), F.max("id")).first() == (1500, 1499)
    assert got.filter("k = 'b'").count() == 100


def test_publish_keeps_old_copy_and_rebuilds(spark, tmp_path):
    target = str(tmp_path)
    writers.publish_swap(spark, {"m": spark.range(3)}, target)
    r = writers.publish_swap(spark, {"m": None}, target).first()
    assert r.missing and spark.read.parquet(f"{target}/m").count() == 3
    r = writers.publish_swap(spark, {"m": spark.range(2).withColumn("x", F.lit(1))}, target).first()
    assert r.rebuilt and r.rows == 2 and sorted(os.listdir(target)) == ["m"]


def test_archive_turns_nested_to_json(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"])], "id int, tags array<string>")
    assert writers.archive_parquet_zstd({"t": df}, str(tmp_path)).first().n_rows == 1
    assert spark.read.parquet(str(tmp_path / "t")).first().tags == '["a"]'


@pytest.mark.parametrize("day,kept", [
    ("2026-07-12", "daily"), ("2026-06-29", "daily"), ("2026-06-21", "weekly"), ("2026-06-24", None), ("2026-02-01", "monthly"), ("2024-01-01", None),
])
def test_retention(spark, day, kept):
    keys = spark.createDataFrame([(f"db/{day}/w.dump",), ("db/misc/x",)], "key string")
    got = {r.key: r.kept_as for r in writers.gfs_retention(keys, F.lit("2026-07-12").cast("date")).collect()}
    assert got[f"db/{day}/w.dump"] == kept and got["db/misc/x"] == "undated"


def test_retention_floor(spark):
    keys = spark.createDataFrame([(f"db/2020-01-0{i}/w",) for i in range(2, 7)], "key string")
    got = writers.gfs_retention(keys, F.lit("2026-07-12").cast("date"), min_keep=2)
    assert sorted(r.key for r in got.filter("kept_as = 'floor'").collect()) == ["db/2020-01-05/w", "db/2020-01-06/w"]


def test_percentiles_brute_force(spark):
    import numpy as np

    rng = random.Random(3)
    # One group holds most rows and repeats few values; one has a single row; one key is NULL.
    rows = [("hot", float(rng.choice([1, 2, 3, 900]))) for _ in range(4000)] + [("b", float(rng.randint(0, 10**6))) for _ in range(501)]
    rows += [("one", 7.0), (None, 5.0), (None, 8.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p25": 0.25, "p50": 0.5, "p9": 0.9}
    got = {r.k: r for r in exact_percentiles(df.withColumn("w", F.col("v")), ["k"], "v", probs, 100.0, ["w"]).collect()}
    for k in ("hot", "b", "one", None):
        vals = [v for key, v in rows if key == k and v is not None]
        assert got[k].n == len(vals) and got[k].w == min(vals)
        for name, p in (("p25", 25), ("p50", 50), ("p9", 90)):
            assert got[k][name] == pytest.approx(np.percentile(vals, p), abs=1e-6)


def test_cap_exact_for_a_hot_chat(spark):
    rows = [(i % 50, 1, "s", str(i)) for i in range(2000)] + [(1, 2, "s", "x")]
    df = spark.createDataFrame(rows, "subscription_id int, chat_id int, source string, source_job_id string")
    got = alerts.alert_cap(df, 7, salt=4)
    sent = sorted((r.subscription_id, r.source, r.source_job_id) for r in got.filter("status = 'sent' and chat_id = 1").collect())
    assert sent == sorted((r[0], r[2], r[3]) for r in rows if r[1] == 1)[:7]
    assert got.filter("status = 'skipped_rate_limit'").count() == 1993


def test_match_brute_force(spark, as_of):
    rng = random.Random(5)
    cities, levels, tags = ["A", "B", None], ["Senior", "Mid-level"], ["python", "sql", "go"]
    jobs_ = [("s", str(i), rng.choice(["c1", "c2"]), rng.choice(cities), rng.choice(levels), rng.choice([None, 1e6, 5e6, 2e7])) for i in range(60)]
    skill = [(s, j, t) for s, j, *_ in jobs_ for t in tags if rng.random() < 0.5]
    def maybe(pool):
        return rng.choice([None, [rng.choice(pool)], pool])
    subs = [(i, i % 4, maybe(["Python", "go"]), maybe(["c1"]), maybe(["A", "B"]), maybe(levels), rng.choice([None, 1_000_000, 4_999_999, 6_000_000]), None) for i in range(40)]
    subs.append((99, 1, None, None, None, None, None, dt.datetime(2030, 1, 1)))
    log = [(0, "1"), (1, "2")]
    tagged = [(*j, [t for s, i, t in skill if (s, i) == j[:2]] or None) for j in jobs_]
    job_df = spark.createDataFrame(tagged, "source string, source_job_id string, company_name string, city_canonical string, job_level string, salary_vnd_monthly_avg double, tags array<string>")
    subs_df = spark.createDataFrame(subs, "subscription_id int, chat_id int, skills array<string>, companies array<string>, cities array<string>, job_levels array<string>, min_salary_vnd bigint, paused_until timestamp")
    log_df = spark.createDataFrame(log, "subscription_id int, source_job_id string")
    found = [alerts.alert_match(subs_df, job_df, log_df, as_of(), n) for n in (alerts.PAIRS, 20)]
    want = {
        (u[0], j[1]) for u in subs for j in jobs_
        if u[7] is None and (u[0], j[1]) not in log
        and (u[2] is None or any((j[0], j[1], t.lower()) in skill for t in u[2])) and (u[3] is None or j[2] in u[3])
        and (u[4] is None or j[3] in u[4]) and (u[5] is None or j[4] in u[5]) and (u[6] is None or (j[5] is not None and j[5] >= u[6]))
    }
    for got in found:
        rows = [(r.subscription_id, r.source_job_id) for r in got.collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_taxonomy_terms_with_symbols(spark):
    docs = spark.createDataFrame([(1, "We use C++, Node.js. Power BI and SQL; not powerbi"), (2, "sqlite only"), (3, None)], "id int, t string")
    tax = spark.createDataFrame([("c++", "lang"), ("node.js", "web"), ("power bi", "bi"), ("sql", "db")], "skill string, category string")
    got = sorted((r.id, r.skill) for r in skills.extract_by_taxonomy(docs, ["id"], "t", tax).collect())
    assert got == [(1, "c++"), (1, "node.js"), (1, "power bi"), (1, "sql")]
