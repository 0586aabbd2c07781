"""Stored runs, frontier, replays and models: repeated and broken-off steps, and what is left on storage."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from vacancia.operators import frontier as fr
from vacancia.operators.frontier_store import FrontierStore
from vacancia.operators.rules import TitleRule
from vacancia.operators.runs import RunStore
from vacancia.plans import graph, loader
from vacancia.schemas import FRONTIER, JOB_TABLE
from vacancia.sources.manifest import Manifest
from vacancia.sources.writers import reject_rows

DAY = [dt.datetime(2024, 1, i + 1) for i in range(9)]
RULES = [TitleRule("engineer", "Data Engineer", 10), TitleRule("c++", "Embedded", 5)]


def folders(root):
    return sorted(os.listdir(f"{root}/data"))


@pytest.fixture
def jobs(spark):
    rows = [("itviec", str(i), t, None, DAY[0]) for i, t in enumerate(["Engineer", "Cook", "Cook", None, "Baker"])] + [("topcv", "9", "Cook", None, DAY[5])]
    return spark.createDataFrame(rows, "source string, source_job_id string, title string, job_function string, loaded_at timestamp")


def test_runs_are_published_at_once_and_replace_themselves(spark, jobs, tmp_path):
    store = RunStore(spark, str(tmp_path))
    assert store.generations().count() == 0 and store.drift().count() == 0
    assert store.normalize(jobs, RULES, "a", DAY[0]) == {"normalized": 6, "drift": 5, "pruned": 0}
    first = {(r.raw_value, r.source): (r.frequency, r.status, r.run_id) for r in store.drift().collect()}
    assert first == {("Cook", "itviec"): (1, "new", "a"), ("", "itviec"): (1, "new", "a"), ("Baker", "itviec"): (1, "new", "a"), ("Cook", "topcv"): (1, "new", "a")}
    store.normalize(jobs, RULES, "b", DAY[1])
    twice = sorted(map(str, store.drift().collect())), sorted(map(str, store.generations().collect()))
    assert {r.frequency for r in store.drift().collect()} == {2}
    store.normalize(jobs, RULES, "b", DAY[1])  # the last run again
    assert (sorted(map(str, store.drift().collect())), sorted(map(str, store.generations().collect()))) == twice
    store.normalize(jobs, [*RULES, TitleRule("cook", "Kitchen", 1)], "a", DAY[0])  # an older run again: results change, the log has counted it
    assert sorted(map(str, store.drift().collect())) == twice[0]
    assert {r.job_category for r in store.generations().filter("run_id = 'a'").collect()} == {"Data Engineer", "Kitchen", "Other"}
    assert store.normalize(jobs, RULES, "c", DAY[2], keep=2)["pruned"] == 6
    assert [r["run_id"] for r in store.runs()] == ["b", "c"]
    assert {r.run_id for r in store.generations().select("run_id").distinct().collect()} == {"b", "c"}
    named = {r["folder"] for r in store.runs()}
    assert {f"data/{f}" for f in folders(tmp_path) if f.startswith("generation")} == named
    assert store.normalize(jobs, RULES, "d", DAY[3], since=F.lit(DAY[8]))["normalized"] == 0 and len(store.runs()) == 2
    assert store.normalize(jobs, RULES, "e", DAY[4], since=F.lit(DAY[4]))["normalized"] == 1


def test_broken_off_write_changes_nothing(spark, jobs, tmp_path):
    store = RunStore(spark, str(tmp_path))
    store.normalize(jobs, RULES, "a", DAY[0])
    before = sorted(map(str, store.generations().collect()))
    m = Manifest(spark, str(tmp_path))
    m.stage(store.generations(), "generation")  # written, never committed
    assert sorted(map(str, store.generations().collect())) == before and len(folders(tmp_path)) == 3
    store.prune(5)
    store.append(store.generations().limit(2), "z", DAY[7])
    assert len(folders(tmp_path)) == 3  # two runs and the log; the loose folder went
    with pytest.raises(RuntimeError):
        m.commit({})  # it started from an older version


def test_oldest_pending_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        at = rng.choice([None, dt.datetime(2024, 1, 1, rng.randrange(3), rng.randrange(2), 0), DAY[2]])
        rows.append((str(i), rng.choice(["a", "a", "a", "b"]), rng.choice(["pending", "pending", "success"]), at))
    rows += [(f"x{i}", "hot", "pending", DAY[1]) for i in range(900)]
    board = spark.createDataFrame(rows, "job_id string, source string, status string, first_seen_at timestamp")
    for n in (1, 7, 60, 500):
        want = set()
        for s in ("a", "b", "hot"):
            own = sorted((r for r in rows if r[1] == s and r[2] == "pending"), key=lambda r: (r[3] is None, r[3] or DAY[0], r[0]))
            want |= {(s, r[0]) for r in own[:n]}
        assert {tuple(r) for r in fr.oldest_pending(board, n).collect()} == want
    assert fr.oldest_pending(board, 5, "b").count() == 5


def test_claims_after_a_crash(spark, as_of, tmp_path):
    store = FrontierStore(spark, str(tmp_path), 2)
    assert store.rows().count() == 0 and store.claim(3, as_of(), "none").count() == 0
    items = spark.createDataFrame([("s", f"{i:02}", f"u{i}", i) for i in range(20)] + [("s", "00", "last", 99)], "source string, job_id string, url string, ordinal int")
    store.enqueue(items, as_of("2024-01-01 00:00:00"))
    assert store.rows().count() == 20 and store.rows().filter("job_id = '00'").first().url == "last"
    # A run that wrote its claim down and died before any row changed; another claim came in between.
    fr.oldest_pending(store.rows(), 4).write.parquet(f"{tmp_path}/claims/t1")
    other = {r.job_id for r in store.claim(2, as_of(), "t2").collect()}
    again = {r.job_id for r in store.claim(4, as_of(), "t1").collect()}
    assert other == {"00", "01"} and again == {"02", "03"}
    before = sorted(map(str, store.rows().collect()))
    assert {r.job_id for r in store.claim(4, as_of("2030-01-01 00:00:00"), "t1").collect()} == again
    assert sorted(map(str, store.rows().collect())) == before
    done = spark.createDataFrame([("s", "02", "success", 200, None, "obj", "r"), ("s", "77", "success", 200, None, "obj", "r")],
                                 "source string, job_id string, outcome string, http_status int, error string, raw_object_key string, run_id string")
    for _ in range(2):
        store.finish(done, as_of())
    assert {r.job_id for r in store.claim(4, as_of(), "t1").collect()} == {"03"} and store.rows().count() == 20
    store.enqueue(items, as_of())
    states = {r.job_id: r.status for r in store.rows().collect()}
    assert states["02"] == "success" and states["03"] == "in_progress" and states["10"] == "pending"
    assert set(store.rows().columns) == {*FRONTIER.names, "claim_token"}


def quarantine(spark, *rows):
    """Rejected records as the quarantine holds them: (job, title, parsed_at, rejected_at)."""
    out = None
    for job, title, parsed, at in rows:
        rec = spark.createDataFrame(
            [("itviec", job, "v", parsed, title, "C", "NO_RULE", "")],
            "source string, source_job_id string, parser_version string, parsed_at string, title string, company_name string, reject_reason string, reject_detail string",
        )
        row = reject_rows(rec, F.lit(at).cast("timestamp"))
        out = row if out is None else out.unionByName(row)
    return out


def test_promotion_happens_once(spark, as_of, tmp_path):
    rejects = quarantine(
        spark, ("1", "old", "2024-01-01T00:00:00Z", DAY[0]), ("1", "new", "2024-01-02T00:00:00Z", DAY[1]), ("2", "", "2024-01-01T00:00:00Z", DAY[1]),
        ("3", "stale", "2024-01-01T00:00:00Z", DAY[1]), ("1", "new", "2024-01-02T00:00:00Z", DAY[1]),
    ).cache()
    target, ledger = str(tmp_path / "jobs"), str(tmp_path / "ledger")
    clean = spark.createDataFrame([("itviec", "3", "v", "2024-05-01T00:00:00Z", "fresh", "C")], "source string, source_job_id string, parser_version string, parsed_at string, title string, company_name string")
    loader.merge_jobs(spark, target, clean, ["parsed_at"], as_of(), 2)

    def titles():
        return {r.source_job_id: r.title for r in spark.read.schema(JOB_TABLE).parquet(target).collect()}

    said = loader.promote_rejects(spark, rejects, target, ledger, "r1", as_of(), buckets=2)
    assert said == {"examined": 3, "promoted": 2, "kept": 1, "superseded": 1} and titles() == {"1": "new", "3": "fresh"}
    assert {r.source_job_id for r in loader.open_rejects(spark, rejects, ledger).collect()} == {"2"}
    assert loader.promote_rejects(spark, rejects, target, ledger, "r2", as_of(), buckets=2)["promoted"] == 0
    # A replay that merged and died before it marked: the next one marks, the table stays.
    other = str(tmp_path / "lost-ledger")
    assert loader.promote_rejects(spark, rejects, target, other, "r3", as_of(), buckets=2)["promoted"] == 2 and titles() == {"1": "new", "3": "fresh"}


def test_versions_that_arrive_together(spark, as_of, tmp_path):
    rows = [("itviec", "1", "v", "2024-01-01T00:00:00Z", t, "C", "file") for t in ("b", "a", "c")]
    ddl = "source string, source_job_id string, parser_version string, parsed_at string, title string, company_name string, object_key string"
    found = set()
    for k, order in enumerate((rows, rows[::-1], rows[1:] + rows[:1])):
        target = str(tmp_path / str(k))
        loader.merge_jobs(spark, target, spark.createDataFrame(order, ddl), ["object_key"], as_of(), 2)
        found.add(spark.read.schema(JOB_TABLE).parquet(target).first().title)
    assert len(found) == 1


def test_graph_builds_what_changed(spark, tmp_path):
    made = []

    def step(name, needs, build, **more):
        def run(i, p):
            made.append(name)
            return build(i, p)
        return graph.Model(name, tuple(needs.split()), run, **more)

    def models(version=1):
        return [
            step("total", "daily", lambda i, p: i["daily"].groupBy("day").agg(F.sum("v").alias("s"))),
            step("daily", "clean", lambda i, p: i["clean"].select("id", "v", p["day"].alias("day")), kind="incremental", part="day", by="day", keys=("id", "day"), params=("day",)),
            step("clean", "seen", lambda i, p: i["seen"].filter("v > 0"), version=version),
            step("seen", "raw", lambda i, p: i["raw"], kind="view"),
        ]

    raw = spark.createDataFrame([(1, 5), (2, 0), (3, 7)], "id int, v int")
    def run(rows, mark, day, version=1):
        made.clear()
        g = graph.Graph(spark, str(tmp_path), models(version))
        report = g.run({"raw": graph.Source(rows, mark)}, {"day": f"date '2024-01-0{day}'"})
        assert [n for n, _ in report] == ["seen", "clean", "daily", "total"]
        return {n: a for n, a in report}, {str(r.day): r.s for r in g.frames["total"].collect()}

    assert run(raw, "m1", 1) == ({"seen": "view", "clean": "built", "daily": "built", "total": "built"}, {"2024-01-01": 12})
    assert run(raw, "m1", 1) == ({"seen": "view", "clean": "kept", "daily": "kept", "total": "kept"}, {"2024-01-01": 12}) and made == ["seen"]
    assert run(raw, "m1", 2) == ({"seen": "view", "clean": "kept", "daily": "built", "total": "built"}, {"2024-01-01": 12, "2024-01-02": 12})
    # A changed input on the second day: vanished ids keep their row of that day, the first day is not touched.
    less = spark.createDataFrame([(1, 50)], "id int, v int")
    assert run(less, "m2", 2)[1] == {"2024-01-01": 12, "2024-01-02": 57}
    assert run(less, "m2", 2, version=2)[0]["clean"] == "built"
    with pytest.raises(ValueError):
        graph.Graph(spark, str(tmp_path), models()).order(["other"])
    assert len(os.listdir(f"{tmp_path}/data")) == 4


def test_stored_marts_do_not_read_the_sources(spark, tmp_path):
    from suite import testbed as tb

    d = "/root/testdata/sf0.001"
    sources = {n: graph.Source(f(spark, d), "same") for n, f in (("jobs", tb.jobs), ("generations", tb.generations), ("skill_log", tb.skill_log))}
    g = graph.Graph(spark, str(tmp_path), graph.warehouse(tb.lookups(spark, d)))
    params = {"as_of": f"timestamp '{tb.AS_OF}'", "day": f"date '{tb.AS_OF_DAY}'"}
    g.run(sources, params)
    by_name = {x.name: x for x in g.models}
    trend = by_name["mart_skill_trend"].build(g.frames, {})
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and "orders.parquet" not in plan and str(tmp_path) in plan
    assert sorted(map(str, trend.collect())) == sorted(map(str, g.frames["mart_skill_trend"].collect()))
    assert [a for _, a in g.run(sources, params)] == ["view" if x.kind == "view" else "kept" for x in g.order()]


def test_files_fingerprint(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    one = graph.files_fingerprint(spark, str(tmp_path / "t"))
    assert one == graph.files_fingerprint(spark, str(tmp_path / "t"))
    spark.range(3).write.mode("append").parquet(str(tmp_path / "t"))
    assert one != graph.files_fingerprint(spark, str(tmp_path / "t"))
