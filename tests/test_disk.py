"""What the large jobs leave on disk: compressed archives, merges in rounds, stages that are removed."""

import gzip
import json
import os
import time

from pyspark.sql import functions as F

from vacancia.operators import merge, validate
from vacancia.schemas import JOB_TABLE
from vacancia.session import shuffles_dropped
from vacancia.sources import readers, writers
from vacancia.streaming.ingest import stream_ingest


def size(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if not f.startswith("."))


def staged_in(monkeypatch, module, folder):
    """The folders that a module asks for from now on."""
    asked = []

    def work_dir(spark, name):
        asked.append(str(folder / f"{name}-{len(asked)}"))
        return asked[-1]

    monkeypatch.setattr(f"{module}.work_dir", work_dir)
    return asked


def test_archive_is_compressed(spark, tmp_path):
    """F10."""
    rows = spark.range(2000).selectExpr("'itviec' as source", "cast(id as string) as source_job_id", "repeat('Data Engineer ', 40) as title", "cast(null as string) as alias")
    writers.sink_parsed_json(rows, str(tmp_path / "parsed"))
    plain = sum(len(json.dumps(r.asDict())) for r in rows.collect())
    assert size(tmp_path / "parsed") < plain / 8
    assert spark.read.json(str(tmp_path / "parsed")).count() == 2000


def test_scan_reads_plain_and_gzipped(spark, tmp_path):
    """F11."""
    record = {"source": "itviec", "source_job_id": "1", "title": "Kế toán"}
    (tmp_path / "a.json").write_text(json.dumps(record), encoding="utf-8")
    with gzip.open(tmp_path / "b.json.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(record | {"source_job_id": "2"}, ensure_ascii=False))
    (tmp_path / "c.txt").write_text("{}")
    for one in (True, False):
        rows = readers.scan_parsed_json(spark, str(tmp_path), one_per_object=one).collect()
        assert sorted((r.source_job_id, r.title, r._corrupt) for r in rows) == [("1", "Kế toán", None), ("2", "Kế toán", None)]


def test_merge_in_rounds(spark, as_of, tmp_path, monkeypatch):
    """many rounds give the table of one, and nothing staged stays."""
    def batch(n, title):
        rows = spark.range(n).selectExpr("array('itviec', 'topcv')[id % 2] as source", "cast(id as string) as source_job_id", f"'{title}' as title", "'C' as company_name",
                                         "'2024-01-01T00:00:00Z' as parsed_at", "cast(id as string) as object_key")
        return validate.coerce_record(rows, keep=["object_key"])

    stages = staged_in(monkeypatch, "vacancia.operators.merge", tmp_path)
    tables = {}
    for name, most in (("one", 1 << 40), ("many", 1)):
        for n, title in ((40, "old"), (20, "new")):
            merge.merge_in_rounds(
                spark, str(tmp_path / name), batch(n, title), "source_job_id", "source", JOB_TABLE,
                lambda t, b: merge.upsert_last_wins(t, b, ["source", "source_job_id"], ["object_key"], as_of()), 4, round_bytes=most)
        tables[name] = sorted(tuple(r) for r in spark.read.schema(JOB_TABLE).parquet(str(tmp_path / name)).select("source", "source_job_id", "title", "loaded_at").collect())
    assert tables["one"] == tables["many"] and len(tables["one"]) == 40
    assert {t for _, i, t, _ in tables["many"] if int(i) < 20} == {"new"} and {t for _, i, t, _ in tables["many"] if int(i) >= 20} == {"old"}
    assert stages and not any(os.path.exists(f) for f in stages)


def test_shuffles_go_with_their_query(spark, tmp_path):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return set(local.getAllFiles().mkString("|").split("|"))

    before = files()
    with shuffles_dropped(spark):
        spark.range(5000).repartition(7, F.col("id")).write.parquet(str(tmp_path / "rows"))
    for _ in range(50):
        if not (left := [f for f in files() - before if "shuffle" in f]):
            break
        time.sleep(0.1)
    assert left == [] and spark.read.parquet(str(tmp_path / "rows")).count() == 5000


def test_stream_reads_gzipped_and_leaves_no_stage(spark, as_of, tmp_path, monkeypatch):
    """F8."""
    src, target, rejects, ck = (str(tmp_path / n) for n in ("in", "jobs", "rejects", "ck"))
    os.makedirs(src)
    good = {"source": "itviec", "source_job_id": "1", "parser_version": "v", "parsed_at": "2024-01-01T00:00:00Z", "title": "T", "company_name": "C"}
    with gzip.open(os.path.join(src, "a.json.gz"), "wt") as f:
        f.write(json.dumps(good) + "\n" + json.dumps(good | {"source_job_id": "2", "title": ""}))
    stages = staged_in(monkeypatch, "vacancia.streaming.ingest", tmp_path)
    stream_ingest(spark, src, target, rejects, ck, as_of(), buckets=2, one_per_object=False).awaitTermination()
    assert stages and not any(os.path.exists(f) for f in stages)
    assert [r.source_job_id for r in spark.read.schema(JOB_TABLE).parquet(target).collect()] == ["1"]
    assert [r.source_job_id for r in spark.read.parquet(rejects).collect()] == ["2"]
