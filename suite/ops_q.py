"""Sources, sinks, merges, record checks, joins and aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from suite import testbed as tb
from suite.registry import register
from vacancia import seeds
from vacancia.functions import salary as sal
from vacancia.functions.jsontext import is_json_array, is_non_blank
from vacancia.functions.numeric import percent
from vacancia.operators import frontier as fr
from vacancia.operators import merge, normalize, quality, rules, skills, validate
from vacancia.operators.runs import RunStore
from vacancia.plans import loader, models, reports
from vacancia.schemas import JOB_TABLE, KEY
from vacancia.session import shuffles_dropped, work_dir
from vacancia.sources import readers, writers
from vacancia.streaming.ingest import stream_ingest

TS = f"timestamp '{tb.AS_OF}'"
RAW = ["source", "source_job_id", "title", "company_name", "salary_min", "salary_max", "is_salary_visible",
       "skills", "locations", "num_of_views"]
RAW_SQL = ", ".join(RAW)

# ------------------------------------------------------------------ sources and sinks

ISO = "date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
tb.cte("payload", ["postings"], "select * replace (" + ", ".join(
    f"strftime({c}, '%Y-%m-%dT%H:%M:%SZ') as {c}" for c in ("parsed_at", "posted_at", "expired_at", "last_updated_at", "online_on")
) + ") from postings")


def payload(s, d):
    """Postings as archived records: ISO text for times."""
    p = tb.postings(s, d).drop("loaded_at")
    return p.withColumns({
        c: F.expr(ISO.format(c=c)) for c in ("parsed_at", "posted_at", "expired_at", "last_updated_at", "online_on")
    })


register(
    "scan_parsed_json",
    lambda s, d: _scan_with_source(s, d),
    tb.sql(f"select {RAW_SQL}, parsed_at from payload", "payload"),
)


def _scan_with_source(s, d):
    path = work_dir(s, "parsed")
    writers.sink_parsed_json(payload(s, d).drop("ordinal"), path)
    rows = readers.scan_parsed_json(s, path, one_per_object=False).filter("_corrupt is null")
    return rows.select(*RAW, "parsed_at")


def _sink_parsed(s, d):
    path = work_dir(s, "parsed")
    writers.sink_parsed_json(payload(s, d).drop("ordinal"), path)
    return s.read.json(path).select(*RAW, "parsed_at", "posted_at", "job_function", "board")


register("sink_parsed_json", _sink_parsed, tb.sql(f"select {RAW_SQL}, parsed_at, posted_at, job_function, source board from payload", "payload"))

register(
    "skip_already_parsed",
    lambda s, d: readers.skip_already_parsed(
        tb.read(s, d, "pages").select(F.col("page_id").cast("string").alias("key"), "url"),
        tb.read(s, d, "pages").filter("page_id % 3 = 0").select(F.col("page_id").cast("string").alias("source_job_id")),
    ),
    "select cast(page_id as varchar) as key, url from pages where page_id % 3 <> 0",
)


def _scan_posts(s, d):
    path = work_dir(s, "posts")
    tb.read(s, d, "conversations").select(
        F.expr("cast(conv_id as string) || '-' || cast(turn as string)").alias("id"), "text",
        F.lit("TEXT").alias("media_type"), F.col("role").alias("username"),
    ).write.option("compression", "gzip").json(path)
    return readers.scan_posts_json_gz(s, path, one_per_object=False).select("id", "text", "media_type", "username")


register(
    "scan_posts_json_gz", _scan_posts,
    "select cast(conv_id as varchar) || '-' || cast(turn as varchar) as id, text, 'TEXT' as media_type, role as username from conversations",
)


def _scan_listing(s, d):
    path = work_dir(s, "listing")
    tb.read(s, d, "orders").select(
        F.expr("array(named_struct('jobId', cast(o_orderkey as string), 'alias', 'a' || o_custkey), "
               "named_struct('jobId', cast(o_orderkey + 1 as string), 'alias', o_orderpriority))").alias("data"),
        F.expr("named_struct('nbPages', cast(o_custkey % 9 as int))").alias("meta"),
    ).write.json(path)
    return readers.scan_listing_json(s, path, one_per_object=False).drop("object_key")


register(
    "scan_listing_json", _scan_listing,
    """select cast(o_custkey % 9 as int) nb_pages, 0 as position, cast(o_orderkey as varchar) job_id, 'a' || o_custkey as alias from orders
    union all select cast(o_custkey % 9 as int), 1, cast(o_orderkey + 1 as varchar), o_orderpriority from orders""",
)


def _scan_csv(s, d):
    path = work_dir(s, "seed")
    tb.city_map(s, d).write.option("header", True).csv(path)
    return seeds.read_seed_csv(s, "city_map", path)


register("scan_seed_csv", _scan_csv, tb.sql("select * from city_map", "city_map"))
register(
    "scan_warehouse_table",
    lambda s, d: readers.scan_warehouse_table(s, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"]),
    "select o_orderkey, o_custkey, o_totalprice from orders",
)


def _sink_rejects(s, d):
    path = work_dir(s, "rejects")
    split = validate.split_valid_rejected(payload(s, d).withColumn("object_key", F.concat(F.lit("k/"), F.col("ordinal"))))
    writers.sink_rejects(split.rejected.drop("ordinal"), path, tb.as_of())
    return s.read.parquet(path).select(
        "source", "source_job_id", "object_key", "parser_version", "reject_reason", "reject_detail", "rejected_at",
        F.get_json_object("payload", "$.salary_currency").alias("payload_currency"),
    )


VERDICT = """case when coalesce(title, '') = '' then 'MISSING_TITLE' when coalesce(company_name, '') = '' then 'MISSING_COMPANY'
  when is_salary_visible and salary_min > salary_max then 'BAD_SALARY_RANGE'
  when expired_at < posted_at then 'BAD_DATE_RANGE' end"""
DETAIL = """case when coalesce(title, '') = '' then '' when coalesce(company_name, '') = '' then ''
  when is_salary_visible and salary_min > salary_max then 'min=' || cast(cast(salary_min as bigint) as varchar) || '.0 > max=' || cast(cast(salary_max as bigint) as varchar) || '.0'
  when expired_at < posted_at then 'expired_at=' || expired_at || ' < posted_at=' || posted_at end"""
tb.cte("checked", ["payload"], f"select *, {VERDICT} as reject_reason, {DETAIL} as reject_detail from payload")
tb.cte("rejects", ["checked"], f"""select source, source_job_id, title, parser_version, reject_reason, reject_detail,
  cast(parsed_at as timestamp) as rejected_at, posted_at, expired_at, salary_min, salary_max from checked where reject_reason is not null""")

register(
    "sink_rejects", _sink_rejects,
    tb.sql(f"""select source, source_job_id, 'k/' || ordinal as object_key, parser_version, reject_reason, reject_detail,
      {TS} as rejected_at, salary_currency as payload_currency from checked where reject_reason is not null""", "checked"),
)


def _archive(s, d):
    """What the archive holds, row by row, beside the counts it reported."""
    path = work_dir(s, "archive")
    counts = writers.archive_parquet_zstd({
        "orders": tb.read(s, d, "orders"), "embeddings": tb.read(s, d, "embeddings"),
        "postings": tb.postings(s, d).select(*RAW),
    }, path)
    rows = {
        "orders": ["cast(o_orderkey as string)", "concat_ws('|', o_custkey, o_orderstatus, o_orderpriority)"],
        "embeddings": ["cast(vec_id as string)", "concat_ws('|', label, json_array_length(embedding))"],
        "postings": ["concat(source, ' ', source_job_id)", "concat_ws('|', title, company_name, skills, locations)"],
    }
    out = None
    for name, (key, content) in rows.items():
        part = s.read.parquet(f"{path}/{name}").selectExpr(f"'{name}' as table_name", f"{key} as key", f"{content} as content")
        out = part if out is None else out.unionByName(part)
    return out.join(counts, "table_name")


register(
    "archive_parquet_zstd", _archive,
    tb.sql("""select 'orders' as table_name, cast(o_orderkey as varchar) as key, concat_ws('|', o_custkey, o_orderstatus, o_orderpriority) as content, (select count(*) from orders) n_rows from orders
    union all select 'embeddings', cast(vec_id as varchar), concat_ws('|', label, len(embedding)), (select count(*) from embeddings) from embeddings
    union all select 'postings', source || ' ' || source_job_id, concat_ws('|', title, company_name, skills, locations), (select count(*) from orders) from postings""", "postings"),
)


def _publish(s, d):
    target = work_dir(s, "web")
    silver = tb.silver(s, d)
    company = models.mart_company_hiring(silver, tb.day())
    writers.publish_swap(s, {"mart_company_hiring": company.limit(0), "job_features": None}, target)
    report = writers.publish_swap(
        s, {"mart_company_hiring": company, "silver_job_detail": silver.select(*KEY, "title"), "job_features": None}, target
    )
    return report.select("object", "rows", "missing", "rebuilt")


register(
    "publish_swap", _publish,
    tb.sql("""select 'mart_company_hiring' as object, count(distinct company_id) as rows, false as missing, false as rebuilt from silver
    union all select 'silver_job_detail', count(*), false, false from silver
    union all select 'job_features', 0, true, false""", "silver"),
)


def _incremental(s, d):
    """Two days stored in one partitioned table; the second run rewrites its own day only."""
    path = work_dir(s, "fact")
    keys = [*KEY, "snapshot_date"]
    silver = tb.silver(s, d)
    number = F.col("source_job_id").cast("bigint")
    day1 = F.lit(tb.PREV_DAY).cast("date")
    for rows, day in ((silver.filter(number % 7 != 0), day1), (silver.filter(number % 2 == 0), tb.day()), (silver.filter(number % 9 != 0), tb.day())):
        snap = models.fct_jobs_snapshot(rows, day).select(*keys, "job_category", "is_active")
        merge.merge_snapshot_into(s, path, snap, keys, "snapshot_date")
    return s.read.parquet(path).groupBy("snapshot_date", "job_category").agg(
        F.count("*").alias("n"), F.count_if("is_active").alias("active")
    )


register(
    "sink_incremental", _incremental,
    tb.sql(f"""select snapshot_date, job_category, count(*) n, count(*) filter (where is_active) active from (
      select *, date '{tb.PREV_DAY}' as snapshot_date from silver where cast(source_job_id as bigint) % 7 <> 0
      union all select *, date '{tb.AS_OF_DAY}' from silver where cast(source_job_id as bigint) % 9 <> 0 or cast(source_job_id as bigint) % 2 = 0)
    group by all""", "silver"),
)


def _load(s, d):
    """Archive records, load them, load a changed part again; returns the table that leaves."""
    root = work_dir(s, "load")
    writers.sink_parsed_json(payload(s, d).drop("ordinal"), f"{root}/parsed")
    rows = readers.scan_parsed_json(s, f"{root}/parsed", one_per_object=False)
    loader.merge_jobs(s, f"{root}/jobs", validate.split_valid_rejected(rows).valid, ["object_key"], tb.as_of(), 4)
    again = rows.filter("cast(source_job_id as bigint) % 4 = 0").withColumn("title", F.concat("title", F.lit(" v2")))
    loader.merge_jobs(s, f"{root}/jobs", validate.split_valid_rejected(again).valid, ["object_key"], tb.as_of(), 4)
    return s.read.schema(JOB_TABLE).parquet(f"{root}/jobs").select(
        "source", "source_job_id", "title", "parsed_at", "loaded_at", "salary_min", "locations"
    )


register(
    "load_job_detail", _load,
    tb.sql(f"""select source, source_job_id, case when cast(source_job_id as bigint) % 4 = 0 then title || ' v2' else title end title,
      cast(parsed_at as timestamp) parsed_at, {TS} loaded_at, salary_min, locations from checked where reject_reason is null""", "checked"),
)


def _stream(s, d):
    """Archive all postings as JSON lines and ingest them as a file stream."""
    root = work_dir(s, "stream")
    # The board stays inside the documents, as in the archive.
    with shuffles_dropped(s):
        payload(s, d).drop("ordinal").write.option("compression", "gzip").option("maxRecordsPerFile", writers.LINES_PER_FILE).json(f"{root}/parsed")
    stream_ingest(
        s, f"{root}/parsed", f"{root}/jobs", f"{root}/rejects", f"{root}/checkpoint", tb.as_of(), 4, one_per_object=False,
    ).awaitTermination()
    loaded = s.read.schema(JOB_TABLE).parquet(f"{root}/jobs").select(*KEY, F.lit("loaded").alias("state"), "title", "salary_min", "skills", "parsed_at")
    refused = s.read.parquet(f"{root}/rejects").select(
        *KEY, F.col("reject_reason").alias("state"), F.get_json_object("payload", "$.title").alias("title"),
        F.get_json_object("payload", "$.salary_min").cast("double").alias("salary_min"), F.get_json_object("payload", "$.skills").alias("skills"),
        F.get_json_object("payload", "$.parsed_at").cast("timestamp").alias("parsed_at"),
    )
    return loaded.unionByName(refused)


register(
    "stream_ingest", _stream,
    tb.sql("select source, source_job_id, coalesce(reject_reason, 'loaded') state, title, salary_min, skills, cast(parsed_at as timestamp) parsed_at from checked", "checked"),
)

# ------------------------------------------------------------------ merges

TARGET = "select source, source_job_id, title, parsed_at, loaded_at, salary_min from postings where ordinal % 3 <> 0"
BATCH = """select source, source_job_id, title || ' #' || c as title,
  case when ordinal % 2 = 0 then parsed_at + c * interval 1 day else parsed_at - c * interval 1 day end as parsed_at,
  salary_min + c as salary_min, c as arrival from (select *, unnest([1, 2]) as c from postings where ordinal % 4 <> 1)"""
tb.cte("target", ["postings"], TARGET)
tb.cte("batch", ["postings"], BATCH)


def _target(p):
    return p.filter("ordinal % 3 <> 0").select(*KEY, "title", "parsed_at", "loaded_at", "salary_min")


def _batch(p):
    return p.filter("ordinal % 4 <> 1").withColumn("c", F.explode(F.array(F.lit(1), F.lit(2)))).selectExpr(
        "source", "source_job_id", "title || ' #' || c as title",
        "case when ordinal % 2 = 0 then parsed_at + c * interval 1 day else parsed_at - c * interval 1 day end as parsed_at",
        "salary_min + c as salary_min", "c as arrival",
    )


def _both(s, d):
    p = tb.postings(s, d)
    return _target(p), _batch(p)


register(
    "upsert_last_wins",
    lambda s, d: merge.upsert_last_wins(*_both(s, d), KEY, ["arrival"], tb.as_of()),
    tb.sql(f"""select source, source_job_id, case when b.source is null then t.title else b.title end title,
      coalesce(b.parsed_at, t.parsed_at) parsed_at, coalesce(t.loaded_at, {TS}) loaded_at, coalesce(b.salary_min, t.salary_min) salary_min
    from target t full join (select * from batch where arrival = 2) b using (source, source_job_id)""", "target", "batch"),
)
register(
    "upsert_newest_wins",
    lambda s, d: merge.upsert_newest_wins(*_both(s, d), KEY, "parsed_at", ["arrival"], tb.as_of()),
    tb.sql(f"""select source, source_job_id, case when w then b.title else t.title end title,
      case when w then b.parsed_at else t.parsed_at end parsed_at, case when w then {TS} else t.loaded_at end loaded_at,
      case when w then b.salary_min else t.salary_min end salary_min
    from (select *, true as here from target) t full join (
      select * from batch qualify row_number() over (partition by source, source_job_id order by parsed_at desc, arrival desc) = 1) b
      using (source, source_job_id), lateral (select b.arrival is not null and (t.here is null or t.parsed_at <= b.parsed_at) as w)""", "target", "batch"),
)
register(
    "merge_delete_insert",
    lambda s, d: merge.merge_delete_insert(
        _target(p := tb.postings(s, d)),
        p.filter("ordinal % 4 = 0").select(*KEY, F.upper("title").alias("title"), "parsed_at", "loaded_at", "salary_min"), KEY,
    ),
    tb.sql("""select * from target t where not exists (select 1 from postings p where p.ordinal % 4 = 0 and p.source = t.source and p.source_job_id = t.source_job_id)
    union all select source, source_job_id, upper(title), parsed_at, loaded_at, salary_min from postings where ordinal % 4 = 0""", "target", "postings"),
)
register(
    "coerce_payload",
    lambda s, d: validate.coerce_record(
        payload(s, d).withColumn("parser_version", F.expr("case when ordinal % 5 = 2 then null else parser_version end")).drop("services")
    ).select(*KEY, "parser_version", "parsed_at", "expired_at", "services", "skills"),
    tb.sql("""select source, source_job_id, case when ordinal % 5 = 2 then 'unknown' else parser_version end parser_version,
      cast(parsed_at as timestamp) parsed_at, cast(expired_at as timestamp) expired_at, '[]' services, skills from payload""", "payload"),
)
RUN_DAYS = [dt.datetime(2001, 6, 20 + i) for i in range(1, 5)]


def _stored_generations(s, d):
    """Four runs, the second one stored twice."""
    store = RunStore(s, work_dir(s, "generations"))
    g = tb.generations(s, d)
    for i in (1, 2, 3, 4, 2):
        store.append(g.filter(F.col("run_id") == f"run{i}"), f"run{i}", RUN_DAYS[i - 1])
    return store


def _pruned(s, d):
    store = _stored_generations(s, d)
    gone = store.prune(3)
    return store.generations().withColumn("rows_gone", F.lit(gone).cast("bigint"))


register(
    "append_generation", lambda s, d: _stored_generations(s, d).generations(), tb.sql("select * from generations", "generations"),
)
register(
    "prune_keep_newest_runs", _pruned,
    tb.sql("""select *, (select count(*) from orders) rows_gone from generations
      where run_id in (select run_id from generations group by 1 order by max(run_at) desc limit 3)""", "generations"),
)

DRIFT_STATUS = "case o_orderkey % 3 when 0 then 'resolved' when 1 then 'new' else 'reviewed' end"


def _drift(s, d):
    """A log of a value for each order; the run finds each twice, under the doubled number."""
    orders = tb.read(s, d, "orders")
    tb.pin_utc(s)
    log = orders.selectExpr(
        "'run0' as run_id", "'category' as dimension", "'title ' || o_orderkey as raw_value", "'itviec' as source",
        "cast(o_orderkey % 5 + 1 as int) as frequency", "cast(o_orderdate as timestamp) as first_seen_at",
        "cast(o_orderdate as timestamp) as last_seen_at", f"{DRIFT_STATUS} as status",
    )
    entries = orders.selectExpr(
        "explode(array(1, 2)) as c", "'category' as dimension", "'title ' || o_orderkey * 2 as raw_value", "'itviec' as source"
    )
    return merge.drift_upsert(log, entries, "run1", tb.as_of())


register(
    "drift_upsert", _drift,
    f"""with l as (select 'run0' run_id, 'category' dimension, 'title ' || o_orderkey raw_value, 'itviec' source,
      cast(o_orderkey % 5 + 1 as int) frequency, o_orderdate first_seen_at, o_orderdate last_seen_at, {DRIFT_STATUS} status
      from orders),
    e as (select 'category' dimension, 'title ' || o_orderkey * 2 raw_value, 'itviec' source from orders)
    select dimension, raw_value, source, case when e.here is null then l.run_id else 'run1' end run_id,
      case when e.here is null then frequency when l.run_id is null then 1 else frequency + 1 end frequency,
      coalesce(first_seen_at, {TS}) first_seen_at, case when e.here is null then last_seen_at else {TS} end last_seen_at,
      case when l.run_id is null then 'new' when e.here and status = 'resolved' then 'regression' else status end status
    from l full join (select *, true here from e) e using (dimension, raw_value, source)""",
)

# ------------------------------------------------------------------ frontier

E_AS_OF = f"timestamp '{tb.AS_OF_EVENTS}'"
F_COLS = ["job_id", "source", "status", "url", "first_seen_at", "last_attempt_at", "crawled_at", "retry_count"]
F_SQL = ", ".join(F_COLS)


def e_as_of():
    return F.lit(tb.AS_OF_EVENTS).cast("timestamp")


def _items(s, d):
    rows = tb.read(s, d, "events").filter("event_id % 3 = 0").selectExpr("*", "explode(array(1, 2)) as c")
    board = tb.nth(tb.BOARDS, "cast(event_id * 2 as bigint) % 5")
    return rows.selectExpr(
        f"{board} as source", "cast(event_id * 2 as string) as job_id",
        "'https://new.example.com/' || event_id || '/' || c as url", "event_id * 10 + c as ordinal",
    )


tb.cte("items", [], f"""select {tb.nth(tb.BOARDS, 'cast(event_id * 2 as bigint) % 5')} as source, cast(event_id * 2 as varchar) as job_id,
  'https://new.example.com/' || event_id || '/' || c as url, event_id * 10 + c as ordinal
  from (select *, unnest([1, 2]) as c from events where event_id % 3 = 0)""")

register(
    "frontier_upsert",
    lambda s, d: fr.frontier_upsert(tb.frontier(s, d), _items(s, d), e_as_of()).select(*F_COLS),
    tb.sql(f"""select job_id, source, case when i.url is null then f.status when f.status in ('success', 'in_progress') then f.status else 'pending' end status,
      coalesce(i.url, f.url) url, case when f.status is null then {E_AS_OF} else f.first_seen_at end first_seen_at, last_attempt_at, crawled_at,
      case when f.status is null then 0 else retry_count end retry_count
    from frontier f full join (select source, job_id, arg_max(url, ordinal) url from items group by all) i using (source, job_id)""", "frontier", "items"),
)
register(
    "frontier_is_fresh",
    lambda s, d: fr.fresh_rows(tb.frontier(s, d), e_as_of(), 7).select("source", "job_id", "crawled_at"),
    tb.sql(f"select source, job_id, crawled_at from frontier where status = 'success' and crawled_at >= {E_AS_OF} - interval 7 day", "frontier"),
)
register(
    "frontier_enqueue_not_fresh",
    lambda s, d: fr.not_fresh(_items(s, d), tb.frontier(s, d), e_as_of(), 7),
    tb.sql(f"""select i.* from items i where not exists (select 1 from frontier f where f.source = i.source and f.job_id = i.job_id
      and status = 'success' and crawled_at >= {E_AS_OF} - interval 7 day)""", "frontier", "items"),
)
register(
    "frontier_claim",
    lambda s, d: fr.claim(tb.frontier(s, d), 60, e_as_of()).select(*F_COLS),
    tb.sql(f"""select job_id, source, case when k then 'in_progress' else status end status, url, first_seen_at,
      case when k then {E_AS_OF} else last_attempt_at end last_attempt_at, crawled_at, retry_count + case when k then 1 else 0 end retry_count
    from (select *, status = 'pending' and row_number() over (partition by source, status order by first_seen_at, job_id) <= 60 as k from frontier)""", "frontier"),
)


def _outcomes(s, d):
    return tb.frontier(s, d).filter("status = 'in_progress'").selectExpr(
        "source", "job_id",
        "case cast(job_id as bigint) % 3 when 0 then 'success' when 1 then 'failed' else 'expired' end as outcome",
        "cast(200 + cast(job_id as bigint) % 3 * 203 as int) as http_status", "repeat('timeout ', 200) || job_id as error",
        "'raw/' || job_id as raw_object_key", "'run9' as run_id",
    )


register(
    "frontier_apply_outcomes",
    lambda s, d: fr.apply_outcomes(tb.frontier(s, d), _outcomes(s, d), e_as_of()),
    tb.sql(f"""select * exclude (o) replace (
      case when o is null then status when o = 0 then 'success' when o = 1 then 'failed' else 'expired' end as status,
      cast(case when o is null then http_status when o = 2 then 404 else 200 + o * 203 end as int) as http_status,
      case when o = 0 then null when o = 1 then left(repeat('timeout ', 200) || job_id, 1000) else error_message end as error_message,
      case when o = 0 then 'raw/' || job_id else raw_object_key end as raw_object_key,
      case when o = 0 then 'run9' else crawl_run_id end as crawl_run_id,
      case when o in (0, 2) then {E_AS_OF} else crawled_at end as crawled_at)
    from (select *, case when status = 'in_progress' then cast(job_id as bigint) % 3 end as o from frontier)""", "frontier"),
)
register(
    "frontier_requeue_stale",
    lambda s, d: fr.requeue_stale(tb.frontier(s, d), e_as_of(), 120).select(*F_COLS),
    tb.sql(f"""select job_id, source, case when status = 'in_progress' and last_attempt_at < {E_AS_OF} - interval 120 minute then 'pending' else status end status,
      url, first_seen_at, last_attempt_at, crawled_at, retry_count from frontier""", "frontier"),
)
register(
    "frontier_stats",
    lambda s, d: fr.stats(tb.frontier(s, d), "linkedin"),
    tb.sql("select status, count(*) n from frontier where source = 'linkedin' group by 1", "frontier"),
)

# ------------------------------------------------------------------ rule seeding

register(
    "seed_category_rules",
    lambda s, d: normalize.category_rules(s, tb.title_map(s)),
    tb.sql("""with x as (select keyword pattern, job_category, priority, 0 part from title_map where keyword not in ('html', 'css', 'figma', 'sap', 'php', 'golang', 'ruby', 'flutter', 'epicor', 'kafka')
      union all select *, 1 from (""" + tb.values([(a, b, int(c)) for a, b, c in seeds.lines(seeds.EXTRA_CATEGORY_RULES)], "pattern, job_category, priority") + """))
    select pattern, job_category, priority, 'word_boundary' match_mode, true is_active from x
    qualify row_number() over (partition by pattern, job_category order by part, priority) = 1""", "title_map"),
)
register(
    "seed_level_rules",
    lambda s, d: normalize.level_rules(s, seeds.seed(s, "job_level_map")),
    tb.sql("select 'title_keyword' signal_type, keyword pattern, job_level, priority, 0.8::double confidence from level_map union all select 'raw_field_value', a, b, 5, c from ("
           + tb.values([(a, b, float(c)) for a, b, c in seeds.lines(seeds.RAW_LEVEL_RULES)], "a, b, c")
           + ") union all select 'experience_range', a, b, 50, c from ("
           + tb.values([(a, b, float(c)) for a, b, c in seeds.lines(seeds.EXPERIENCE_LEVEL_RULES)], "a, b, c") + ")", "level_map"),
)
register(
    "seed_city_aliases",
    lambda s, d: normalize.city_aliases(s, tb.city_map(s, d)),
    tb.sql("select city_canonical, region, city_raw_en alias, null::varchar source from city_map union all select a, b, c, nullif(e, '') from ("
           + tb.values(seeds.lines(seeds.EXTRA_CITY_ALIASES), "a, b, c, e") + ")", "city_map"),
)
# ------------------------------------------------------------------ projections and checks

register(
    "expiry_flags",
    lambda s, d: models.stg_job_detail(tb.postings(s, d), tb.as_of(), 30).groupBy("source", "is_expired_calc", "is_active_calc").agg(F.count("*").alias("n")),
    tb.sql(f"""select source, e as is_expired_calc, not e as is_active_calc, count(*) n from (select source,
      case when expired_at is not null then expired_at < {TS} when posted_at is not null then posted_at < {TS} - interval 30 day else false end e from postings)
    group by all""", "postings"),
)


def _with_dims(s, d):
    return models.join_dimensions(tb.jobs(s, d), tb.lookups(s, d))


register(
    "join_dimensions",
    lambda s, d: _with_dims(s, d).select(*KEY, "vnd_rate", "period_label", "months_multiplier", "degree_label", "size_label", "size_bucket"),
    tb.sql("""select source, source_job_id, vnd_rate, period_label, cast(months as double) months_multiplier, degree_label, size_label, size_bucket from silver_in""", "silver_in"),
)
register(
    "salary_multiplier",
    lambda s, d: _with_dims(s, d).select(
        *KEY, sal.salary_multiplier(F.col("salary_period_id"), F.col("salary_min"), F.col("vnd_rate"), F.col("months_multiplier")).alias("factor")
    ),
    tb.sql("select source, source_job_id, factor from silver_in", "silver_in"),
)
SALARY = [f"salary_vnd_monthly_{x}" for x in ("min", "max", "avg")]
register(
    "salary_to_vnd_monthly", lambda s, d: tb.silver(s, d).select(*KEY, *SALARY),
    tb.sql(f"select source, source_job_id, {', '.join(SALARY)} from silver", "silver"),
)
register(
    "salary_period_fix",
    lambda s, d: tb.silver(s, d).groupBy("salary_period_id", "salary_period_label").agg(F.count("*").alias("n")),
    tb.sql("select salary_period_id, salary_period_label, count(*) n from silver group by all", "silver"),
)
register(
    "level_resolve",
    lambda s, d: models.level_resolve(tb.jobs(s, d), tb.lookups(s, d)).select(*KEY, "job_level", "job_level_raw"),
    tb.sql("select source, source_job_id, job_level, job_level_raw from silver", "silver"),
)
register(
    "category_resolve",
    lambda s, d: models.category_resolve(tb.jobs(s, d).withColumn("norm_job_category", F.lit(None).cast("string")), tb.lookups(s, d)).select(*KEY, "job_category"),
    tb.sql("select source, source_job_id, coalesce(case when cast(beats_title as boolean) then fn_category end, "
           + tb._first.format(out="job_category", table="title_map", text="i.title") + ", fn_category, 'Other') job_category from silver_in i", "silver_in", "title_map"),
)
register(
    "vnw_function_join",
    lambda s, d: models.function_category(tb.jobs(s, d), tb.function_map(s)).filter("fn_category is not null").select(*KEY, "fn_category", "fn_beats_title"),
    tb.sql("select source, source_job_id, fn_category, cast(beats_title as boolean) fn_beats_title from silver_in where fn_category is not null", "silver_in"),
)
register(
    "city_exact_then_fuzzy",
    lambda s, d: models.city_exact_then_fuzzy(
        tb.postings(s, d).select(*KEY, F.expr("nullif(get_json_object(locations, '$[0].city'), '')").alias("city_raw_en")), tb.city_map(s, d)
    ),
    tb.sql("select source, source_job_id, city_raw_en, coalesce(cx.city_canonical, " + tb._fuzzy.format(out="city_canonical", text="i.city_raw_en")
           + ") city_canonical, coalesce(cx.region, " + tb._fuzzy.format(out="region", text="i.city_raw_en")
           + ") region from (select *, nullif(json_extract_string(locations, '$[0].city'), '') city_raw_en from postings) i left join city_map cx using (city_raw_en)", "postings", "city_map"),
)
register(
    "first_match",
    lambda s, d: rules.first_match(
        tb.read(s, d, "part").select("p_partkey", "p_name"), "p_name", tb.title_map(s), "keyword", {"job_category": "hit", "keyword": "by"},
        models.title_order("job_category"),
    ),
    tb.sql("select p_partkey, p_name, " + tb._first.format(out="job_category", table="title_map", text="p_name") + " hit, "
           "(select r.keyword from title_map r where contains(lower(p_name), r.keyword) order by r.priority, length(r.keyword) desc, r.keyword, r.job_category limit 1) \"by\" from part", "title_map"),
)
register(
    "validate_business_rules",
    lambda s, d: validate.with_outcome(payload(s, d)).select(*KEY, "outcome", "reject_reason", "reject_detail"),
    tb.sql("select source, source_job_id, case when reject_reason is null then 'loaded' else 'rejected' end outcome, reject_reason, reject_detail from checked", "checked"),
)
FOCUS = "('" + "'), ('".join(seeds.FOCUS_KEYWORDS) + "')"
register(
    "validate_focus",
    lambda s, d: _focus(s, d),
    tb.sql(f"""select source, source_job_id, case when ok then null else 'OUT_OF_FOCUS' end reason, case when ok then null
      when kind = 'OBJECT' then 'function=''' || coalesce(nullif(json_extract_string(jf, '$.children[0].name'), ''), '?') || ''' parentId=' || json_extract_string(jf, '$.parentId')
      when kind = 'ARRAY' then 'job_function is not a dict: list' when kind = 'INT' then 'job_function is not a dict: int'
      else 'function=''' || job_function || ''' (string, no keyword match)' end detail
    from (select *, job_function is null or (kind = 'OBJECT' and cast(json_extract_string(jf, '$.children[0].id') as int) in (3, 5, 10, 20, 40))
      or (kind = 'STR' and exists (select 1 from (values {FOCUS}) k(w) where contains(lower(job_function), w))) ok
    from (select *, case when starts_with(job_function, '{{') then 'OBJECT' when starts_with(job_function, '[') then 'ARRAY' when regexp_matches(job_function, '^[0-9]+$') then 'INT' else 'STR' end kind,
      case when starts_with(job_function, '{{') then job_function end jf from postings))""", "postings"),
)


def _focus(s, d):
    rows = tb.postings(s, d).withColumn("v", validate.focus([3, 5, 10, 20, 40]))
    return rows.select(*KEY, F.col("v.reason").alias("reason"), F.col("v.detail").alias("detail"))


def _verdict(df, rule):
    return df.withColumn("v", rule).select(*KEY, F.col("v.reason").alias("reason"), F.col("v.detail").alias("detail"))


TITLES = "('" + "'), ('".join(seeds.TITLE_KEYWORDS) + "')"
MARKERS = "('" + "'), ('".join([*seeds.VIETNAM_MARKERS, "nation_1"]) + "')"
register(
    "validate_title_keywords",
    lambda s, d: _verdict(tb.postings(s, d), validate.title_keywords()),
    tb.sql(f"""select source, source_job_id, case when bad then 'OUT_OF_FOCUS' end reason, case when bad then 'title=''' || title || ''' (no keyword match)' end detail
    from (select *, title is not null and not exists (select 1 from (values {TITLES}) k(w) where contains(lower(title), w)) bad from postings)""", "postings"),
)
register(
    "validate_location_vietnam",
    lambda s, d: _verdict(tb.postings(s, d), validate.location_in_vietnam([*seeds.VIETNAM_MARKERS, "nation_1"])),
    tb.sql(f"""select source, source_job_id, case when bad then 'OUT_OF_LOCATION' end reason,
      case when bad then 'locations=''' || array_to_string(cities, ', ') || ''' (not Vietnam)' end detail
    from (select *, len(cities) > 0 and not exists (select 1 from (values {MARKERS}) k(w) where contains(lower(array_to_string(cities, '|')), w)) bad
      from (select *, json_extract_string(locations, '$[*].city') cities from postings))""", "postings"),
)
register(
    "split_valid_rejected",
    lambda s, d: validate.outcome_counters(validate.with_outcome(_broken(s, d))),
    tb.sql("""select count(*) filter (where o = 'l') loaded, count(*) filter (where o = 'r') rejected, 0::bigint skipped, count(*) filter (where o = 'f') failed
    from (select case when ordinal % 17 = 0 then 'f' when reject_reason is not null then 'r' when ordinal % 29 = 0 then 'f' else 'l' end o from checked)""", "checked"),
)


def _broken(s, d):
    """Payloads of which some lack their id and some their parse time."""
    return payload(s, d).withColumns({
        "source_job_id": F.expr("case when ordinal % 17 = 0 then '' else source_job_id end"),
        "parsed_at": F.expr("case when ordinal % 29 = 0 then null else parsed_at end"),
    })


register(
    "load_dry_run",
    lambda s, d: validate.outcome_counters(validate.with_outcome(payload(s, d), validate=False)).unionByName(
        validate.outcome_counters(validate.with_outcome(payload(s, d)))
    ),
    tb.sql("""select count(*) loaded, 0::bigint rejected, 0::bigint skipped, 0::bigint failed from checked
    union all select count(*) filter (where reject_reason is null), count(reject_reason), 0, 0 from checked""", "checked"),
)
register("point_lookup", lambda s, d: reports.point_lookup(tb.postings(s, d), "itviec", "120").select(*RAW),
         tb.sql(f"select {RAW_SQL} from postings where source = 'itviec' and source_job_id = '120'", "postings"))
register("count_by_source", lambda s, d: reports.count_by_source(tb.postings(s, d)),
         tb.sql("select source, count(*) n from postings group by 1", "postings"))
register(
    "json_array_guard",
    lambda s, d: tb.postings(s, d).filter(is_json_array(F.col("skills"))).select(*KEY, F.json_array_length("skills").alias("n")),
    tb.sql("select source, source_job_id, json_array_length(skills) n from postings where json_type(skills) = 'ARRAY'", "postings"),
)
register(
    "non_blank_filter",
    lambda s, d: tb.postings(s, d).filter(is_non_blank(F.col("job_description_text"))).select(*KEY, "job_description_text"),
    tb.sql("select source, source_job_id, job_description_text from postings where trim(job_description_text) <> ''", "postings"),
)
register(
    "regex_flags",
    lambda s, d: models.skill_flags(tb.skill_long(s, d)),
    tb.sql("""select source, source_job_id, bool_or(skill_name_norm = 'python') has_python, bool_or(skill_name_norm = 'sql') has_sql,
      bool_or(regexp_matches(skill_name_norm, 'aws|cloud|azure|gcp')) has_aws_cloud, bool_or(regexp_matches(skill_name_norm, 'ml|ai|llm|machine|deep')) has_ml_ai,
      bool_or(regexp_matches(skill_name_norm, 'spark|hadoop|kafka|flink')) has_bigdata, bool_or(regexp_matches(skill_name_norm, 'power bi|tableau|looker|qlik')) has_bi_tool,
      count(*) n_skills from skill_long group by all""", "skill_long"),
)

# ------------------------------------------------------------------ classification and skills

CLASS_RULES = [
    rules.TitleRule(k, c, p) for k, c, p in tb.TITLE_RULES if k not in ("ring", "c++", "kế toán")
] + [
    rules.TitleRule("c++", "Embedded Engineer", 5), rules.TitleRule("kế toán", "Accounting & Finance", 25),
    rules.TitleRule(r"(red|blue) (bolt|plate)", "Hardware", 12, "regex"), rules.TitleRule("operator small ring", "Exact Hit", 1, "exact"),
    rules.TitleRule("(broken", "Never", 1, "regex"), rules.TitleRule("data", "Inactive", 1, "word_boundary", False),
]


def _rule_order(r):
    return (r.priority, -len(r.pattern), r.pattern, r.job_category)


SORTED_RULES = sorted(CLASS_RULES, key=_rule_order)


def _rule_rows():
    import re

    out = []
    for i, r in enumerate(SORTED_RULES):
        if not r.is_active or r.pattern == "(broken":
            continue
        low = r.pattern.lower()
        rx = {"word_boundary": r"\b" + re.escape(low) + r"\b", "exact": "^" + re.escape(low) + "$", "regex": low}[r.match_mode]
        out.append((i, rx.replace("\\ ", " "), r.job_category, float(round(max(0.5, 1 - r.priority / 100), 2)), r.pattern))
    return out


tb.cte("class_rules", [], tb.values(_rule_rows(), "pos, rx, category, confidence, pattern"))
tb.cte("classified", ["postings", "class_rules"], """select *, case when fn is not null then fn else coalesce(hit.category, 'Other') end job_category_out,
    case when fn is not null then 'source_metadata' when hit.category is not null then 'title_keyword' else 'default' end category_method,
    case when fn is not null then 0.95 else coalesce(hit.confidence, 0.0) end::double category_confidence,
    case when fn is not null then left(job_function, 100) else hit.pattern end category_matched_on
  from (select *, case when source = 'vietnamworks' then case json_extract_string(case when starts_with(job_function, '{') then job_function end, '$.children[0].name')
      when 'Brand#1' then 'Business Development' when 'Brand#2' then 'Technical Sales' when 'Brand#3' then 'Business Analyst' end end fn from postings) p
  left join lateral (select category, confidence, pattern from class_rules r
    where regexp_matches(lower(coalesce(p.title, '')), r.rx) order by pos limit 1) hit on true""")
FN = {"Brand#1": "Business Development", "Brand#2": "Technical Sales", "Brand#3": "Business Analyst"}
CLASS_COLS = ["job_category", "category_method", "category_confidence", "category_matched_on"]
register(
    "classify_title",
    lambda s, d: rules.classify_title(tb.postings(s, d).select(*KEY, "title", "job_function"), SORTED_RULES, FN).select(*KEY, *CLASS_COLS),
    tb.sql("select source, source_job_id, job_category_out job_category, category_method, category_confidence, category_matched_on from classified", "classified"),
)


RUN_WITHOUT = ["data scientist", "backend", "-", "marketing"]  # the rule each run lacks


def _normalize(s, d):
    """Four stored runs over all postings with changing rules, the last one repeated: results, drift log, runs and counters as they are read back."""
    store = RunStore(s, work_dir(s, "normalization"))
    jobs = tb.postings(s, d)
    store.import_drift(jobs.filter("title is not null and source = 'itviec'").selectExpr(
        "'run0' as run_id", "'category' as dimension", "left(title, 200) as raw_value", "source", "1 as frequency",
        "timestamp '2001-06-01 00:00:00' as first_seen_at", "timestamp '2001-06-01 00:00:00' as last_seen_at", "'resolved' as status",
    ).distinct())
    said = []
    for i in (1, 2, 3, 4, 4):
        rules_of_run = [r for r in SORTED_RULES if r.pattern != RUN_WITHOUT[i - 1]]
        counters = store.normalize(jobs, rules_of_run, f"run{i}", RUN_DAYS[i - 1], since=F.lit("1995-01-01").cast("timestamp"), keep=3)
        said.append((f"run{i}", *counters.values()))
    results = store.generations().groupBy("run_id", "run_at", "category_method", "job_category").agg(F.count("*").alias("n")).selectExpr(
        "'result' as part", "run_id", "run_at as moment", "category_method as a", "job_category as b", "n", "0L as more")
    drift = store.drift().selectExpr("'drift' as part", "run_id", "last_seen_at as moment", "raw_value as a", "source || ' ' || status as b", "cast(frequency as bigint) as n", "unix_seconds(first_seen_at) as more")
    kept = s.createDataFrame([("run", r["run_id"], r["rows"]) for r in store.runs()], "part string, run_id string, n long").selectExpr(
        "part", "run_id", "cast(null as timestamp) as moment", "cast(null as string) as a", "cast(null as string) as b", "n", "0L as more")
    counted = s.createDataFrame(said, "run_id string, normalized long, drift long, pruned long").selectExpr(
        "'counter' as part", "run_id", "cast(null as timestamp) as moment", "cast(null as string) as a", "cast(pruned as string) as b", "normalized as n", "drift as more")
    return results.unionByName(drift).unionByName(kept).unionByName(counted)


register(
    "normalize_run", _normalize,
    tb.sql("""with runs as (select r, 'run' || r run_id, timestamp '2001-06-20 00:00:00' + r * interval 1 day run_at, lacks from ("""
           + tb.values([(i + 1, w) for i, w in enumerate(RUN_WITHOUT)], "r, lacks") + """)),
    c as (select r, run_id, run_at, p.source, left(coalesce(title, ''), 200) value,
        case when fn is not null then fn else coalesce((select category from class_rules k where k.pattern <> lacks and regexp_matches(lower(coalesce(title, '')), k.rx) order by pos limit 1), 'Other') end cat,
        case when fn is not null then 'source_metadata' when exists (select 1 from class_rules k where k.pattern <> lacks and regexp_matches(lower(coalesce(title, '')), k.rx)) then 'title_keyword' else 'default' end m
      from runs, (select *, case when source = 'vietnamworks' then case json_extract_string(case when starts_with(job_function, '{') then job_function end, '$.children[0].name') """
           + " ".join(f"when '{k}' then '{v}'" for k, v in seeds.as_dict(seeds.FUNCTION_CATEGORIES).items()) + """ end end fn from postings) p
      where loaded_at >= timestamp '1995-01-01'),
    found as (select value, source, count(distinct r) n, max(r) newest, min(run_at) earliest, max(run_at) latest from c where m = 'default' group by all),
    old as (select distinct left(title, 200) value, source from postings where title is not null and source = 'itviec')
    select 'result' part, run_id, run_at moment, m a, cat b, count(*) n, 0::bigint more from c where r > 1 group by all
    union all select 'drift', case when f.n is null then 'run0' else 'run' || newest end, coalesce(latest, timestamp '2001-06-01'), value, source || ' ' ||
        case when o.here is null then 'new' when f.n is null then 'resolved' else 'regression' end, coalesce(f.n, 0) + case when o.here then 1 else 0 end,
        cast(epoch(case when o.here then timestamp '2001-06-01' else earliest end) as bigint)
      from found f full join (select *, true here from old) o using (value, source)
    union all select 'run', run_id, null, null, null, count(*), 0 from c where r > 1 group by all
    union all select 'counter', run_id, null, null, cast(case when r = 4 then (select count(*) from c where r = 1) else 0 end as varchar), count(*), count(*) filter (where m = 'default') from c group by r, run_id
    union all select 'counter', run_id, null, null, '0', count(*), count(*) filter (where m = 'default') from c where r = 4 group by r, run_id""", "postings", "class_rules"),
)
register(
    "unprocessed_jobs",
    lambda s, d: skills.unprocessed_batch(tb.postings(s, d), tb.half_done_log(s, d), 100),
    tb.sql("""select source, source_job_id, job_description_text, job_requirement_text from postings p where (trim(job_description_text) <> '' or trim(job_requirement_text) <> '')
      and not exists (select 1 from half_done_log l where l.source = p.source and l.source_job_id = p.source_job_id)
    order by parsed_at desc nulls last, source, source_job_id limit 100""", "postings", "half_done_log"),
)
register(
    "count_unprocessed",
    lambda s, d: skills.count_unprocessed(tb.postings(s, d), tb.half_done_log(s, d)),
    tb.sql("""select count(*) n from postings p where (trim(job_description_text) <> '' or trim(job_requirement_text) <> '')
      and not exists (select 1 from half_done_log l where l.source = p.source and l.source_job_id = p.source_job_id)""", "postings", "half_done_log"),
)

TAXONOMY = [
    ("the", "english"), ("of the", "english"), ("and", "english"), ("le", "french"), ("de la", "french"), ("une", "french"),
    ("und", "german"), ("der", "german"), ("für", "german"), ("el", "spanish"), ("los", "spanish"), ("que", "spanish"), ("license", "legal"),
    ("with that by", "english"),
]


def _taxonomy(s, d):
    tax = seeds.table(s, TAXONOMY, "skill string, category string")
    return skills.extract_by_taxonomy(tb.read(s, d, "documents"), ["doc_id"], "text", tax)


register(
    "extract_skills_by_taxonomy", _taxonomy,
    tb.sql("""with t as (""" + tb.values(TAXONOMY, "skill, category") + """),
    w as (select doc_id, ' ' || array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(text), '[.,;:]+(\\s|$)', ' ', 'g'), '[^\\p{L}\\p{N}\\p{M}_+#.\\-/]+'), lambda x: x <> ''), ' ') || ' ' as body from documents)
    select doc_id, skill, category from w join t on contains(body, ' ' || skill || ' ')"""),
)


def _responses(s, d):
    return tb.read(s, d, "orders").selectExpr(
        f"{tb.nth(tb.BOARDS, 'o_orderkey % 5')} as source", "cast(o_orderkey as string) as source_job_id",
        RESPONSE + " as content", "'model-a' as model_used", "cast(case when o_orderkey % 4 = 0 then null else o_orderkey % 900 end as int) as tokens_used",
    )


RESPONSE = (
    "case when o_orderkey % 10 = 0 then 'not json {' when o_orderkey % 10 = 1 then '{\"skills\": []}' else "
    "'{\"skills\":[{\"name\":\" Python ' || o_custkey || ' \",\"name_raw\":\"Py\",\"importance\":\"required\"},\"loose\",{\"name\":\"\"},{\"name\":\"SQL\",\"category\":\"db\",\"confidence\":\"low\"}],"
    "\"experience_years_min\":' || (o_orderkey % 7) || ',\"seniority_level\":\"senior\"}' end"
)
tb.cte("responses", [], f"select {tb.nth(tb.BOARDS, 'o_orderkey % 5')} as source, cast(o_orderkey as string) as source_job_id, o_orderkey, {RESPONSE} as content, o_custkey from orders")
PARSED = """select source, source_job_id, case when o_orderkey % 10 < 2 then '[]' else
  '[{"name":"python ' || o_custkey || '","name_raw":"Py","category":"other","importance":"required","confidence":"medium"},{"name":"sql","name_raw":"","category":"db","importance":"mentioned","confidence":"low"}]' end skills_json,
  case when o_orderkey % 10 < 2 then 0 else 2 end n_skills, case when o_orderkey % 10 >= 2 then cast(o_orderkey % 7 as int) end experience_years_min,
  case when o_orderkey % 10 >= 2 then 'senior' end seniority_level, 'model-a' model_used, cast(case when o_orderkey % 4 = 0 then 0 else o_orderkey % 900 end as int) tokens_used from responses"""
tb.cte("parsed_responses", ["responses"], PARSED)
register("parse_extraction_response", lambda s, d: skills.parse_extraction_response(_responses(s, d)), tb.sql("select * from parsed_responses", "parsed_responses"))


def _skill_log_upsert(s, d):
    log = skills.parse_extraction_response(_responses(s, d)).filter("cast(source_job_id as bigint) % 3 = 0").withColumn(
        "extracted_at", F.lit("2001-01-01").cast("timestamp")
    ).select("source", "source_job_id", "skills_json", "experience_years_min", "model_used", "extracted_at")
    fresh = skills.parse_extraction_response(_responses(s, d).withColumn("model_used", F.lit("model-b")))
    return skills.skill_log_upsert(log, fresh.withColumn("arrival", F.lit(1)), tb.as_of(), ["arrival"])


register(
    "skill_log_upsert", _skill_log_upsert,
    tb.sql(f"""select source, source_job_id, skills_json, experience_years_min, case when n_skills > 0 then 'model-b' else 'model-a' end model_used,
      case when n_skills > 0 then {TS} else timestamp '2001-01-01' end extracted_at from parsed_responses
    where n_skills > 0 or cast(source_job_id as bigint) % 3 = 0""", "parsed_responses"),
)
register(
    "skill_text_join",
    lambda s, d: tb.postings(s, d).select(*KEY, skills.job_text().alias("body")),
    tb.sql("""select source, source_job_id, concat_ws(chr(10) || chr(10), nullif(trim(job_description_text), ''), nullif(trim(job_requirement_text), '')) body from postings""", "postings"),
)

# ------------------------------------------------------------------ joins, aggregates, windows

register(
    "skill_job_join_loose",
    lambda s, d: tb.skill_long(s, d).groupBy("source_job_id").agg(F.count("*").alias("t")).join(
        tb.jobs(s, d).groupBy("source_job_id").agg(F.count("*").alias("j")), "source_job_id"
    ).select("source_job_id", (F.col("t") * F.col("j")).alias("pairs")),
    tb.sql("select s.source_job_id, count(*) pairs from skill_long s join silver j on j.source_job_id = s.source_job_id group by 1", "skill_long", "silver"),
)
register(
    "fact_skill_join",
    lambda s, d: tb.fact(s, d).select(*KEY, "snapshot_date").join(tb.skill_unified(s, d).select(*KEY, "skill_name"), KEY)
    .groupBy("snapshot_date", "skill_name").agg(F.count("*").alias("n")),
    tb.sql("select snapshot_date, skill_name, count(*) n from fact join skill_unified using (source, source_job_id) group by all", "fact", "skill_unified"),
)
register(
    "agg_filter_and_share",
    lambda s, d: tb.silver(s, d).groupBy("job_category").agg(
        F.count("*").alias("n"), F.count_distinct("source_job_id").alias("ids"),
        F.count_if("is_salary_visible").alias("visible"), percent(F.count_if("is_salary_visible"), F.count("*")).alias("visible_pct"),
        F.sum("num_of_views").alias("views"), F.bool_or("is_active").alias("any_active"), F.max("company_name").alias("last_company"),
    ),
    tb.sql("""select job_category, count(*) n, count(distinct source_job_id) ids, count(*) filter (where is_salary_visible) visible,
      floor((2000 * count(*) filter (where is_salary_visible) + count(*)) / (2 * count(*))) / 10 visible_pct, cast(sum(num_of_views) as bigint) views,
      bool_or(is_active) any_active, max(company_name) last_company from silver group by 1""", "silver"),
)
register(
    "latest_by",
    lambda s, d: merge.first_per_key(tb.silver(s, d).filter("company_id is not null"), ["company_id"], [F.col("parsed_at").desc(), "source", "source_job_id"]).select(
        "company_id", "source", "source_job_id", "parsed_at"),
    tb.sql("select company_id, source, source_job_id, parsed_at from silver where company_id is not null qualify row_number() over (partition by company_id order by parsed_at desc, source, source_job_id) = 1", "silver"),
)
register(
    "distinct_on",
    lambda s, d: models.latest_normalization(tb.generations(s, d)),
    tb.sql("select source, source_job_id, arg_max(job_category, run_at) norm_job_category from generations group by all", "generations"),
)
register(
    "agg_array",
    lambda s, d: tb.skill_long(s, d).groupBy(*KEY).agg(F.array_join(F.array_sort(F.collect_set(F.lower("skill_name_norm"))), ",").alias("skills")),
    tb.sql("select source, source_job_id, array_to_string(list_sort(list(distinct lower(skill_name_norm))), ',') skills from skill_long group by all", "skill_long"),
)

# ------------------------------------------------------------------ table checks

CATEGORIES = [c for _, c, _ in tb.TITLE_RULES]


def _checks(s, d):
    return quality.run_checks(
        tb.silver(s, d),
        [
            quality.not_null("title"), quality.not_null("city_canonical"), quality.not_null("company_id"),
            quality.accepted_values("job_category", sorted(set(CATEGORIES))),
            quality.accepted_values("salary_currency", ["VND", "USD", "JPY"], F.col("salary_currency") != ""),
            quality.accepted_range("salary_vnd_monthly_avg", 1_000_000, 2_000_000_000, F.col("salary_vnd_monthly_avg").isNotNull()),
            quality.accepted_range("num_of_views", 0, 450),
        ],
        [["source", "source_job_id"], ["source_job_id"], ["company_id"]],
    )


ACCEPTED = "('" + "', '".join(sorted(set(CATEGORIES))) + "')"
register(
    "dq_run_checks", _checks,
    tb.sql(f"""select 'not_null' check_name, 'title' column_name, count(*) filter (where title is null) failures from silver
    union all select 'not_null', 'city_canonical', count(*) filter (where city_canonical is null) from silver
    union all select 'not_null', 'company_id', count(*) filter (where company_id is null) from silver
    union all select 'accepted_values', 'job_category', count(*) filter (where job_category not in {ACCEPTED}) from silver
    union all select 'accepted_values', 'salary_currency', count(*) filter (where salary_currency not in ('VND', 'USD', 'JPY')) from silver
    union all select 'accepted_range', 'salary_vnd_monthly_avg', count(*) filter (where salary_vnd_monthly_avg not between 1000000 and 2000000000) from silver
    union all select 'accepted_range', 'num_of_views', count(*) filter (where num_of_views not between 0 and 450) from silver
    union all select 'unique_combination', 'source,source_job_id', count(*) from (select 1 from silver group by source, source_job_id having count(*) > 1)
    union all select 'unique', 'source_job_id', count(*) from (select 1 from silver group by source_job_id having count(*) > 1)
    union all select 'unique', 'company_id', count(*) from (select 1 from silver where company_id is not null group by company_id having count(*) > 1)""", "silver"),
)
