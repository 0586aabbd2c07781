"""Alert subscriptions: filter text, matching, dedup, per-chat cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.functions.jsontext import literal_map
from vacancia.operators.merge import first_n_per_key
from vacancia.session import stored

JOB = ["source", "source_job_id"]


def _amount(token: Column) -> Column:
    """Salary floor of a token: number with k / m / tr / b, or a bare 1..10000 in millions."""
    unit = F.regexp_extract(token, r"^(\d+(?:\.\d+)?)(k|m|tr|b)$", 2)
    figure = F.regexp_extract(token, r"^(\d+(?:\.\d+)?)(?:k|m|tr|b)$", 1).try_cast("double")
    scale = (
        F.when(unit == "k", 1e3).when(unit.isin("m", "tr"), 1e6).when(unit == "b", 1e9)
    )
    bare = F.regexp_extract(token, r"^(\d+)$", 1).try_cast("double")
    return F.coalesce(figure * scale, F.when(bare.between(1, 10000), bare * 1e6)).cast("bigint")


def parse_filters(df: DataFrame, text: str) -> DataFrame:
    """Add skills, cities, job_levels, min_salary_vnd from a free-form filter text.

    Tokens are split by blanks, alternatives by commas; each part is classified
    on its own. Several salaries: the highest wins. An empty dimension is NULL.
    """
    cities = literal_map(seeds.as_dict(seeds.ALERT_CITIES))
    levels = literal_map(seeds.as_dict(seeds.ALERT_LEVELS))
    parts = F.filter(F.split(F.lower(F.trim(text)), r"[\s,]+"), lambda t: t != "")

    def some(arr: Column) -> Column:
        distinct = F.array_distinct(arr)
        return F.when(F.size(distinct) > 0, distinct)

    is_city = lambda t: F.map_contains_key(cities, t)
    is_level = lambda t: F.map_contains_key(levels, t)
    is_skill = lambda t: ~is_city(t) & ~is_level(t) & _amount(t).isNull()
    return df.withColumn("_parts", parts).withColumns({
        "skills": some(F.filter("_parts", is_skill)),
        "cities": some(F.transform(F.filter("_parts", is_city), lambda t: F.element_at(cities, t))),
        "job_levels": some(F.transform(F.filter("_parts", is_level), lambda t: F.element_at(levels, t))),
        "min_salary_vnd": F.array_max(F.transform("_parts", _amount)),
    }).drop("_parts")


def new_jobs(silver: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    since = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    return silver.filter((F.col("posted_at") > since) & F.col("is_active"))


#: Pairs of a key that one task compares.
PAIRS = 4_000_000
#: Jobs of one key that are joined as one row, the best paid together.
CHUNK = 64
#: Keys a subscription is filed under at most, if one filter alone does not give more.
KEYS = 64

#: The filters that make keys: the value of a job, the array of a subscription.
_DIMS = {"skill": "skills", "company": "companies", "city": "cities", "level": "job_levels"}
_KEY = ["_shape", *[f"_{dim}" for dim in _DIMS]]


def _filed(active: DataFrame) -> DataFrame:
    """A row for each key of a subscription: the filters that make the key (``_shape``, a bit each) and a value for each of them.

    Filters are taken in turn while the combinations of their values are few; the others stay to be
    compared. ``_before``: the skills that come before the key's own.
    """
    given = {c: F.array_distinct(F.filter(c, lambda v: v.isNotNull())) for c in _DIMS.values()}
    given["skills"] = F.array_distinct(F.filter(F.transform("skills", F.lower), lambda v: v.isNotNull()))
    rows = active.select("subscription_id", "chat_id", "min_salary_vnd", *[v.alias(c) for c, v in given.items()])
    rows = rows.withColumns({"_shape": F.lit(0), "_keys": F.lit(1)})
    for bit, name in enumerate(_DIMS.values()):
        size = F.greatest(F.size(name), F.lit(1))
        taken = F.col(name).isNotNull() & ((F.col("_shape") == 0) | (F.col("_keys") * size <= KEYS))
        rows = rows.withColumn("_taken", taken).withColumns({
            "_shape": F.col("_shape") + F.when(F.col("_taken"), 1 << bit).otherwise(0),
            "_keys": F.col("_keys") * F.when(F.col("_taken"), size).otherwise(1),
        }).drop("_taken")
    for dim, name in _DIMS.items():
        rows = rows.select("*", F.posexplode(F.when(_in_shape(dim), F.col(name)).otherwise(F.array(F.lit("")))).alias("_at", f"_{dim}"))
        if dim == "skill":
            rows = rows.withColumn("_before", F.when(_in_shape(dim) & (F.col("_at") > 0), F.slice(name, F.lit(1), F.col("_at"))))
        rows = rows.withColumn(name, F.when(~_in_shape(dim), F.col(name))).drop("_at")
    return rows.drop("_keys", "skills")


def _in_shape(dim: str) -> Column:
    return F.col("_shape").bitwiseAND(1 << list(_DIMS).index(dim)) != 0


def alert_match(
    subscriptions: DataFrame, jobs: DataFrame, alert_log: DataFrame, as_of: Column, pairs_per_task: int = PAIRS,
) -> DataFrame:
    """(subscription_id, chat_id, source, source_job_id) of new matches. ``jobs`` carry their skill names in the array ``tags``.

    Each subscription is filed under the combinations of the values it asks for (skills, companies, cities,
    levels), a job under its own values for each kind of combination that occurs; one without
    such filters meets every job. The jobs of a key are sorted by pay and joined in chunks of ``CHUNK``, a chunk
    whose best pay is below the subscription's floor not at all, so hardly more pairs are made than the result has.
    The jobs are staged once. Counts of both sides say which keys occur on both, the only ones
    that are joined, into how many slices a key's jobs are cut and into how many tasks all are dealt, so that no task gets
    many more than ``pairs_per_task`` pairs. A job with several of the wanted skills counts under the first of them alone:
    nothing is made distinct.
    """
    spark = jobs.sparkSession
    filed = _filed(subscriptions.filter(F.col("paused_until").isNull() | (F.col("paused_until") <= as_of)))
    tags = F.array_distinct(F.filter(F.transform("tags", F.lower), lambda v: v.isNotNull()))
    facts = stored(jobs.select(
        *JOB, F.col("salary_vnd_monthly_avg").alias("pay"), F.coalesce(tags, F.array().cast("array<string>")).alias("tags"),
        F.col("company_name").alias("company"), F.col("city_canonical").alias("city"), F.col("job_level").alias("level"),
    ), "new-jobs")
    by_key = facts.crossJoin(F.broadcast(filed.select("_shape").distinct())).withColumn(
        "_skill", F.explode(F.when(_in_shape("skill"), F.col("tags")).otherwise(F.array(F.lit(""))))
    ).withColumns({f"_{dim}": F.when(_in_shape(dim), F.col(dim)).otherwise("") for dim in ("company", "city", "level")})

    def n(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*_KEY).agg(F.count("*").alias(name))

    met = F.col("_jobs") * F.col("_subs")
    loads = stored(n(by_key, "_jobs").join(n(filed, "_subs"), _KEY).select(
        *_KEY, met.alias("_met"), F.ceil(met / pairs_per_task).cast("int").alias("_slices")
    ), "alert-loads")
    tasks = int(4 * (loads.agg(F.sum("_met")).first()[0] or 0) // pairs_per_task) + 1
    loads = loads.drop("_met")
    cut = [*_KEY, "_slice"]
    subs = filed.join(loads, _KEY).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    sliced = by_key.join(loads, _KEY).withColumn("_slice", F.pmod(F.xxhash64(*JOB), F.col("_slices")).cast("int")).drop("_slices")
    place = F.row_number().over(Window.partitionBy(*cut).orderBy(F.col("pay").desc_nulls_last(), *JOB))
    chunks = sliced.repartition(tasks, *cut).withColumn("_chunk", F.floor((place - 1) / CHUNK)).groupBy(*cut, "_chunk").agg(
        F.max("pay").alias("_best"), F.collect_list(F.struct(*facts.columns)).alias("_held")
    ).drop("_chunk")
    floor = F.col("min_salary_vnd")
    paid = lambda pay: floor.isNull() | F.coalesce(F.col(pay) >= floor, F.lit(False))
    hits = subs.repartition(tasks, *cut).join(chunks, cut).filter(paid("_best")).select(
        "subscription_id", "chat_id", "min_salary_vnd", "_before", "companies", "cities", "job_levels", F.inline("_held")
    )
    fits = lambda col, arr: F.col(arr).isNull() | F.array_contains(F.col(arr), F.col(col))
    first = F.col("_before").isNull() | ~F.arrays_overlap("_before", "tags")
    pairs = hits.filter(paid("pay") & fits("level", "job_levels") & fits("city", "cities") & fits("company", "companies") & first).select(
        "subscription_id", "chat_id", *JOB
    )
    # Of the log, what is about these jobs; staged, so that its size is known when the pairs are planned.
    said = stored(alert_log.select("subscription_id", "source_job_id").join(facts.select("source_job_id").distinct(), "source_job_id", "left_semi").distinct(), "alert-said")
    # Equal values have equal hashes in one type only.
    alike = [F.col(c).try_cast(pairs.schema[c].dataType).alias(n) for c, n in (("subscription_id", "_sub"), ("source_job_id", "_id"))]
    return pairs.join(said.select(*alike), _same_hash({"subscription_id": "_sub", "source_job_id": "_id"}, nulls=False), "left_anti")


def _same_hash(columns: dict[str, str], nulls: bool) -> Column:
    """Both sides' columns are equal; planned as a join on one number, which is looked up faster than a row. ``nulls``: NULL is like NULL."""
    same = F.xxhash64(*columns) == F.xxhash64(*columns.values())
    for a, b in columns.items():
        alike = (F.col(a) >= F.col(b)) & (F.col(a) <= F.col(b))
        same = same & ((alike | (F.col(a).isNull() & F.col(b).isNull())) if nulls else alike)
    return same


def alert_cap(matches: DataFrame, cap: int = 50, salt: int = 64) -> DataFrame:
    """Add status: the first ``cap`` rows per chat are 'sent', the rest 'skipped_rate_limit'.

    The matches are staged and counted per subscription. A chat's first subscriptions are sent whole as long as
    they fit, the rows of the one that goes beyond the cap are ranked, all others need no rank: matches are neither sorted nor shuffled.
    """
    rows = stored(matches, "alert-matches")
    counted = rows.groupBy("chat_id", "subscription_id").agg(F.count("*").alias("_n"))
    # Each has a row at least, so the first ``cap`` subscriptions of a chat reach its cap.
    first = first_n_per_key(counted, ["chat_id"], ["subscription_id"], cap, salt, rank="_place")
    earlier = Window.partitionBy("chat_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    heads = stored(
        first.withColumn("_left", F.lit(cap) - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).filter("_left > 0").select(
            F.col("chat_id").alias("_chat"), F.col("subscription_id").alias("_sub"), "_left", (F.col("_n") <= F.col("_left")).alias("_whole")
        ), "alert-heads",
    )
    own = _same_hash({"chat_id": "_chat", "subscription_id": "_sub"}, nulls=True)
    known = rows.join(heads, own, "left").filter("_whole is null or _whole")
    sent = lambda yes: F.when(yes, "sent").otherwise("skipped_rate_limit").alias("status")
    rank = F.row_number().over(Window.partitionBy("chat_id").orderBy("subscription_id", *JOB))
    edge = rows.join(heads.filter("not _whole"), own).withColumn("_rank", rank)
    return known.select(*matches.columns, sent(F.col("_whole").isNotNull())).unionByName(
        edge.select(*matches.columns, sent(F.col("_rank") <= F.col("_left")))
    )


def log_new(alert_log: DataFrame, rows: DataFrame) -> DataFrame:
    """Append to the log; a (subscription, job id) already there is left alone."""
    key = ["subscription_id", "source_job_id"]
    # Nearly all keys come once: cutting to the first row in each map task would only sort them twice.
    again = F.lag(F.lit(True)).over(Window.partitionBy(*key).orderBy("source"))
    once = rows.select(*dict.fromkeys([*alert_log.columns, "source"])).withColumn("_again", again).filter("_again is null")
    # After the window, whose order a join by the same key takes over.
    return alert_log.unionByName(once.join(alert_log.select(*key), key, "left_anti").select(*alert_log.columns))


def history_distinct(alert_log: DataFrame) -> DataFrame:
    """Latest log row per job id."""
    from vacancia.operators.merge import first_per_key

    return first_per_key(alert_log, ["source_job_id"], [F.col("sent_at").desc(), F.col("subscription_id")])
