"""Listing pages and URL lists to frontier items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import jsonld as ld
from vacancia.functions.text import strip
from vacancia.operators.merge import first_per_key

# The boards' public URL shapes.
DETAIL_PATTERNS = {
    "topcv": r"https://www\.topcv\.vn/viec-lam/[\w\-]+/\d+\.html",
    "careerviet": r'href="(/vi/tim-viec-lam/[^"]+\.html)"',
    "linkedin": r'data-entity-urn="urn:li:jobPosting:(\d+)"',
}
ID_PATTERNS = {
    "careerviet": r"^https://careerviet\.vn/vi/tim-viec-lam/.+\.([0-9A-Fa-f]{6,})\.html$",
    "itviec": r"(?U)^https://itviec\.com/it-jobs/[\w\-]+-(\d+)$",
    "topcv": r"(?U)^https://www\.topcv\.vn/viec-lam/[\w\-]+/(\d+)\.html(?:\?.*)?$",
}
ALLOWED_DETAIL = r"^https://www\.vietnamworks\.com/[a-z0-9\-]+-\d+-jv/?$"
DETAIL_BASE = "https://www.vietnamworks.com"


def listing_urls_jsonld(pages: DataFrame) -> DataFrame:
    """(key, position, url): job links of every ItemList block, in page order."""
    lists = ld.objects_of_type(F.col("html"), "ItemList", arrays=False)
    urls = F.flatten(F.transform(
        lists,
        lambda v: F.transform(
            F.coalesce(ld.items(v, "$.itemListElement"), F.array().cast("array<variant>")), lambda i: ld.text(i, "$.url")
        ),
    ))
    kept = F.filter(urls, lambda u: u.contains("/it-jobs/"))
    return pages.select("key", F.posexplode(kept).alias("position", "url"))


def listing_urls_regex(pages: DataFrame, source: str) -> DataFrame:
    """(key, position, url): detail links of a page, first occurrence order; ids for the id-only board."""
    group = 0 if source == "topcv" else 1
    found = F.regexp_extract_all("html", F.lit(DETAIL_PATTERNS[source]), F.lit(group))
    if source == "careerviet":
        found = F.transform(found, lambda p: F.concat(F.lit("https://careerviet.vn"), p))
    if source != "linkedin":
        found = F.array_distinct(found)
    return pages.select("key", F.posexplode(found).alias("position", "url"))


def detect_max_page(html: Column, href_only: bool = False) -> Column:
    """Highest page number among pagination links, at least 1."""
    pattern = r'href="[^"]*[?&]page=(\d+)' if href_only else r"[?&]page=(\d+)"
    numbers = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda n: n.try_cast("bigint"))
    return F.greatest(F.lit(1).cast("bigint"), F.array_max(numbers))


def detail_url(slug: Column, job_id: Column) -> Column:
    """Public detail URL; NULL where slug or id is empty."""
    s = F.lower(F.regexp_replace(F.coalesce(slug, F.lit("")), "^/+|/+$", ""))
    jid = job_id.cast("string")
    suffix = F.concat(F.lit("-"), jid, F.lit("-jv"))
    base = F.lit(f"{DETAIL_BASE}/")
    return F.when(
        (s != "") & (F.trim(jid) != ""),
        F.when(s.endswith(suffix), F.concat(base, s)).otherwise(F.concat(base, s, suffix)),
    )


def detail_url_allowed(url: Column) -> Column:
    return F.coalesce(url, F.lit("")).rlike(ALLOWED_DETAIL)


def route_listing_records(records: DataFrame) -> DataFrame:
    """(job_id, alias, ...) rows with url and route: enqueue, skipped or rejected_url."""
    jid, alias = F.trim(F.coalesce(F.col("job_id").cast("string"), F.lit(""))), F.trim(F.coalesce("alias", F.lit("")))
    url = detail_url(alias, jid)
    return records.withColumns({"job_id": jid, "url": url}).withColumn(
        "route",
        F.when((F.col("job_id") == "") | (alias == "") | F.col("url").isNull(), "skipped")
        .when(~detail_url_allowed(F.col("url")), "rejected_url").otherwise("enqueue"),
    )


def job_id_from_url(url: Column, source: str) -> Column:
    jid = F.nullif(F.regexp_extract(url, ID_PATTERNS[source], 1), F.lit(""))
    return F.upper(jid) if source == "careerviet" else jid


def items_from_urls(urls: DataFrame, source: str) -> DataFrame:
    """(ordinal, url) to frontier items (source, job_id, url, ordinal, route).

    One board keeps the first URL of a job, without its query string; the others
    leave the choice to the frontier, where the last URL wins. The id-only board
    lists ids in ``url``.
    """
    if source == "linkedin":
        jid = strip(F.col("url"))
        view = F.concat(F.lit("https://www.linkedin.com/jobs/view/"), F.col("job_id"))
        items = urls.withColumn("job_id", jid).filter(F.col("job_id") != "").withColumn("url", view)
        return items.select(F.lit(source).alias("source"), "job_id", "url", "ordinal", F.lit("enqueue").alias("route"))
    routed = urls.select(
        F.lit(source).alias("source"), job_id_from_url(F.col("url"), source).alias("job_id"),
        (F.substring_index("url", "?", 1) if source == "topcv" else F.col("url")).alias("url"), "ordinal",
    ).withColumn("route", F.when(F.col("job_id").isNull(), "rejected_url").otherwise("enqueue"))
    if source != "topcv":
        return routed
    good = first_per_key(routed.filter("job_id is not null"), ["job_id"], [F.col("ordinal"), F.col("url")])
    return good.unionByName(routed.filter("job_id is null"))


def seed_counters(items: DataFrame, skipped: bool = False) -> DataFrame:
    """enqueued counts distinct jobs, as sent to the frontier."""
    out = [
        F.count_distinct(F.when(F.col("route") == "enqueue", F.col("job_id"))).alias("enqueued"),
        F.count_if(F.col("route") == "skipped").alias("skipped"),
        F.count_if(F.col("route") == "rejected_url").alias("rejected_url"),
    ]
    return items.agg(*out)


def first_seen(rows: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    """First occurrence per key by ordinal."""
    return first_per_key(rows, keys, [F.col(c) for c in ordinal])


def search_counters(pages: DataFrame) -> DataFrame:
    """Counters over archived search pages (keyword, page, posts array<struct<id>>, error).

    A keyword is empty only when its first page held no posts.
    """
    per_keyword = pages.groupBy("keyword").agg(
        F.sum(F.coalesce(F.size("posts"), F.lit(0))).alias("raw"),
        F.bool_or((F.col("page") == 1) & F.col("error").isNull() & (F.coalesce(F.size("posts"), F.lit(0)) == 0)).alias("empty"),
        F.bool_or(F.col("error").isNotNull()).alias("failed"),
    )
    unique = pages.select(F.explode("posts").alias("p")).agg(
        F.count_distinct(F.nullif(F.col("p.id"), F.lit(""))).alias("n")
    )
    return per_keyword.agg(
        F.count("*").alias("keywords"), F.sum("raw").alias("posts_raw"),
        unique.scalar().alias("posts_unique"),
        F.count_if("empty").alias("empty_keywords"), F.count_if("failed").alias("failed_keywords"),
    )


def search_posts(pages: DataFrame) -> DataFrame:
    """Unique posts over all keywords, first occurrence kept; posts without an id are dropped."""
    rows = pages.select("keyword_no", "page", F.posexplode("posts").alias("position", "p")).select(
        "keyword_no", "page", "position", "p.*"
    ).filter(F.coalesce("id", F.lit("")) != "")
    return first_seen(rows, ["id"], ["keyword_no", "page", "position"])
