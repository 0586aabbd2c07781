"""Record checks. The first failing rule gives (reason, detail)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia import seeds
from vacancia.functions.jsontext import is_filled, json_kind
from vacancia.functions.numeric import python_float_text


def _reject(reason: str, detail: Column) -> Column:
    return F.struct(F.lit(reason).alias("reason"), detail.alias("detail"))


def business_rules() -> Column:
    """Missing title or company, impossible salary or dates. Dates compare as text."""
    smin, smax = F.col("salary_min"), F.col("salary_max")
    posted, expired = F.col("posted_at").cast("string"), F.col("expired_at").cast("string")
    return (
        F.when(~is_filled(F.col("title")), _reject("MISSING_TITLE", F.lit("")))
        .when(~is_filled(F.col("company_name")), _reject("MISSING_COMPANY", F.lit("")))
        .when(
            F.col("is_salary_visible") & (smin > smax),
            _reject(
                "BAD_SALARY_RANGE",
                F.concat(F.lit("min="), python_float_text(smin), F.lit(" > max="), python_float_text(smax)),
            ),
        )
        .when(
            is_filled(posted) & is_filled(expired) & (expired < posted),
            _reject(
                "BAD_DATE_RANGE",
                F.concat(F.lit("expired_at="), expired, F.lit(" < posted_at="), posted),
            ),
        )
    )


def _contains_any(text: Column, words: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def focus(allowed_ids: Sequence[int] = (), keywords: Sequence[str] = tuple(seeds.FOCUS_KEYWORDS)) -> Column:
    """Function id or function name is in focus. Off by default, as in ``business_rules``."""
    jf = F.col("job_function")
    kind = json_kind(jf)
    children = F.from_json(F.get_json_object(jf, "$.children"), "array<struct<id:bigint,name:string>>")
    children = F.when(F.get_json_object(jf, "$.children").startswith("["), children)
    ids = [F.lit(i).cast("bigint") for i in allowed_ids]
    allowed = F.exists(children, lambda c: c["id"].isin(*ids)) if ids else F.lit(False)
    first_name = F.nullif(F.get(children, F.lit(0))["name"], F.lit(""))
    parent_name = F.nullif(F.get_json_object(jf, "$.parentName"), F.lit(""))
    name = F.coalesce(first_name, parent_name, F.lit("?"))
    parent = F.coalesce(F.get_json_object(jf, "$.parentId"), F.lit("None"))
    return (
        F.when(kind == "NoneType", F.lit(None))
        .when(
            kind == "str",
            F.when(
                ~_contains_any(F.lower(jf), keywords),
                _reject("OUT_OF_FOCUS", F.concat(F.lit("function='"), jf, F.lit("' (string, no keyword match)"))),
            ),
        )
        .when(
            kind == "dict",
            F.when(
                ~F.coalesce(allowed, F.lit(False)),
                _reject("OUT_OF_FOCUS", F.concat(F.lit("function='"), name, F.lit("' parentId="), parent)),
            ),
        )
        .otherwise(_reject("OUT_OF_FOCUS", F.concat(F.lit("job_function is not a dict: "), kind)))
    )


def title_keywords(keywords: Sequence[str] = tuple(seeds.TITLE_KEYWORDS)) -> Column:
    title = F.col("title")
    return F.when(
        is_filled(title) & ~_contains_any(F.lower(title), keywords),
        _reject("OUT_OF_FOCUS", F.concat(F.lit("title='"), title, F.lit("' (no keyword match)"))),
    )


def location_in_vietnam(markers: Sequence[str] = tuple(seeds.VIETNAM_MARKERS)) -> Column:
    """Some listed place carries a marker; an empty list passes."""
    places = F.from_json("locations", "array<struct<city:string>>")
    known = F.exists(places, lambda p: _contains_any(F.lower(F.coalesce(p["city"], F.lit(""))), markers))
    shown = F.array_join(F.transform(places, lambda p: F.coalesce(p["city"], F.lit(""))), ", ")
    return F.when(
        (F.coalesce(F.size(places), F.lit(0)) > 0) & ~known,
        _reject("OUT_OF_LOCATION", F.concat(F.lit("locations='"), shown, F.lit("' (not Vietnam)"))),
    )


# ------------------------------------------------------------------ routing

class Split(NamedTuple):
    valid: DataFrame
    rejected: DataFrame
    failed: DataFrame


def with_outcome(df: DataFrame, validate: bool = True, rule: Column | None = None) -> DataFrame:
    """Add outcome (loaded, rejected, failed), reject_reason, reject_detail.

    A record that cannot be keyed or dated fails on its own; the rest of its
    batch still loads.
    """
    readable = F.lit(True)
    if "_corrupt" in df.columns:
        readable = F.col("_corrupt").isNull()
    keyed = is_filled(F.col("source")) & is_filled(F.col("source_job_id"))
    dated = is_filled(F.col("parsed_at").cast("string"))
    verdict = (rule if rule is not None else business_rules()) if validate else F.lit(None).cast(
        "struct<reason:string,detail:string>"
    )
    with_verdict = df.withColumn("_verdict", verdict)
    bad = F.col("_verdict").isNotNull()
    return with_verdict.select(
        *df.columns,
        F.when(~(readable & keyed), "failed").when(bad, "rejected").when(~dated, "failed")
        .otherwise("loaded").alias("outcome"),
        F.col("_verdict.reason").alias("reject_reason"),
        F.col("_verdict.detail").alias("reject_detail"),
    )


def split_valid_rejected(df: DataFrame, validate: bool = True, rule: Column | None = None) -> Split:
    return split_routed(with_outcome(df, validate, rule))


def split_routed(routed: DataFrame) -> Split:
    """The three sides of a frame that already carries its outcome."""
    extra = ["outcome", "reject_reason", "reject_detail"]
    return Split(
        routed.filter("outcome = 'loaded'").drop(*extra),
        routed.filter("outcome = 'rejected'").drop("outcome"),
        routed.filter("outcome = 'failed'").drop(*extra),
    )


def outcome_counters(routed: DataFrame, skipped: int = 0) -> DataFrame:
    """One row of counters in a single pass."""
    def n(name: str) -> Column:
        return F.count_if(F.col("outcome") == name).alias(name)
    return routed.agg(n("loaded"), n("rejected"), F.lit(skipped).cast("bigint").alias("skipped"), n("failed"))


def coerce_record(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Parsed record to table types: ISO text to timestamps, missing lists to '[]', version default."""
    from vacancia.schemas import LIST_COLUMNS, TIMESTAMP_COLUMNS, UPDATABLE_COLUMNS, KEY, JOB_COLUMNS

    kinds = dict(JOB_COLUMNS)

    def value(name: str) -> Column:
        c = F.col(name) if name in df.columns else F.lit(None)
        if name in TIMESTAMP_COLUMNS:
            return F.try_to_timestamp(c.cast("string"))
        if name in LIST_COLUMNS:
            return F.coalesce(c.cast("string"), F.lit("[]"))
        if name == "parser_version":
            return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
        return c.cast(kinds[name])

    return df.select(*[value(c).alias(c) for c in [*KEY, *UPDATABLE_COLUMNS]], *keep)
