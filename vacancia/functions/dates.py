"""Expiry, ISO and relative-date rules. "Now" is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_literal(as_of: str | dt.datetime | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def is_expired(posted_at: Column, expired_at: Column, as_of: Column, stale_days: int = 45) -> Column:
    """Published expiry wins; else a posting ages out; else it stays active."""
    return (
        F.when(expired_at.isNotNull(), expired_at < as_of)
        .when(posted_at.isNotNull(), posted_at < as_of - F.make_dt_interval(F.lit(stale_days)))
        .otherwise(F.lit(False))
    )


def is_past_iso(text: Column, as_of: Column) -> Column:
    """True when ISO text names a past moment; unreadable or empty text is not past."""
    return F.coalesce(F.try_to_timestamp(F.nullif(text, F.lit(""))) < as_of, F.lit(False))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def relative_date(text: Column, as_of: Column) -> Column:
    """'2 weeks ago' against as_of, as ISO text. A month is 30 days; unknown text is now."""
    low = F.lower(F.trim(text))
    pattern = r"(\d+)\s*(second|minute|hour|day|week|month)"
    n = F.regexp_extract(low, pattern, 1).try_cast("int")
    unit = F.regexp_extract(low, pattern, 2)
    seconds = (
        F.when(unit == "second", F.lit(1))
        .when(unit == "minute", 60)
        .when(unit == "hour", 3600)
        .when(unit == "day", 86400)
        .when(unit == "week", 7 * 86400)
        .when(unit == "month", 30 * 86400)
    )
    back = F.coalesce(n.cast("bigint") * seconds, F.lit(0))
    moment = F.timestamp_seconds(F.unix_timestamp(as_of) - back)
    return F.when(F.coalesce(text, F.lit("")) != "", iso_text(moment))


def parse_since(value: str | None) -> dt.datetime | None:
    """CLI option: YYYY-MM-DD or ISO; a naive value is UTC."""
    if not value:
        return None
    try:
        if "T" in value:
            moment = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
        else:
            moment = dt.datetime.strptime(value, "%Y-%m-%d")
    except ValueError as err:
        raise ValueError(f"invalid --since value '{value}': {err}") from err
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
