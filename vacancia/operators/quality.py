"""Table checks: each gives (check_name, column_name, failures)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """Rows for which ``bad`` is true fail. ``where`` limits the rows looked at."""

    check: str
    column: str
    bad: Column
    where: Column | None = None

    def count(self) -> Column:
        cond = F.coalesce(self.bad, F.lit(False))
        return F.count_if(cond if self.where is None else cond & F.coalesce(self.where, F.lit(False)))


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNull())


def accepted_values(column: str, allowed: Sequence, where: Column | None = None) -> RowCheck:
    return RowCheck("accepted_values", column, ~F.col(column).isin(*allowed), where)


def accepted_range(column: str, low=None, high=None, where: Column | None = None) -> RowCheck:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | F.coalesce(c < low, F.lit(True))
    if high is not None:
        bad = bad | F.coalesce(c > high, F.lit(True))
    return RowCheck("accepted_range", column, bad, where)


def run_row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row checks in one pass over the table."""
    counted = df.agg(*[c.count().alias(f"_{i}") for i, c in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(c.check).alias("check_name"), F.lit(c.column).alias("column_name"), F.col(f"_{i}").alias("failures"))
        for i, c in enumerate(checks)
    ])
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once; NULL keys do not count for a single column."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    name = "unique" if len(columns) == 1 else "unique_combination"
    return (
        rows.groupBy(*columns).agg(F.count("*").alias("_n")).filter("_n > 1")
        .agg(F.lit(name).alias("check_name"), F.lit(",".join(columns)).alias("column_name"), F.count("*").alias("failures"))
    )


def run_checks(df: DataFrame, row_checks: Sequence[RowCheck], keys: Sequence[Sequence[str]] = ()) -> DataFrame:
    out = run_row_checks(df, row_checks) if row_checks else None
    for k in keys:
        part = unique(df, k)
        out = part if out is None else out.unionByName(part)
    return out
