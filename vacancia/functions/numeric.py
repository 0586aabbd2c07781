"""Rounding rules shared by the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column) -> Column:
    """Whole-number rounding of double figures: ties go to the even neighbour."""
    return F.rint(x)


def round_half_up(x: Column) -> Column:
    """Whole-number rounding of averages over integers: ties go up."""
    return F.floor(x + F.lit(0.5)).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to one decimal, ties up, from integer counts only."""
    p, w = part.cast("bigint"), whole.cast("bigint")
    return F.when(w != 0, F.floor((p * 2000 + w) / (w * 2)) / F.lit(10.0))


def mean_1dp(total: Column, n: Column) -> Column:
    """total / n to one decimal, ties up, for non-negative integer totals."""
    return F.when(n != 0, F.floor((total * 20 + n) / (n * 2)) / F.lit(10.0))


def in_millions_1dp(x: Column) -> Column:
    """x / 1e6 to one decimal, ties up."""
    return F.floor(x / F.lit(100000.0) + F.lit(0.5)) / F.lit(10.0)


def python_float_text(x: Column) -> Column:
    """A double written the way the reject details write it (``1000.0``)."""
    whole = F.concat(x.cast("decimal(30,0)").cast("string"), F.lit(".0"))
    part = F.regexp_replace(x.cast("decimal(30,8)").cast("string"), "0+$", "")
    return F.when(x == F.floor(x), whole).otherwise(part)
