"""Salary band to one monthly currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacancia.functions.numeric import round_half_even

# Hourly id, the figure above which an "hourly" salary is really
# monthly, and the plausible monthly band.
HOURLY_PERIOD = 2
HOURLY_CEILING = 10_000_000
BAND = (1_000_000, 5_000_000_000)


def mislabelled_hourly(period_id: Column, salary_min: Column, rate: Column) -> Column:
    """Tagged hourly, but the converted figure can only be monthly."""
    in_vnd = salary_min * F.coalesce(rate, F.lit(1.0))
    return F.coalesce((period_id == HOURLY_PERIOD) & (in_vnd > HOURLY_CEILING), F.lit(False))


def salary_multiplier(period_id: Column, salary_min: Column, rate: Column, months: Column) -> Column:
    """Period to months. The hourly test always looks at the lower bound."""
    return F.when(mislabelled_hourly(period_id, salary_min, rate), F.lit(1.0)).otherwise(
        F.coalesce(months, F.lit(1.0))
    )


def fixed_period(period_id: Column, salary_min: Column, rate: Column) -> Column:
    return F.when(mislabelled_hourly(period_id, salary_min, rate), F.lit(1)).otherwise(period_id)


def to_vnd_monthly(visible: Column, amount: Column, rate: Column, multiplier: Column) -> Column:
    """Rounded monthly figure; NULL when hidden, without a rate, or outside the band."""
    figure = round_half_even(amount * rate * multiplier)
    return F.when(visible & figure.between(*[float(b) for b in BAND]), figure)
