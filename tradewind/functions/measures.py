"""Dates, rates and delay measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed

MONEY = "decimal(20,2)"


def date_key(moment: Column, missing: int | None = fixed.MISSING_DATE_KEY) -> Column:
    """``yyyymmdd`` as an integer; ``missing=None`` keeps NULL for no date."""
    key = (F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)).cast("int")
    return key if missing is None else F.coalesce(key, F.lit(missing))


def pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, half away from zero, NULL when ``whole`` is zero.

    Counts are scaled and divided as integers, so no digit is rounded twice.
    """
    scale = 10**digits
    doubled = F.call_function("div", part * (200 * scale) + whole, F.nullif(whole, F.lit(0)) * 2)
    return (doubled.cast("decimal(16,0)") / F.lit(scale)).cast(f"decimal(12,{digits})")


def pct_half_even(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, half to even, 0 when ``whole`` is zero."""
    share = part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0
    return F.coalesce(F.bround(share, digits), F.lit(0.0))


def average(total: Column, rows: Column, digits: int) -> Column:
    """``total / rows`` rounded half away from zero, 0 for no rows."""
    mean = F.try_divide(total.cast("decimal(20,2)"), rows.cast("decimal(20,0)"))
    return F.coalesce(F.round(mean, digits), F.lit(0)).cast(f"decimal(20,{digits})")


def hours_late(actual: Column, estimated: Column) -> Column:
    """Fractional hours past the estimate, 0 when on time or not yet delivered."""
    micros = F.unix_micros(actual) - F.unix_micros(estimated)
    return F.when(actual > estimated, micros / F.lit(3.6e9)).otherwise(F.lit(0.0))


def whole_hours_late(actual: Column, estimated: Column) -> Column:
    """As ``hours_late`` but cut to whole hours, so 40 minutes count as 0."""
    return F.floor(hours_late(actual, estimated)).cast("int")


def is_late(actual: Column, estimated: Column) -> Column:
    return F.coalesce(actual > estimated, F.lit(False))


def exceeds(value: Column, limit: float) -> Column:
    """``value > limit`` with NULL counted as not exceeding."""
    return F.coalesce(value > F.lit(limit), F.lit(False))


def banded(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose bound ``value`` exceeds; bands run downwards."""
    label = F
    for bound, name in bands:
        label = label.when(value > F.lit(bound), F.lit(name))
    return label.otherwise(F.lit(otherwise))
