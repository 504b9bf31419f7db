"""Distinct counts and quantiles that can be kept by day and merged to any period.

Exact reports stay the default.  These keep a sketch a day, some kilobytes whatever the day holds, and
answer for a month, a quarter or all time from the days' sketches, without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct-count sketch, as a power of 2, and the relative error allowed: four standard deviations.
DISTINCT_BITS = 14
DISTINCT_ERROR = 4 * 0.8326 / 2 ** (DISTINCT_BITS / 2)
#: Size of a quantile sketch and the error of a rank it keeps to in 99 of 100 cases; twice that is allowed after merging.
QUANTILE_SIZE = 400
RANK_ERROR = 2 * 0.0091
QUANTILES = (0.5, 0.9, 0.99)


def daily_distinct(rows: DataFrame, value: str, moment: str) -> DataFrame:
    """day and sketch: the different values of each day.  Rows without a date are left out."""
    dated = rows.filter(F.col(moment).isNotNull())
    return dated.groupBy(F.to_date(moment).alias("day")).agg(F.hll_sketch_agg(value, F.lit(DISTINCT_BITS)).alias("sketch"))


def distinct_over(days: DataFrame, period: Column, name: str) -> DataFrame:
    """``name`` and the estimated number of different values of each period, from its days' sketches."""
    return days.groupBy(period.alias(name)).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))


def sound_distinct(rows: DataFrame, value: str, moment: str) -> DataFrame:
    """The exact number of each month, and whether the merged sketches' estimate is within its bound."""
    month = lambda at: F.trunc(at, "month")
    exact = rows.filter(F.col(moment).isNotNull()).groupBy(month(F.to_date(moment)).alias("month")).agg(F.count_distinct(value).alias("distinct_exact"))
    guess = distinct_over(daily_distinct(rows, value, moment), month(F.col("day")), "month")
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_exact")) <= F.greatest(F.lit(1.0), F.col("distinct_exact") * DISTINCT_ERROR)
    return exact.join(guess, "month", "left").select("month", "distinct_exact", F.coalesce(close, F.lit(False)).alias("sound"))


def daily_quantiles(rows: DataFrame, keys: Sequence[str], value: Column, moment: str) -> DataFrame:
    """keys, day and sketch: the values of each day, hours say.  Rows without a date or value are left out."""
    known = rows.withColumn("_value", value.cast("double")).filter(F.col(moment).isNotNull() & F.col("_value").isNotNull())
    return known.groupBy(*keys, F.to_date(moment).alias("day")).agg(F.kll_sketch_agg_double("_value", F.lit(QUANTILE_SIZE)).alias("sketch"))


def quantiles_over(days: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """keys, quantile and value, from the merged sketches of all days in ``days``: filter those for a shorter period."""
    merged = days.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(QUANTILE_SIZE)).alias("sketch"))
    asked = [F.struct(F.lit(q).alias("quantile"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("value")) for q in quantiles]
    return merged.select(*keys, F.inline(F.array(*asked)))


def sound_quantiles(shipments: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """keys, quantile, deliveries, and whether the merged sketches' value has a rank within the bound."""
    hours = (F.unix_micros(end) - F.unix_micros(start)).cast("double") / 3_600_000_000.0
    guess = quantiles_over(daily_quantiles(shipments, keys, hours, end), keys)
    # A value's rank is anything from the share below it to the share up to it.
    known = shipments.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_hours", hours)
    counted = known.join(guess, list(keys)).groupBy(*keys, "quantile").agg(
        F.count("*").alias("delivered"), F.count_if(F.col("_hours") < F.col("value")).alias("_below"), F.count_if(F.col("_hours") <= F.col("value")).alias("_upto")
    )
    slack = F.greatest(F.lit(1.0), F.col("delivered") * RANK_ERROR)
    asked = F.col("quantile") * F.col("delivered")
    sound = (F.col("_below") <= asked + slack) & (F.col("_upto") >= asked - slack)
    return counted.select(*keys, "quantile", "delivered", sound.alias("sound"))
