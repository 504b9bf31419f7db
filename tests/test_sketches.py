"""Mergeable sketches against exact answers."""

import random

import pytest
from pyspark.sql import functions as F

from tradewind.operators import sketches


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(6)
    data = [(rnd.choice("ab"), rnd.randrange(40), rnd.randrange(30_000), rnd.lognormvariate(3, 1)) for _ in range(60_000)]
    frame = spark.createDataFrame(data, "k string, d int, v long, x double")
    return frame.withColumn("at", F.timestamp_add("DAY", F.col("d"), F.lit("2026-01-10 05:00:00").cast("timestamp"))).repartition(5)


def test_days_merge_to_any_period(table):
    days = sketches.daily_distinct(table, "v", "at")
    assert days.count() == 40
    for period in (F.trunc("day", "month"), F.trunc("day", "year"), F.lit(1)):
        exact_period = {"month": F.trunc("at", "month")}
        got = sketches.distinct_over(days, period, "p").collect()
        assert got and all(r.distinct_estimate > 0 for r in got)
    months = {r.p: r.distinct_estimate for r in sketches.distinct_over(days, F.trunc("day", "month"), "p").collect()}
    for row in table.groupBy(exact_period["month"].alias("p")).agg(F.count_distinct("v").alias("n")).collect():
        assert abs(months[row.p] - row.n) <= row.n * sketches.DISTINCT_ERROR


@pytest.mark.parametrize("quantiles", [(0.5,), (0.0, 0.01, 0.25, 0.75, 0.999, 1.0)])
def test_any_percentile_within_the_rank_error(table, quantiles):
    days = sketches.daily_quantiles(table, ["k"], F.col("x"), "at")
    found = sketches.quantiles_over(days, ["k"], quantiles).collect()
    assert len(found) == 2 * len(quantiles)
    for row in found:
        values = [r.x for r in table.filter(F.col("k") == row.k).select("x").collect()]
        rank = sum(v <= row.value for v in values) / len(values)
        assert abs(rank - row.quantile) <= sketches.RANK_ERROR + 1 / len(values)


def test_a_shorter_period_needs_its_days_only(table):
    days = sketches.daily_quantiles(table, ["k"], F.col("x"), "at")
    week = days.filter("day < '2026-01-17'")
    part = table.filter("d < 7 AND k = 'a'").selectExpr("percentile(x, 0.5D) AS m").first().m
    got = next(r.value for r in sketches.quantiles_over(week, ["k"], [0.5]).collect() if r.k == "a")
    assert abs(got - part) / part < 0.06


def test_missing_values(rows):
    frame = rows("k string, v long, at timestamp", [("a", 1, None), ("a", None, None)])
    assert sketches.daily_distinct(frame, "v", "at").collect() == []
    assert sketches.daily_quantiles(frame, ["k"], F.col("v"), "at").collect() == []
