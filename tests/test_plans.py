"""What the physical plans must and must not contain."""

import pytest

from tradewind.plans import registry

FOLDER = "/root/testdata/sf0.001"
LAZY = registry.SILVER | registry.STAGED | registry.GOLD | registry.REPORTS | registry.KPIS


@pytest.fixture(scope="module")
def plans(spark):
    m = registry.medallion(spark, FOLDER)
    return {name: build(m)._jdf.queryExecution().executedPlan().toString() for name, build in LAZY.items()}


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_python_rows_and_no_cross_join(plans, name):
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plans[name]


def test_reports_read_only_the_columns_they_need(plans):
    assert "raw_payload" not in "".join(plans.values())
    assert "contact_email" not in plans["summary_kpis"].split("ReadSchema")[-1]


def test_active_filter_runs_before_the_join(plans):
    plan = plans["active_shipment_map"]
    assert plan.index("TakeOrderedAndProject") < plan.index("IN_TRANSIT")


@pytest.mark.parametrize("name", ["silver_orders", "silver_shipments", "silver_iot"])
def test_cleansing_shuffles_once(plans, name):
    assert plans[name].count("Exchange") == 1


def test_staging_does_not_shuffle(plans):
    for name in registry.STAGED:
        assert "Exchange" not in plans[name]


def test_key_filter_reaches_the_files(plans):
    assert "PushedFilters: [IsNotNull(order_id)]" in plans["stg_orders"]


def test_value_rules_shuffle_once_per_key(spark):
    """Uniqueness of a key and all references to it are counted by one exchange, without joins."""
    from tradewind import schemas
    from tradewind.operators import quality

    rules = quality.contract_rules(schemas.SILVER_CONTRACTS) + quality.contract_rules(schemas.GOLD_CONTRACTS, "gold")
    by_value = [r for r in rules if r.kind in quality.PER_VALUE]
    domains = {quality._domain(r) for r in by_value}
    assert len(domains) < len(by_value)
    columns = {c for r in by_value for e, c in (quality._domain(r), (r.entity, r.columns[0]))}
    wide = spark.createDataFrame([], ", ".join(f"{c} string" for c in columns)).repartition(2)
    tables = {e: wide for r in by_value for e, _ in (quality._domain(r), (r.entity, None))}
    plan = quality.run_rules(spark, tables, by_value)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == len(domains) and "Join" not in plan


def test_feeds_are_spread_over_the_cores(spark):
    for feed in ("raw_orders", "raw_shipments"):
        assert registry.landed(spark, "/root/testdata/sf0.01", feed).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_the_shipment_topic_is_streamed_without_a_join(spark):
    from tradewind.plans.registered_io import shipment_records

    records = shipment_records(spark, FOLDER)
    assert records.isStreaming and "Join" not in records._jdf.queryExecution().analyzed().toString()
