import tempfile

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators.quality import DECLARED_RULES, QualityGateError, dq_summary, run_rules
from tradewind.plans import pipeline, registry
from tradewind.plans.medallion import Medallion

FOLDER = "/root/testdata/sf0.001"


def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_pipeline_writes_every_layer_and_passes_the_gate(spark):
    strict = {feed: registry.landed(spark, FOLDER, feed, strict=True) for feed in schemas.RAW}
    where = root()
    run = pipeline.run_pipeline(spark, Medallion(strict), where, F.lit("2026-08-13"))
    assert run.score_pct >= 70
    assert run.report.count() == 10
    for name in ("silver/orders", "gold/fact_orders", "gold/fact_deliveries", "snapshots/orders/ingest_date=2026-08-13"):
        assert spark.read.parquet(f"{where}/{name}").count() > 0
    gauges = {r.metric: r.value for r in run.metrics.collect()}
    assert set(gauges) == {"data_quality_score_pct", "active_shipments_total", "iot_temp_breach_total", "etl_latency_ms"}
    assert gauges["etl_latency_ms"] == run.elapsed_ms > 0 and gauges["data_quality_score_pct"] == run.score_pct
    summary = run.summary.first()
    assert (summary.total_tests, summary.passed + summary.failed) == (10, 10) and run.summary.exceptAll(dq_summary(run.report)).isEmpty()
    lazily = Medallion(strict)
    assert run.tables["fact_orders"].exceptAll(lazily.fact_orders).isEmpty()
    assert run.tables["fact_shipments"].exceptAll(lazily.fact_shipments).isEmpty()


def test_gate_stops_a_bad_run(spark):
    dirty = registry.medallion(spark, FOLDER)
    with pytest.raises(QualityGateError):
        pipeline.run_pipeline(spark, dirty, root(), minimum_pct=99.0)
    assert pipeline.run_pipeline(spark, dirty, root(), minimum_pct=None).score_pct < 99


def test_bucketed_orders_are_not_shuffled_again(spark):
    strict = {feed: registry.landed(spark, FOLDER, feed, strict=True) for feed in schemas.RAW}
    where = root()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = pipeline.run_pipeline(spark, Medallion(strict), where, buckets=4)
        rule = [r for r in DECLARED_RULES if r.name == "SR-05"]
        plan = run_rules(spark, run.tables, rule)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in pipeline.BUCKETED_BY:
            spark.sql(f"DROP TABLE IF EXISTS silver_{name}")
    assert plan.count("hashpartitioning(order_id") <= 1 and "SortMergeJoin" in plan
    assert run.score_pct >= 70
