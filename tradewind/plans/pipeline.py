"""The batch run: cleanse, build the star schema, audit, gate."""

from __future__ import annotations

import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.operators import gold, kpis, quality
from tradewind.plans.medallion import Medallion
from tradewind.sources.files import read_layer, write_bucketed, write_lake_snapshot, write_layer

SILVER = ["suppliers", "warehouses", "products", "customers", "orders", "shipments", "inventory", "iot_sensors"]
# Orders have one row for each id.  Shipments are left as they are: their unknown
# order ids are one hot value, which no bucket could be split for.
BUCKETED_BY = {"orders": "order_id"}
PARALLEL_TABLES = 4


@dataclass
class Run:
    tables: dict[str, DataFrame]
    report: DataFrame
    summary: DataFrame
    metrics: DataFrame
    score_pct: float
    elapsed_ms: int


def _written(
    spark: SparkSession, root: str, layer: str, frames: Mapping[str, DataFrame], buckets: int | None = None
) -> dict[str, DataFrame]:
    """Write tables of one layer side by side and read them back."""

    def store(item: tuple[str, DataFrame]) -> tuple[str, DataFrame]:
        name, frame = item
        if buckets and name in BUCKETED_BY:
            return name, write_bucketed(frame, f"{layer}_{name}", f"{root}/{layer}/{name}", BUCKETED_BY[name], buckets)
        write_layer(frame, root, layer, name)
        return name, read_layer(spark, root, layer, name, frame.schema)

    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return dict(pool.map(store, frames.items()))


def run_pipeline(
    spark: SparkSession,
    source: Medallion,
    root: str,
    snapshot_day: Column | None = None,
    minimum_pct: float | None = fixed.QUALITY_GATE_PCT,
    buckets: int | None = None,
) -> Run:
    """Write every layer under ``root`` and audit it; each layer reads the written one before.

    With ``buckets`` cleansed orders become a catalog table divided by order, so
    that joins and checks on the order move the other side only.
    ``snapshot_day`` also keeps the cleansed tables under that day.  With
    ``minimum_pct=None`` the audit is reported but never stops the run.
    """
    began = time.monotonic()
    silver = _written(spark, root, "silver", {n: getattr(source, n) for n in SILVER}, buckets)
    if snapshot_day is not None:
        for name, frame in silver.items():
            write_lake_snapshot(frame, root, "snapshots", name, snapshot_day)

    dims = _written(
        spark,
        root,
        "gold",
        {
            "dim_date": gold.dim_date_covering(
                *[(silver[name], columns) for name, columns in gold.FACT_MOMENTS.items()],
                missing_date_key=source.missing_date_key,
            ),
            "dim_supplier": gold.dim_supplier(silver["suppliers"]),
            "dim_product": gold.dim_product(silver["products"]),
            "dim_warehouse": gold.dim_warehouse(silver["warehouses"]),
            "dim_customer": gold.dim_customer(silver["customers"]),
            "dim_region": gold.dim_region(silver["customers"], silver["suppliers"]),
        },
    )
    missing = source.missing_date_key
    facts = _written(
        spark,
        root,
        "gold",
        {
            "fact_orders": gold.fact_orders(
                silver["orders"], dims["dim_supplier"], dims["dim_product"], dims["dim_customer"], missing
            ),
            "fact_shipments": gold.fact_shipments(
                silver["shipments"], dims["dim_warehouse"], gold.temp_breach_counts(silver["iot_sensors"]), missing
            ),
            "fact_inventory": gold.fact_inventory(silver["inventory"], dims["dim_warehouse"], dims["dim_product"]),
            "fact_deliveries": gold.fact_deliveries(
                silver["shipments"], silver["orders"], dims["dim_customer"], dims["dim_supplier"], dims["dim_warehouse"]
            ),
        },
    )
    raw = {name: source.raw(name) for name in ("raw_suppliers", "raw_orders")}
    tables = {**raw, **silver, **dims, **facts}
    audit = quality.dq_report(spark, tables, quality.STANDING_CHECKS, F.current_timestamp())
    label = time.strftime("%Y%m%d_%H%M%S", time.gmtime())
    write_layer(audit, root, "quality_reports", label)
    report = read_layer(spark, root, "quality_reports", label, audit.schema)
    # The summary document next to the details, and the board's gauges, whether or not the gate lets the run pass.
    write_layer(quality.dq_summary(report), root, "quality_summaries", label)
    summary = read_layer(spark, root, "quality_summaries", label)
    elapsed = round((time.monotonic() - began) * 1000)
    write_layer(kpis.ops_metrics(summary, silver["shipments"], silver["iot_sensors"], elapsed), root, "metrics", label)
    metrics = read_layer(spark, root, "metrics", label)
    score = quality.dq_gate(summary, 0.0 if minimum_pct is None else minimum_pct)
    return Run(tables, report, summary, metrics, score, elapsed)
