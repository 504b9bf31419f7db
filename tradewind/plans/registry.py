"""The registered queries: each operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions.scoring import risk_level
from tradewind.operators import entities, forecasting, kpis, quality, reports, scorecards, sketches
from tradewind.plans.landing import landed, state_of
from tradewind.plans.medallion import Medallion
from tradewind.plans.registered_io import IO, STREAMS, entity_plans, entity_states, telemetry_gauges
from tradewind.plans.registered_kernels import KERNELS, QUALITY
from tradewind.session import configure
from tradewind.sources import driver_tables
from tradewind.sources.shared import fresh_path, staged

Query = Callable[[SparkSession, str], DataFrame]

#: Feeds whose staged path filters by key where the files are scanned.
FILTERED = {"raw_orders"}


def medallion(
    spark: SparkSession, folder: str, write_cleansed: bool = False, strict: bool = False
) -> Medallion:
    """All tables over a folder; ``strict`` cleanses the castable feeds as well."""
    configure(spark)
    state = state_of(spark, folder)
    castable = {feed: partial(landed, spark, folder, feed, strict=True, state=state, written=feed in FILTERED) for feed in schemas.RAW}
    usual = {feed: partial(landed, spark, folder, feed, strict=strict, state=state) for feed in schemas.RAW}
    return Medallion(usual, castable, keep=staged if write_cleansed else None)


# Where a session keeps its written tables: (application, folder) -> (state of the files, marker, model).
_MARTS: dict[tuple[str, str], tuple[str, str, Medallion]] = {}
_MARTS_LOCK = RLock()


def marts(spark: SparkSession, folder: str) -> Medallion:
    """All tables over a folder, each written when first asked for and read by whoever asks again.

    Reports and audits read these with column pruning, as they do in operation.  They are
    built anew when the folder's files have changed or the shared folder was cleared.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, folder)
    state = state_of(spark, folder)
    with _MARTS_LOCK:
        was, marker, model = _MARTS.get(key, (None, None, None))
        if was == state:
            try:
                spark.read.text(marker)
                return model
            except AnalysisException as gone:
                if gone.getCondition() != "PATH_NOT_FOUND":
                    raise
        marker = fresh_path(spark, "marts")
        spark.createDataFrame([(state,)], "state string").write.text(marker)
        usual = {feed: partial(landed, spark, folder, feed, state=state) for feed in schemas.RAW}
        castable = {feed: partial(landed, spark, folder, feed, strict=True, state=state, written=feed in FILTERED) for feed in schemas.RAW}
        model = Medallion(usual, castable, keep=staged, keep_star=staged)
        _MARTS[key] = (state, marker, model)
        return model


def _over(build: Callable[[Medallion], DataFrame]) -> Query:
    return lambda spark, folder: build(medallion(spark, folder))


def _over_marts(build: Callable[[Medallion], DataFrame]) -> Query:
    return lambda spark, folder: build(marts(spark, folder))


SILVER = {
    "silver_suppliers": lambda m: m.suppliers,
    "silver_warehouses": lambda m: m.warehouses,
    "silver_products": lambda m: m.products,
    "silver_customers": lambda m: m.customers,
    "silver_orders": lambda m: m.orders,
    "silver_shipments": lambda m: m.shipments,
    "silver_inventory": lambda m: m.inventory,
    "silver_iot": lambda m: m.iot_sensors,
}

SILVER_TABLES = list(schemas.SILVER_CONTRACTS)

STAGED = {
    "stg_suppliers": lambda m: m.stg_suppliers,
    "stg_products": lambda m: m.stg_products,
    "stg_warehouses": lambda m: m.stg_warehouses,
    "stg_customers": lambda m: m.stg_customers,
    "stg_orders": lambda m: m.stg_orders,
    "stg_shipments": lambda m: m.stg_shipments,
    "stg_inventory": lambda m: m.stg_inventory,
}

GOLD = {
    "dim_date": lambda m: m.dim_date,
    "dim_supplier": lambda m: m.dim_supplier,
    "dim_product": lambda m: m.dim_product,
    "dim_warehouse": lambda m: m.dim_warehouse,
    "dim_customer": lambda m: m.dim_customer,
    "dim_region": lambda m: m.dim_region,
    "dim_supplier_dbt": lambda m: m.dim_supplier_dbt,
    "dim_product_dbt": lambda m: m.dim_product_dbt,
    "dim_warehouse_dbt": lambda m: m.dim_warehouse_dbt,
    "fact_orders": lambda m: m.fact_orders,
    "fact_orders_dbt": lambda m: m.fact_orders_dbt,
    "temp_breach_counts": lambda m: m.temp_breach_counts,
    "fact_shipments": lambda m: m.fact_shipments,
    "fact_shipments_dbt": lambda m: m.fact_shipments_dbt,
    "fact_inventory": lambda m: m.fact_inventory,
    "fact_deliveries": lambda m: m.fact_deliveries,
}

def _executive_kpi_summary(m: Medallion) -> DataFrame:
    m.prefetch("fact_orders", "fact_shipments", "fact_inventory")
    return reports.executive_kpi_summary(m.fact_orders, m.fact_shipments, m.fact_inventory, unique_ids=True)


# Facts come from deduplicated tables, so their ids are unique.
REPORTS = {
    "executive_kpi_summary": _executive_kpi_summary,
    "supplier_scorecard": lambda m: reports.supplier_scorecard(m.dim_supplier, m.fact_orders, unique_ids=True),
    "carrier_performance": lambda m: reports.carrier_performance(m.fact_shipments),
    "inventory_stockout_risk": lambda m: reports.inventory_stockout_risk(
        m.fact_inventory, m.dim_warehouse_dbt, m.dim_product_dbt
    ),
    "monthly_revenue_mom": lambda m: reports.monthly_revenue_mom(m.fact_orders, m.dim_date, unique_ids=True),
    "product_revenue_rank": lambda m: reports.product_revenue_rank(m.fact_orders, m.dim_product),
}

def _summary_before_cleansing(m: Medallion) -> DataFrame:
    """The summary while orders and inventory have no cleansed rows yet: those come from the raw feeds."""
    tables = {"orders": m.orders.limit(0), "shipments": m.shipments, "inventory": m.inventory.limit(0), "suppliers": m.suppliers}
    return kpis.summary_kpis(*[kpis.cleansed_or_raw(frame, m.raw(f"raw_{name}")) for name, frame in tables.items()])


def _summary_kpis(m: Medallion) -> DataFrame:
    m.prefetch("orders", "shipments", "inventory", "suppliers")
    return kpis.summary_kpis(m.orders, m.shipments, m.inventory, m.suppliers)


KPIS = {
    "summary_kpis_fallback": _summary_before_cleansing,
    "distinct_products": lambda m: sketches.sound_distinct(m.orders, "product_id", "order_date"),
    "lead_time_quantiles": lambda m: sketches.sound_quantiles(m.shipments, ["carrier", "mode"], "shipped_at", "actual_delivery_at"),
    "summary_kpis": _summary_kpis,
    "dashboard_kpis": lambda m: kpis.dashboard_kpis(m.orders, m.shipments, m.inventory, m.iot_sensors, m.suppliers),
    "active_shipment_map": lambda m: kpis.active_shipment_map(m.shipments, m.warehouses),
    "warehouse_nodes": lambda m: kpis.warehouse_nodes(m.warehouses),
    "latest_telemetry": lambda m: kpis.latest_telemetry(m.iot_sensors),
    "inventory_watchlist": lambda m: kpis.inventory_watchlist(m.inventory, m.warehouses, m.products),
    "warehouse_utilization": lambda m: kpis.warehouse_utilization(m.inventory, m.warehouses),
    "shipment_lead_time": lambda m: kpis.shipment_lead_time(m.shipments),
    "stock_heatmap": lambda m: kpis.stock_heatmap(m.inventory, m.products),
}


def _risk(m: Medallion) -> DataFrame:
    scored = scorecards.supplier_risk(m.suppliers, m.orders, m.inventory, m.products)
    return scored.select("supplier_id", "composite_risk_score", "risk_level", "dimension_breakdown.*")


def _demand_model(m: Medallion) -> tuple[DataFrame, PipelineModel]:
    """Features by month, and a model fitted on all months but the last."""
    features = staged(forecasting.demand_features(m.orders), "demand-features")
    last = features.agg(F.max("month_start")).scalar()
    return features, forecasting.fit_demand_model(features.filter(F.col("month_start") < last))


def _demand_forecast(m: Medallion) -> DataFrame:
    """The last month on record, which the model has not seen, measures the confidence."""
    features, model = _demand_model(m)
    last = features.agg(F.max("month_start")).scalar()
    confidence = forecasting.forecast_confidence(model, features.filter(F.col("month_start") == last))
    return forecasting.demand_forecast(forecasting.upcoming_demand(m.orders), model, confidence)


def _demand_forecast_sound(m: Medallion) -> DataFrame:
    """What is determined of the forecast: who gets a model's, who the average, and that the model's agrees with Spark's own."""
    features, model = _demand_model(m)
    upcoming = staged(forecasting.upcoming_demand(m.orders), "upcoming-demand")
    nobody = features.limit(0)
    found = forecasting.demand_forecast(upcoming, model, forecasting.forecast_confidence(model, nobody))
    own = model.transform(upcoming.dropna(subset=forecasting.DEMAND_INPUTS)).select("product_id", F.round("predicted").cast("int").alias("_own"))
    most = features.agg(F.ceil(F.max("demand_7_days"))).scalar()
    demand, modelled = F.col("next_7_days_demand"), F.col("status") == "SUCCESS"
    sound = F.when(modelled, (demand == F.col("_own")) & demand.between(F.lit(0), most)).otherwise(F.col("_own").isNull())
    return found.join(own, "product_id", "left").select(
        "product_id", "status", "model_version", F.when(~modelled, demand).alias("average_demand"), sound.alias("sound")
    )


def _delay_prediction_sound(m: Medallion) -> DataFrame:
    """What is determined of the prediction: its inputs, its level, and that it agrees with Spark's own on each half."""
    features = staged(_delay_features(m), "delay-features")
    parts = []
    for half in (0, 1):
        rows = features.filter(forecasting.fold() == half)
        model = forecasting.fit_delay_model(features.filter(forecasting.fold() != half))
        own = model.transform(rows).select("shipment_id", vector_to_array("probability")[1].alias("_own"))
        found = forecasting.delay_prediction(rows, model).select("shipment_id", "delay_probability_pct", "risk_level", "key_factors.*")
        parts.append(found.join(own, "shipment_id"))
    both = parts[0].unionByName(parts[1])
    percent = F.col("delay_probability_pct")
    # Rounded to a hundredth, so half of one apart at most.
    sound = (F.abs(percent - F.col("_own") * 100.0) <= 0.5 + 1e-6) & (F.col("risk_level") == risk_level(percent))
    return both.select("shipment_id", "transport_mode", "weather_severity", "port_congestion", sound.alias("sound"))


def _delay_features(m: Medallion) -> DataFrame:
    return forecasting.delay_features(m.shipments, m.warehouses, m.iot_sensors)


def _delay_prediction(m: Medallion) -> DataFrame:
    features = staged(_delay_features(m), "delay-features")
    predicted = forecasting.unseen_delay_prediction(features)
    return predicted.select("shipment_id", "delay_probability_pct", "risk_level", "key_factors.*")


SCORES = {
    "composite_risk": _risk,
    "risk_level": lambda m: scorecards.lane_delay_level(m.shipments),
    "carbon_kg": lambda m: scorecards.shipment_emissions(m.shipments, m.orders, m.products, m.warehouses),
    "demand_features": lambda m: forecasting.demand_features(m.orders),
    "upcoming_demand": lambda m: forecasting.upcoming_demand(m.orders),
    "demand_forecast": _demand_forecast,
    "delay_features": _delay_features,
    "delay_prediction": _delay_prediction,
    "demand_forecast_sound": _demand_forecast_sound,
    "delay_prediction_sound": _delay_prediction_sound,
}


def _dq_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Summary of the standing checks on castable feeds, which must pass the gate."""
    summary = staged(QUALITY["dq_summary"](medallion(spark, folder, True, strict=True)), "gate")
    quality.dq_gate(summary)
    return summary


def _entity_objects(spark: SparkSession, folder: str) -> DataFrame:
    """The state object of every tracked shipment, its fields side by side."""
    m = marts(spark, folder)
    plans = entity_plans(driver_tables.DriverTables(spark, folder)["customer"])
    found = entities.entity_objects(entity_states(spark, folder), plans, entities.lane_delays(m.shipments), m.warehouses)
    return found.select("*", "current_location.*").drop("current_location")


def _ops_gauges(spark: SparkSession, folder: str) -> DataFrame:
    """All four gauges of the board from real runs; how long a run took is told only as more than nothing."""
    m = marts(spark, folder)
    batch = kpis.ops_metrics(QUALITY["dq_summary"](m), m.shipments, m.iot_sensors).filter("metric <> 'iot_temp_breach_total'")
    gauges = batch.unionByName(telemetry_gauges(spark, folder))
    timed = F.col("metric") == "etl_latency_ms"
    return gauges.select("metric", F.when(~timed, F.col("value")).alias("value"), (F.col("value") > 0).alias("measured"))


WHOLE = {"entity_objects": _entity_objects, "ops_gauges": _ops_gauges, "dq_gate": _dq_gate}


def queries() -> dict[str, Query]:
    # Kernels and the tables themselves are computed from the feeds, what uses the tables reads them written.
    built = {name: _over(build) for name, build in (KERNELS | SILVER | STAGED | GOLD).items()}
    read = {name: _over_marts(build) for name, build in (REPORTS | KPIS | SCORES | QUALITY).items()}
    return built | read | WHOLE | IO | STREAMS
