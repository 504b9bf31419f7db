"""Operational KPIs and dashboard feeds over the cleansed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions import measures as m
from tradewind.operators.onerow import side_by_side


def _rating_sum() -> list[Column]:
    return [F.sum("rating").cast("decimal(20,2)").alias("rating_sum"), F.count("rating").alias("rated")]


def _mean_rating(otherwise: str) -> Column:
    """Mean to two digits, half to even."""
    mean = F.bround(F.try_divide(F.col("rating_sum"), F.col("rated").cast("decimal(20,0)")), 2)
    return F.coalesce(mean.cast("decimal(5,2)"), F.lit(otherwise).cast("decimal(5,2)"))


def summary_kpis(orders: DataFrame, shipments: DataFrame, inventory: DataFrame, suppliers: DataFrame) -> DataFrame:
    """One row of counts and rates, zeros for empty tables.

    Works on raw feeds too: numbers still held as text are coerced.
    """
    quantity, safety = [
        F.coalesce(F.col(c).cast("string").try_cast("decimal(28,8)"), F.lit(0)) for c in ("quantity_on_hand", "safety_stock")
    ]
    of_orders = orders.agg(
        F.count("*").alias("total_orders"), F.count_if(F.col("status") == "DELIVERED").alias("delivered")
    )
    of_shipments = shipments.agg(
        F.count("*").alias("total_shipments"),
        F.count_if(F.col("status") == "DELAYED").alias("delayed_shipments"),
        F.count_if(F.col("status") == "DELIVERED").alias("on_time_shipments"),
    )
    of_stock = inventory.agg(F.count_if(quantity <= safety).alias("stockout_risk_items"))
    numeric = suppliers.withColumn("rating", F.col("rating").cast("string").try_cast("decimal(10,2)"))
    of_suppliers = numeric.agg(F.count("*").alias("active_suppliers"), *_rating_sum())
    row = side_by_side(of_orders, of_shipments, of_stock, of_suppliers)
    return row.select(
        "total_orders",
        m.pct_half_even(F.col("delivered"), F.col("total_orders")).alias("fulfillment_rate_pct"),
        "total_shipments",
        "delayed_shipments",
        "on_time_shipments",
        m.pct_half_even(F.col("delayed_shipments"), F.col("total_shipments")).alias("delay_pct"),
        "stockout_risk_items",
        "active_suppliers",
        _mean_rating("0").alias("avg_supplier_rating"),
    )


def cleansed_or_raw(cleansed: DataFrame, raw: DataFrame) -> DataFrame:
    """The cleansed table, or the raw feed when it has no rows."""
    return raw if cleansed.isEmpty() else cleansed


def dashboard_kpis(orders: DataFrame, shipments: DataFrame, inventory: DataFrame, iot: DataFrame, suppliers: DataFrame) -> DataFrame:
    """One row of headline figures."""
    of_orders = orders.agg(
        F.count("*").alias("total_orders"),
        F.coalesce(F.sum("total_amount_usd"), F.lit(0)).cast(m.MONEY).alias("total_revenue_usd"),
    )
    of_shipments = shipments.agg(
        F.count_if(F.col("status") == "IN_TRANSIT").alias("active_transit_shipments"),
        F.count_if("is_delayed").alias("delayed_shipments"),
    )
    of_stock = inventory.agg(F.count_if("is_low_stock").alias("low_stock_items"))
    of_iot = iot.agg(F.count_if("is_temp_breach").alias("temp_breaches"))
    row = side_by_side(of_orders, of_shipments, of_stock, of_iot, suppliers.agg(*_rating_sum()))
    return row.select(
        "total_orders",
        "total_revenue_usd",
        "active_transit_shipments",
        "delayed_shipments",
        "low_stock_items",
        "temp_breaches",
        _mean_rating(fixed.DEFAULT_KPI_RATING).alias("avg_supplier_rating"),
    )


def active_shipment_map(shipments: DataFrame, warehouses: DataFrame, rows: int = 40) -> DataFrame:
    """Shipments on the move with the coordinates they left from, first ids first."""
    origin = warehouses.select(
        F.col("warehouse_id").alias("_origin"),
        F.col("name").alias("origin_wh"),
        F.col("latitude").alias("origin_lat"),
        F.col("longitude").alias("origin_lon"),
    )
    # Ids are unique, so picking the rows first leaves the join only those.
    moving = shipments.filter(F.col("status").isin(fixed.ACTIVE_STATUSES)).orderBy("shipment_id").limit(rows)
    return moving.join(origin, F.col("origin_warehouse_id") == F.col("_origin"), "left").select(
        "shipment_id",
        "carrier",
        "mode",
        "status",
        "destination_city",
        "destination_country",
        "origin_wh",
        "origin_lat",
        "origin_lon",
    )


def warehouse_nodes(warehouses: DataFrame) -> DataFrame:
    """Warehouses that can be drawn on a map; a zero coordinate counts as missing."""
    return warehouses.filter((F.col("latitude") != 0) & (F.col("longitude") != 0))


def latest_telemetry(iot: DataFrame, rows: int = 100, limit_c: float = fixed.COLD_CHAIN_LIMIT_C) -> DataFrame:
    newest = iot.orderBy(F.col("recorded_at").desc_nulls_first(), "event_id").limit(rows)
    return newest.withColumn("is_temp_breach", m.exceeds(F.col("temperature_c"), limit_c))


def inventory_watchlist(inventory: DataFrame, warehouses: DataFrame, products: DataFrame, rows: int = 50) -> DataFrame:
    """Low stock first, then lowest quantity, ids breaking ties."""
    places = warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"))
    items = products.select("product_id", F.col("name").alias("product_name"), "category")
    joined = inventory.join(places, "warehouse_id").join(items, "product_id")
    order = [F.col("is_low_stock").desc_nulls_first(), F.col("quantity_on_hand").asc_nulls_last(), F.col("inventory_id")]
    return joined.orderBy(*order).limit(rows).select(
        "inventory_id", "warehouse_name", "product_name", "category", "quantity_on_hand", "reorder_level", "is_low_stock"
    )


def warehouse_utilization(inventory: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Units held per square foot; the feeds give no volume per unit."""
    held = inventory.groupBy("warehouse_id").agg(F.sum("quantity_on_hand").alias("units"))
    units = F.coalesce(F.col("units"), F.lit(0))
    per_sqft = F.try_divide(units.cast("decimal(18,0)"), F.col("capacity_sqft").cast("decimal(10,0)"))
    return warehouses.join(held, "warehouse_id", "left").select(
        "warehouse_id",
        "name",
        "capacity_sqft",
        units.alias("units_on_hand"),
        F.round(per_sqft, 6).cast("decimal(18,6)").alias("units_per_sqft"),
    )


def shipment_lead_time(shipments: DataFrame) -> DataFrame:
    """Hours from shipping to delivery per carrier and mode, delivered shipments only.

    Mean, least and most are exact; the median is taken over whole hours, so
    each task ships one small histogram per lane instead of its rows.
    """
    micros = F.unix_micros("actual_delivery_at") - F.unix_micros("shipped_at")
    timed = shipments.select("carrier", F.col("mode").alias("transit_mode"), micros.alias("micros"))
    done = timed.filter(F.col("micros").isNotNull())
    lanes = done.groupBy("carrier", "transit_mode").agg(
        F.count("*").alias("delivered_shipments"),
        F.sum("micros").alias("total"),
        F.min("micros").alias("least"),
        F.percentile(F.floor(F.col("micros") / 3.6e9), F.lit(0.5)).alias("median_lead_hours"),
        F.max("micros").alias("most"),
    )
    hours = lambda micros: F.round(micros / F.lit(3.6e9), 4)
    return lanes.select(
        "carrier",
        "transit_mode",
        "delivered_shipments",
        hours(F.col("least")).alias("min_lead_hours"),
        "median_lead_hours",
        hours(F.col("most")).alias("max_lead_hours"),
        hours(F.col("total") / F.col("delivered_shipments")).alias("avg_lead_hours"),
    )


def stock_heatmap(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Units per warehouse and category, one row for each cell that holds any item.

    Long form: a category nobody has named beforehand has rows like any other.
    """
    items = products.select("product_id", "category")
    return inventory.join(items, "product_id").groupBy("warehouse_id", "category").agg(F.sum("quantity_on_hand").alias("units"))


def ops_metrics(quality: DataFrame, shipments: DataFrame, iot: DataFrame, latency_ms: float | None = None) -> DataFrame:
    """Gauges of the monitoring board, one row each.

    ``latency_ms`` is what the last run took (``Run.elapsed_ms`` of a batch, or
    a stream's progress); without it that gauge is left out.
    """
    active = shipments.agg(F.count_if(F.col("status").isin(fixed.ACTIVE_STATUSES)).alias("active_shipments_total"))
    breaches = iot.agg(F.count_if("is_temp_breach").alias("iot_temp_breach_total"))
    score = quality.select(F.col("score_pct").alias("data_quality_score_pct"))
    gauges = side_by_side(score, active, breaches)
    if latency_ms is not None:
        gauges = gauges.withColumn("etl_latency_ms", F.lit(latency_ms))
    numbers = gauges.select(*[F.col(c).cast("double").alias(c) for c in gauges.columns])
    return numbers.unpivot([], numbers.columns, "metric", "value")
