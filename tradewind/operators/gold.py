"""Cleansed tables to the star schema.

Dimensions carry a dense key ordered by the natural id.  Facts find their keys
by left joins without hints: Spark broadcasts a dimension when its measured
size allows and otherwise shuffles both sides, splitting hot keys at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions import measures as m
from tradewind.operators.ordinals import surrogate_key


def _calendar(days: DataFrame, day: Column) -> DataFrame:
    iso_weekday = F.weekday(day) + 1
    return days.select(
        m.date_key(day, missing=None).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_weekday >= 6).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = fixed.CALENDAR_START, days: int = fixed.CALENDAR_DAYS) -> DataFrame:
    """``days`` consecutive days from ``start``."""
    offsets = spark.range(days)
    return _calendar(offsets, F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")))


def dim_date_covering(*tables: tuple[DataFrame, list[str]], missing_date_key: int | None = None) -> DataFrame:
    """Every day from the first to the last of the given timestamp columns of the given tables.

    ``missing_date_key`` adds the day that facts name in place of a missing
    date, so that each of their date keys has its row.
    """
    spans = [
        rows.agg(
            F.least(*[F.min(F.to_date(c)) for c in columns], F.lit(None)).alias("lo"),
            F.greatest(*[F.max(F.to_date(c)) for c in columns], F.lit(None)).alias("hi"),
        )
        for rows, columns in tables
    ]
    span = reduce(DataFrame.union, spans).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = F.when(F.col("lo").isNotNull(), F.sequence("lo", "hi")).otherwise(F.array().cast("array<date>"))
    if missing_date_key is not None:
        stand_in = F.to_date(F.lit(str(missing_date_key)), "yyyyMMdd")
        days = F.array_union(days, F.array(stand_in))
    return _calendar(span.select(F.explode(days).alias("day")), F.col("day"))


# What the facts take their date keys from.
FACT_MOMENTS = {
    "orders": ["order_date"],
    "shipments": ["shipped_at", "actual_delivery_at"],
    "inventory": ["last_counted_at"],
}


def dim_supplier(suppliers: DataFrame) -> DataFrame:
    named = suppliers.withColumnsRenamed({"name": "supplier_name"})
    if "is_active" not in named.columns:
        named = named.withColumn("is_active", F.lit(True))
    return surrogate_key(named.drop("ingested_at"), "supplier_id", "supplier_key")


def dim_product(products: DataFrame) -> DataFrame:
    named = products.withColumnsRenamed({"name": "product_name"}).drop("ingested_at")
    return surrogate_key(named, "product_id", "product_key")


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    named = warehouses.withColumnsRenamed({"code": "warehouse_code", "name": "warehouse_name"})
    return surrogate_key(named.drop("ingested_at"), "warehouse_id", "warehouse_key")


def dim_customer(customers: DataFrame) -> DataFrame:
    return surrogate_key(customers.drop("ingested_at"), "customer_id", "customer_key")


def dim_region(customers: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Distinct regions of customers and suppliers; the feeds tell nothing more about them."""
    regions = customers.select("region").union(suppliers.select("region")).dropna().distinct()
    keyed = surrogate_key(regions.withColumnRenamed("region", "region_name"), "region_name", "region_key")
    unknown = F.lit(None).cast("string")
    return keyed.withColumns({"subregion": unknown, "continent": unknown, "primary_hub": unknown})


def _with_key(facts: DataFrame, dim: DataFrame, natural_id: str, key: str, fact_column: str | None = None, match_null: bool = False) -> DataFrame:
    """Left join that adds the dimension's key as ``key``."""
    lookup = dim.select(F.col(natural_id).alias("_natural_id"), F.col(key.removeprefix("origin_")).alias(key))
    own = F.col(fact_column or natural_id)
    other = F.col("_natural_id")
    on = own.eqNullSafe(other) if match_null else own == other
    return facts.join(lookup, on, "left").drop("_natural_id")


def fact_orders(
    orders: DataFrame,
    suppliers: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    missing_date_key: int | None = fixed.MISSING_DATE_KEY,
    match_null_keys: bool = False,
) -> DataFrame:
    """Orders with dimension keys; ``match_null_keys`` joins a missing id to a missing id."""
    keyed = _with_key(orders, suppliers, "supplier_id", "supplier_key", match_null=match_null_keys)
    keyed = _with_key(keyed, products, "product_id", "product_key", match_null=match_null_keys)
    keyed = _with_key(keyed, customers, "customer_id", "customer_key", match_null=match_null_keys)
    return keyed.select(
        "order_id",
        "customer_key",
        "product_key",
        "supplier_key",
        m.date_key(F.col("order_date"), missing_date_key).alias("order_date_key"),
        "quantity",
        "unit_price_usd",
        "total_amount_usd",
        F.col("status").alias("order_status"),
    )


def fact_orders_dbt(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Staged orders on natural ids; an unknown supplier becomes NULL."""
    known = suppliers.select(F.col("supplier_id").alias("known_supplier"))
    return orders.join(known, F.col("supplier_id") == F.col("known_supplier"), "left").select(
        "order_id",
        "customer_id",
        "product_id",
        F.col("known_supplier").alias("supplier_id"),
        "quantity",
        "unit_price_usd",
        "total_amount_usd",
        "order_date",
        "order_status",
    )


def temp_breach_counts(iot: DataFrame) -> DataFrame:
    breaches = iot.filter("is_temp_breach")
    return breaches.groupBy("shipment_id").agg(F.count("*").alias("temp_breach_count"))


def fact_shipments(
    shipments: DataFrame,
    warehouses: DataFrame,
    breaches: DataFrame,
    missing_date_key: int | None = fixed.MISSING_DATE_KEY,
    match_null_keys: bool = False,
) -> DataFrame:
    """Shipments with keys and their breach count.

    ``missing_date_key`` also stands in for the delivery date of undelivered
    shipments; pass None to keep that date NULL.
    """
    counts = breaches.select(F.col("shipment_id").alias("_shipment"), "temp_breach_count")
    own, other = F.col("shipment_id"), F.col("_shipment")
    counted = shipments.join(counts, own.eqNullSafe(other) if match_null_keys else own == other, "left")
    keyed = _with_key(counted, warehouses, "warehouse_id", "origin_warehouse_key", "origin_warehouse_id", match_null_keys)
    return keyed.select(
        "shipment_id",
        "order_id",
        "origin_warehouse_key",
        m.date_key(F.col("shipped_at"), missing_date_key).alias("shipped_date_key"),
        m.date_key(F.col("actual_delivery_at"), missing_date_key).alias("delivery_date_key"),
        "carrier",
        F.col("mode").alias("transit_mode"),
        F.col("status").alias("shipment_status"),
        "delay_hours",
        "is_delayed",
        F.coalesce(F.col("temp_breach_count"), F.lit(0)).cast("int").alias("temp_breach_count"),
    )


def fact_shipments_dbt(shipments: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Staged shipments with fractional delay; late by any amount is delayed."""
    actual, estimated = F.col("actual_delivery_at"), F.col("estimated_delivery_at")
    return _with_key(shipments, warehouses, "warehouse_id", "origin_warehouse_key", "origin_warehouse_id").select(
        "shipment_id",
        "order_id",
        "origin_warehouse_key",
        "carrier",
        "transit_mode",
        "shipment_status",
        "shipped_at",
        "estimated_delivery_at",
        "actual_delivery_at",
        m.hours_late(actual, estimated).alias("delay_hours"),
        m.is_late(actual, estimated).alias("is_delayed"),
    )


def fact_inventory(inventory: DataFrame, warehouses: DataFrame, products: DataFrame, missing_date_key: int | None = None) -> DataFrame:
    costs = products.select(F.col("product_id").alias("_product_id"), "product_key", "unit_cost_usd")
    priced = inventory.join(costs, F.col("product_id") == F.col("_product_id"), "left")
    return _with_key(priced, warehouses, "warehouse_id", "warehouse_key").select(
        "inventory_id",
        "warehouse_key",
        "product_key",
        m.date_key(F.col("last_counted_at"), missing_date_key).alias("snapshot_date_key"),
        "quantity_on_hand",
        "reorder_level",
        "safety_stock",
        "is_low_stock",
        (F.col("quantity_on_hand") * F.col("unit_cost_usd")).cast("decimal(33,2)").alias("inventory_value_usd"),
        "last_counted_at",
    )


def fact_deliveries(
    shipments: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    suppliers: DataFrame,
    warehouses: DataFrame,
) -> DataFrame:
    """Delivered shipments against their promise; no feed carries a satisfaction score."""
    parties = orders.select(F.col("order_id").alias("_order"), "customer_id", "supplier_id")
    done = shipments.filter(F.col("actual_delivery_at").isNotNull())
    keyed = done.join(parties, F.col("order_id") == F.col("_order"), "left")
    keyed = _with_key(keyed, warehouses, "warehouse_id", "origin_warehouse_key", "origin_warehouse_id")
    keyed = _with_key(keyed, suppliers, "supplier_id", "supplier_key")
    keyed = _with_key(keyed, customers, "customer_id", "customer_key")
    return keyed.select(
        "shipment_id",
        "order_id",
        "customer_key",
        "supplier_key",
        F.col("origin_warehouse_key").alias("warehouse_key"),
        m.date_key(F.col("actual_delivery_at"), None).alias("delivery_date_key"),
        F.date_diff("estimated_delivery_at", "shipped_at").alias("promised_days"),
        F.date_diff("actual_delivery_at", "shipped_at").alias("actual_days"),
        (F.col("actual_delivery_at") <= F.col("estimated_delivery_at")).alias("on_time_delivery_flag"),
        F.lit(None).cast("decimal(3,2)").alias("customer_satisfaction_score"),
    )
