"""Raw feeds to staged tables: strict casts, normalised text, no deduplication.

Unlike the cleansed tables, text that does not cast stops the job, and every
row with a key is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.cleansing import normalize_text, parse_currency
from tradewind.operators.dedup import require_key

_LOADED = "ingested_at"


def stg_suppliers(raw: DataFrame) -> DataFrame:
    return require_key(raw, "supplier_id").select(
        "supplier_id",
        normalize_text(F.col("name")).alias("supplier_name"),
        F.lower("contact_email").alias("contact_email"),
        "country",
        "region",
        "tier",
        F.col("rating").cast("decimal(3,2)").alias("rating"),
        _LOADED,
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return require_key(raw, "product_id").select(
        "product_id",
        normalize_text(F.col("sku"), "upper").alias("sku"),
        normalize_text(F.col("name")).alias("product_name"),
        "category",
        parse_currency(F.col("unit_cost")).alias("unit_cost_usd"),
        F.col("weight_kg").cast("decimal(10,2)").alias("weight_kg"),
        "supplier_id",
        _LOADED,
    )


def stg_warehouses(raw: DataFrame) -> DataFrame:
    return require_key(raw, "warehouse_id").select(
        "warehouse_id",
        normalize_text(F.col("code"), "upper").alias("warehouse_code"),
        normalize_text(F.col("name")).alias("warehouse_name"),
        "city",
        "country",
        F.col("latitude").cast("decimal(9,6)").alias("latitude"),
        F.col("longitude").cast("decimal(9,6)").alias("longitude"),
        F.col("capacity_sqft").cast("int").alias("capacity_sqft"),
        "temp_zone_type",
        _LOADED,
    )


def stg_customers(raw: DataFrame) -> DataFrame:
    company = normalize_text(F.col("company_name")).alias("company_name")
    return require_key(raw, "customer_id").select(
        "customer_id", company, "industry", "country", "region", "tier", _LOADED
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    typed = require_key(raw, "order_id").withColumns(
        {"quantity": F.col("quantity").cast("int"), "unit_price_usd": parse_currency(F.col("unit_price"))}
    )
    return typed.select(
        "order_id",
        "customer_id",
        "product_id",
        "supplier_id",
        "quantity",
        "unit_price_usd",
        (F.col("quantity") * F.col("unit_price_usd")).cast("decimal(14,2)").alias("total_amount_usd"),
        F.col("order_date").cast("timestamp").alias("order_date"),
        F.col("required_date").cast("timestamp").alias("required_date"),
        F.col("status").alias("order_status"),
    )


def stg_shipments(raw: DataFrame) -> DataFrame:
    return require_key(raw, "shipment_id").select(
        "shipment_id",
        "order_id",
        "origin_warehouse_id",
        "destination_city",
        "destination_country",
        "carrier",
        F.col("mode").alias("transit_mode"),
        F.col("status").alias("shipment_status"),
        *[F.col(c).cast("timestamp").alias(c) for c in ("shipped_at", "estimated_delivery_at", "actual_delivery_at")],
        _LOADED,
    )


def stg_inventory(raw: DataFrame, low_stock_level: str = "safety_stock") -> DataFrame:
    counts = ["quantity_on_hand", "reorder_level", "safety_stock"]
    typed = require_key(raw, "inventory_id").withColumns({c: F.col(c).cast("int") for c in counts})
    low = F.coalesce(F.col("quantity_on_hand") <= F.col(low_stock_level), F.lit(False))
    return typed.select(
        "inventory_id",
        "warehouse_id",
        "product_id",
        *counts,
        low.alias("is_low_stock"),
        F.col("last_counted_at").cast("timestamp").alias("last_counted_at"),
        _LOADED,
    )
