"""Raw feeds to cleansed tables: lenient casts, defaults, one row per key.

Each operator projects the columns it needs before it deduplicates, so the
load metadata and the payload never reach the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions import measures as m
from tradewind.functions.cleansing import (
    CENTS,
    coerce_int_default,
    coerce_number,
    coerce_number_default,
    coerce_timestamp,
    default_value,
    parse_currency,
)
from tradewind.operators.dedup import dedup_keep_first
from tradewind.schemas import RAW_COLUMNS

ARRIVAL = "ingested_at"


def _unique_rows(raw: DataFrame, table: str, arrival: str | None) -> DataFrame:
    """The feed's own columns, first arrival per key; the key is the first column."""
    columns = RAW_COLUMNS[table]
    order = [arrival] if arrival else []
    return dedup_keep_first(raw.select(*columns, *order), [columns[0]], order).drop(*order)


def silver_suppliers(raw: DataFrame, arrival: str | None = ARRIVAL) -> DataFrame:
    rating = coerce_number_default(F.col("rating"), fixed.DEFAULT_RATING, CENTS)
    rows = _unique_rows(raw, "raw_suppliers", arrival)
    return rows.withColumns({"rating": rating, "is_active": F.lit(True)})


def silver_warehouses(raw: DataFrame, arrival: str | None = ARRIVAL) -> DataFrame:
    return _unique_rows(raw, "raw_warehouses", arrival).withColumns(
        {
            "latitude": coerce_number(F.col("latitude"), "decimal(9,6)"),
            "longitude": coerce_number(F.col("longitude"), "decimal(9,6)"),
            "capacity_sqft": coerce_int_default(F.col("capacity_sqft"), fixed.DEFAULT_CAPACITY_SQFT),
        }
    )


def silver_products(raw: DataFrame, arrival: str | None = ARRIVAL, strict: bool = True) -> DataFrame:
    return _unique_rows(raw, "raw_products", arrival).select(
        "product_id",
        "sku",
        "name",
        "category",
        parse_currency(F.col("unit_cost"), strict=strict).alias("unit_cost_usd"),
        coerce_number_default(F.col("weight_kg"), fixed.DEFAULT_WEIGHT_KG, CENTS).alias("weight_kg"),
        "supplier_id",
    )


def silver_customers(raw: DataFrame, arrival: str | None = ARRIVAL) -> DataFrame:
    return _unique_rows(raw, "raw_customers", arrival)


def silver_orders(raw: DataFrame, arrival: str | None = ARRIVAL, strict: bool = True) -> DataFrame:
    rows = _unique_rows(raw, "raw_orders", arrival).withColumns(
        {
            "quantity": coerce_int_default(F.col("quantity"), fixed.DEFAULT_ORDER_QUANTITY),
            "unit_price_usd": parse_currency(F.col("unit_price"), strict=strict),
        }
    )
    return rows.select(
        "order_id",
        "customer_id",
        "product_id",
        "supplier_id",
        "quantity",
        "unit_price_usd",
        (F.col("quantity") * F.col("unit_price_usd")).cast("decimal(33,2)").alias("total_amount_usd"),
        default_value(F.col("currency"), fixed.DEFAULT_CURRENCY).alias("original_currency"),
        coerce_timestamp(F.col("order_date")).alias("order_date"),
        coerce_timestamp(F.col("required_date")).alias("required_date"),
        "status",
    )


def silver_shipments(raw: DataFrame, arrival: str | None = ARRIVAL) -> DataFrame:
    moments = ["shipped_at", "estimated_delivery_at", "actual_delivery_at"]
    rows = _unique_rows(raw, "raw_shipments", arrival).withColumns(
        {c: coerce_timestamp(F.col(c)) for c in moments}
    )
    late = m.whole_hours_late(F.col("actual_delivery_at"), F.col("estimated_delivery_at"))
    return rows.withColumn("delay_hours", late).withColumn("is_delayed", F.col("delay_hours") > 0)


LOW_STOCK_LEVELS = ("reorder_level", "safety_stock")


def silver_inventory(
    raw: DataFrame, arrival: str | None = ARRIVAL, low_stock_level: str = "reorder_level"
) -> DataFrame:
    """``low_stock_level`` names the level at or below which stock counts as low."""
    if low_stock_level not in LOW_STOCK_LEVELS:
        raise ValueError(f"low_stock_level must be one of {LOW_STOCK_LEVELS}")
    rows = _unique_rows(raw, "raw_inventory", arrival).withColumns(
        {
            "quantity_on_hand": coerce_int_default(F.col("quantity_on_hand"), fixed.DEFAULT_QUANTITY_ON_HAND),
            "reorder_level": coerce_int_default(F.col("reorder_level"), fixed.DEFAULT_REORDER_LEVEL),
            "safety_stock": coerce_int_default(F.col("safety_stock"), fixed.DEFAULT_SAFETY_STOCK),
            "last_counted_at": coerce_timestamp(F.col("last_counted_at")),
        }
    )
    return rows.withColumn("is_low_stock", F.col("quantity_on_hand") <= F.col(low_stock_level))


def silver_iot(raw: DataFrame, arrival: str | None = ARRIVAL, limit_c: float = fixed.COLD_CHAIN_LIMIT_C) -> DataFrame:
    # The limit is checked before the reading is rounded to its stored scale.
    breach = m.exceeds(coerce_number(F.col("temperature_c")), limit_c)
    return _unique_rows(raw, "raw_iot_sensors", arrival).withColumns(
        {
            "is_temp_breach": breach,
            "latitude": coerce_number(F.col("latitude"), "decimal(9,6)"),
            "longitude": coerce_number(F.col("longitude"), "decimal(9,6)"),
            "temperature_c": coerce_number(F.col("temperature_c"), CENTS),
            "humidity_pct": coerce_number(F.col("humidity_pct"), CENTS),
            "battery_level": coerce_int_default(F.col("battery_level"), fixed.DEFAULT_BATTERY_LEVEL),
            "recorded_at": coerce_timestamp(F.col("recorded_at")),
        }
    )
