"""Reporting views and analytic queries over the star schema.

Facts are aggregated to the grain of the key before they meet a dimension, so
the join sees one row per key and a hot key is combined on the map side.

Reports count distinct ids.  Where the caller knows ids are unique (facts built
from deduplicated tables), ``unique_ids=True`` counts them without the shuffle
a distinct count needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions import measures as m
from tradewind.operators.onerow import side_by_side
from tradewind.operators.ordinals import dense_rank_desc
from tradewind.sources.shared import staged

STOCKOUT_RULES = ("low_or_safety", "low", "safety")


def _ids(column: str, unique: bool) -> Column:
    return F.count(column) if unique else F.count_distinct(column)


def _sum_or_zero(value: Column | str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def stockout_risk(rule: str) -> Column:
    """Which of the three circulating definitions counts an item as at risk."""
    low = F.col("is_low_stock")
    safety = F.col("quantity_on_hand") <= F.col("safety_stock")
    return {"low_or_safety": low | safety, "low": low, "safety": safety}[rule]


def executive_kpi_summary(
    orders: DataFrame,
    shipments: DataFrame,
    inventory: DataFrame,
    stockout_rule: str = "low_or_safety",
    unique_ids: bool = False,
    refreshed_at: Column | None = None,
) -> DataFrame:
    """One row; each fact is reduced to one row before the three are put side by side."""
    status = F.col("shipment_status")
    of_orders = orders.agg(
        _ids("order_id", unique_ids).alias("total_orders"),
        _sum_or_zero("total_amount_usd").cast(m.MONEY).alias("total_revenue_usd"),
        F.count_if(F.col("order_status") == "DELIVERED").alias("delivered"),
    )
    of_shipments = shipments.agg(
        _ids("shipment_id", unique_ids).alias("total_shipments"),
        F.count_if(F.col("is_delayed") | (status == "DELAYED")).alias("delayed_shipments"),
        F.count_if((status == "DELIVERED") & ~F.col("is_delayed")).alias("on_time"),
        F.sum("delay_hours").alias("delay_hours"),
        F.count("delay_hours").alias("timed"),
        _sum_or_zero("temp_breach_count").alias("total_temp_breaches"),
    )
    of_stock = inventory.agg(
        _ids("inventory_id", unique_ids).alias("total_monitored_skus"),
        F.count_if(stockout_risk(stockout_rule)).alias("stockout_risk_items"),
        _sum_or_zero("inventory_value_usd").cast(m.MONEY).alias("total_inventory_value_usd"),
    )
    row = side_by_side(of_orders, of_shipments, of_stock)
    result = row.select(
        "total_orders",
        "total_revenue_usd",
        m.pct(F.col("delivered"), F.col("total_orders")).alias("order_fulfillment_rate_pct"),
        "total_shipments",
        "delayed_shipments",
        m.pct(F.col("delayed_shipments"), F.col("total_shipments")).alias("shipment_delay_rate_pct"),
        m.pct(F.col("on_time"), F.col("total_shipments")).alias("on_time_delivery_rate_pct"),
        m.average(F.col("delay_hours"), F.col("timed"), 1).alias("avg_shipment_delay_hours"),
        "total_temp_breaches",
        "total_monitored_skus",
        "stockout_risk_items",
        "total_inventory_value_usd",
    )
    return result if refreshed_at is None else result.withColumn("last_refreshed_at", refreshed_at)


def vendor_category(rating: Column) -> Column:
    label = F
    for bound, name in fixed.VENDOR_BANDS:
        label = label.when(rating >= F.lit(bound).cast("decimal(3,2)"), F.lit(name))
    return label.otherwise(F.lit(fixed.VENDOR_OTHERWISE))


def supplier_scorecard(suppliers: DataFrame, orders: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Every supplier with its orders, spend, on-time-in-full share and category."""
    per_key = orders.groupBy("supplier_key").agg(
        _ids("order_id", unique_ids).alias("orders"),
        F.sum("total_amount_usd").alias("spend"),
        F.count_if(F.col("order_status") == "DELIVERED").alias("delivered"),
    )
    scored = suppliers.join(per_key, "supplier_key", "left")
    orders_or_zero = F.coalesce(F.col("orders"), F.lit(0))
    delivered = F.coalesce(F.col("delivered"), F.lit(0))
    return scored.select(
        "supplier_id",
        "supplier_name",
        F.col("country").alias("supplier_country"),
        F.col("tier").alias("supplier_tier"),
        F.col("rating").alias("supplier_base_rating"),
        orders_or_zero.alias("total_orders_fulfilled"),
        F.coalesce(F.col("spend"), F.lit(0)).cast(m.MONEY).alias("total_procurement_spend_usd"),
        delivered.alias("delivered_orders"),
        m.pct(delivered, orders_or_zero).alias("supplier_otif_pct"),
        vendor_category(F.col("rating")).alias("vendor_risk_category"),
    )


def carrier_performance(shipments: DataFrame) -> DataFrame:
    lanes = shipments.groupBy("carrier", "transit_mode").agg(
        F.count("shipment_id").alias("total_shipments_handled"),
        F.count_if("is_delayed").alias("total_delayed_shipments"),
        F.sum("delay_hours").alias("hours"),
        F.count("delay_hours").alias("timed"),
        _sum_or_zero("temp_breach_count").alias("total_cold_chain_breaches"),
    )
    handled, delayed = F.col("total_shipments_handled"), F.col("total_delayed_shipments")
    return lanes.select(
        "carrier",
        "transit_mode",
        handled,
        delayed,
        m.average(F.col("hours"), F.col("timed"), 1).alias("avg_delay_hours"),
        m.pct(handled - delayed, handled).alias("carrier_on_time_pct"),
        "total_cold_chain_breaches",
    )


def stock_status(quantity: Column, safety: Column, reorder: Column) -> Column:
    return (
        F.when(quantity <= safety * F.lit(fixed.CRITICAL_SAFETY_SHARE), fixed.STOCK_CRITICAL)
        .when(quantity <= safety, fixed.STOCK_HIGH)
        .when(quantity <= reorder, fixed.STOCK_REORDER)
        .otherwise(fixed.STOCK_HEALTHY)
    )


def inventory_stockout_risk(inventory: DataFrame, warehouses: DataFrame, products: DataFrame) -> DataFrame:
    quantity, reorder = F.col("quantity_on_hand"), F.col("reorder_level")
    short = inventory.filter(F.col("is_low_stock") | (quantity <= reorder))
    places = warehouses.select("warehouse_key", "warehouse_code", "warehouse_name", F.col("city").alias("warehouse_city"))
    items = products.select("product_key", "sku", "product_name", F.col("category").alias("product_category"))
    return short.join(places, "warehouse_key").join(items, "product_key").select(
        "warehouse_code",
        "warehouse_name",
        "warehouse_city",
        "sku",
        "product_name",
        "product_category",
        quantity,
        "safety_stock",
        reorder,
        "inventory_value_usd",
        stock_status(quantity, F.col("safety_stock"), reorder).alias("stock_status"),
    )


def monthly_revenue_mom(orders: DataFrame, calendar: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Revenue per calendar month, newest first, with growth over the month before.

    Orders are added up per day (and per id, where ids may repeat) before they
    meet the calendar; the window runs over months.
    """
    grain = ["order_date_key"] if unique_ids else ["order_date_key", "order_id"]
    per_day = orders.groupBy(*grain).agg(
        F.sum("total_amount_usd").alias("revenue"),
        F.count("total_amount_usd").alias("priced"),
        F.count("order_id").alias("ids"),
    )
    days = calendar.select("date_key", "year", "month", "month_name")
    orders_in_month = F.sum("ids") if unique_ids else F.count_distinct("order_id")
    months = (
        per_day.join(days, F.col("order_date_key") == F.col("date_key"))
        .groupBy("year", "month", "month_name")
        .agg(
            orders_in_month.alias("monthly_order_count"),
            F.sum("revenue").cast(m.MONEY).alias("monthly_revenue_usd"),
            F.sum("priced").alias("priced"),
        )
    )
    in_time = Window.orderBy("year", "month")
    with_previous = months.withColumn("prev_month_revenue_usd", F.lag("monthly_revenue_usd").over(in_time))
    revenue, previous = F.col("monthly_revenue_usd"), F.col("prev_month_revenue_usd")
    growth = F.try_divide((revenue - previous) * 100, previous)
    return with_previous.select(
        "year",
        "month",
        "month_name",
        "monthly_order_count",
        revenue,
        F.round(F.try_divide(revenue, F.col("priced").cast("decimal(20,0)")), 6).cast("decimal(20,6)").alias("avg_order_value_usd"),
        previous,
        F.round(growth, 2).cast("decimal(20,2)").alias("mom_revenue_growth_pct"),
    ).orderBy(F.col("year").desc_nulls_first(), F.col("month").desc_nulls_first())


def product_sales(orders: DataFrame, products: DataFrame) -> DataFrame:
    per_key = orders.groupBy("product_key").agg(
        F.sum("quantity").alias("units"), F.sum("total_amount_usd").alias("revenue")
    )
    named = products.select("product_key", "sku", "product_name", "category")
    return (
        per_key.join(named, "product_key")
        .groupBy("sku", "product_name", "category")
        .agg(
            F.sum("units").alias("total_units_sold"),
            F.sum("revenue").cast(m.MONEY).alias("gross_revenue_usd"),
        )
    )


def product_revenue_rank(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per product, ranked inside its category, best seller first.

    Sales per product are written once: the ranking reads them twice.
    """
    sold = staged(product_sales(orders, products), "product-sales")
    ranked = dense_rank_desc(sold, "category", "gross_revenue_usd", "category_revenue_rank")
    return ranked.orderBy(F.col("gross_revenue_usd").desc_nulls_first())
