"""Risk and emission scores over tables.

The reports leave open where the inputs of a score come from.  Here they come
from the cleansed tables: what the scores do with them is in
``tradewind.functions.scoring``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.scoring import carbon_kg, composite_risk, risk_level

KM_PER_DEGREE = 111.0


def grid_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance along meridians and parallels at the equator's scale."""
    degrees = F.abs(lat1 - lat2) + F.abs(lon1 - lon2)
    return degrees.cast("double") * F.lit(KM_PER_DEGREE)


def with_distance(shipments: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Shipments with ``distance_km`` from their warehouse to the destination country's."""
    start = warehouses.select(
        F.col("warehouse_id").alias("_from"), F.col("latitude").alias("_lat1"), F.col("longitude").alias("_lon1")
    )
    end = warehouses.groupBy(F.col("country").alias("_to")).agg(
        F.min("latitude").alias("_lat2"), F.min("longitude").alias("_lon2")
    )
    placed = shipments.join(start, F.col("origin_warehouse_id") == F.col("_from"), "left").join(
        end, F.col("destination_country") == F.col("_to"), "left"
    )
    distance = grid_km(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))
    return placed.select(*shipments.columns, distance.alias("distance_km"))


def shipment_emissions(shipments: DataFrame, orders: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Kilograms of CO2 per shipment: ordered weight over the shipped distance."""
    weights = products.select("product_id", "weight_kg")
    loads = orders.join(weights, "product_id").select(
        F.col("order_id").alias("_order"), (F.col("quantity") * F.col("weight_kg")).alias("load_kg")
    )
    loaded = shipments.select("shipment_id", "order_id", "origin_warehouse_id", "destination_country", "mode").join(
        loads, F.col("order_id") == F.col("_order"), "left"
    )
    return with_distance(loaded, warehouses).select(
        "shipment_id", "mode", "distance_km", carbon_kg(F.col("load_kg"), F.col("distance_km"), F.col("mode")).alias("carbon_kg")
    )


def _share_pct(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double") * 100.0


def supplier_risk(suppliers: DataFrame, orders: DataFrame, inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Composite risk per supplier; dimensions no table speaks about keep their default."""
    late = orders.groupBy("supplier_id").agg(
        F.count("*").alias("orders"), F.count_if(F.col("status") == "DELAYED").alias("late")
    )
    # Stock is counted per product before it is attributed to suppliers.
    per_product = inventory.groupBy("product_id").agg(
        F.count("*").alias("items"), F.count_if("is_low_stock").alias("low")
    )
    stock = (
        per_product.join(products.select("product_id", "supplier_id"), "product_id")
        .groupBy("supplier_id")
        .agg(F.sum("items").alias("items"), F.sum("low").alias("low"))
    )
    joined = suppliers.select("supplier_id", "rating").join(late, "supplier_id", "left").join(stock, "supplier_id", "left")
    scores = composite_risk(
        {
            "supplier": ((5 - F.col("rating")) * 50).cast("double"),
            "transportation": _share_pct(F.col("late"), F.col("orders")),
            "inventory": _share_pct(F.col("low"), F.col("items")),
        }
    )
    return joined.withColumns(scores).select("supplier_id", "composite_risk_score", "risk_level", "dimension_breakdown")


def lane_delay_level(shipments: DataFrame) -> DataFrame:
    """Share of delayed shipments per carrier and mode, as a level."""
    lanes = shipments.groupBy("carrier", "mode").agg(
        F.count("*").alias("n"), F.count_if("is_delayed").alias("late")
    )
    share = F.bround(_share_pct(F.col("late"), F.col("n")), 1)
    return lanes.select("carrier", "mode", share.alias("delay_probability_pct"), risk_level(share).alias("risk_level"))


