"""Table layouts: raw feeds, stream payloads, and the constraints per table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The raw feeds.  Everything but the load metadata is text.
_METADATA = [
    T.StructField("raw_payload", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
]

RAW_COLUMNS = {
    "raw_suppliers": ["supplier_id", "name", "contact_email", "country", "region", "tier", "rating"],
    "raw_products": ["product_id", "sku", "name", "category", "unit_cost", "currency", "weight_kg", "supplier_id"],
    "raw_warehouses": ["warehouse_id", "code", "name", "city", "country", "latitude", "longitude", "capacity_sqft", "temp_zone_type"],
    "raw_customers": ["customer_id", "company_name", "industry", "country", "region", "tier"],
    "raw_orders": ["order_id", "customer_id", "product_id", "supplier_id", "quantity", "unit_price", "currency", "order_date", "required_date", "status"],
    "raw_shipments": ["shipment_id", "order_id", "origin_warehouse_id", "destination_city", "destination_country", "carrier", "mode", "status", "shipped_at", "estimated_delivery_at", "actual_delivery_at"],
    "raw_inventory": ["inventory_id", "warehouse_id", "product_id", "quantity_on_hand", "reorder_level", "safety_stock", "last_counted_at"],
    "raw_iot_sensors": ["event_id", "shipment_id", "device_id", "latitude", "longitude", "temperature_c", "humidity_pct", "battery_level", "recorded_at"],
}

RAW = {name: T.StructType(strings(*cols) + _METADATA) for name, cols in RAW_COLUMNS.items()}

# Stream payloads.
IOT_EVENT = T.StructType(
    strings("event_id", "shipment_id", "device_id")
    + [T.StructField(n, T.DoubleType()) for n in ("latitude", "longitude", "temperature_c", "humidity_pct")]
    + [T.StructField("battery_level", T.IntegerType())]
    + strings("recorded_at")
)

SHIPMENT_EVENT = T.StructType(
    strings("event_id", "shipment_id", "status")
    + [T.StructField("delay_hours", T.IntegerType())]
    + strings("location", "updated_at")
)

TRACKING_EVENT = T.StructType(
    strings("event_id", "shipment_id", "timestamp")
    + [T.StructField(n, T.DoubleType()) for n in ("latitude", "longitude", "temperature")]
    + [T.StructField("speed", T.IntegerType())]
    + strings("status")
)

WEATHER_EVENT = T.StructType(
    strings("timestamp", "location")
    + [T.StructField(n, T.DoubleType()) for n in ("temperature", "wind_speed", "storm_probability")]
    + strings("condition")
)


@dataclass(frozen=True)
class Contract:
    """Declared constraints of one table."""

    primary_key: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


# Constraints declared on the cleansed tables.
SILVER_CONTRACTS = {
    "suppliers": Contract("supplier_id", not_null=("name",)),
    "products": Contract("product_id", not_null=("sku", "name", "unit_cost_usd"), unique=("sku",), references={"supplier_id": ("suppliers", "supplier_id")}),
    "warehouses": Contract("warehouse_id", not_null=("code", "name"), unique=("code",)),
    "customers": Contract("customer_id", not_null=("company_name",)),
    "orders": Contract(
        "order_id",
        not_null=("quantity", "unit_price_usd", "total_amount_usd", "order_date", "status"),
        positive=("quantity",),
        references={"customer_id": ("customers", "customer_id"), "product_id": ("products", "product_id"), "supplier_id": ("suppliers", "supplier_id")},
    ),
    "shipments": Contract(
        "shipment_id",
        not_null=("status",),
        references={"order_id": ("orders", "order_id"), "origin_warehouse_id": ("warehouses", "warehouse_id")},
    ),
    "inventory": Contract(
        "inventory_id",
        not_null=("quantity_on_hand", "reorder_level", "safety_stock"),
        non_negative=("quantity_on_hand",),
        references={"warehouse_id": ("warehouses", "warehouse_id"), "product_id": ("products", "product_id")},
    ),
    "iot_sensors": Contract(
        "event_id", not_null=("device_id", "recorded_at"), references={"shipment_id": ("shipments", "shipment_id")}
    ),
}

# Constraints declared on the star schema.  Facts are told apart by
# their business id, as their serial numbers are not kept.
_DATE = ("dim_date", "date_key")
GOLD_CONTRACTS = {
    "dim_supplier": Contract("supplier_key", not_null=("supplier_id", "supplier_name"), unique=("supplier_id",)),
    "dim_product": Contract("product_key", not_null=("product_id", "sku", "product_name"), unique=("product_id",)),
    "dim_warehouse": Contract("warehouse_key", not_null=("warehouse_id", "warehouse_code", "warehouse_name"), unique=("warehouse_id",)),
    "dim_customer": Contract("customer_key", not_null=("customer_id", "company_name"), unique=("customer_id",)),
    "dim_region": Contract("region_key", not_null=("region_name",), unique=("region_name",)),
    "dim_date": Contract(
        "date_key",
        not_null=("full_date", "year", "quarter", "month", "month_name", "day_of_month", "day_of_week", "day_name", "is_weekend"),
        unique=("full_date",),
    ),
    "fact_orders": Contract(
        "order_id",
        not_null=("quantity", "unit_price_usd", "total_amount_usd", "order_status"),
        references={
            "customer_key": ("dim_customer", "customer_key"),
            "product_key": ("dim_product", "product_key"),
            "supplier_key": ("dim_supplier", "supplier_key"),
            "order_date_key": _DATE,
        },
    ),
    "fact_shipments": Contract(
        "shipment_id",
        not_null=("order_id",),
        references={
            "origin_warehouse_key": ("dim_warehouse", "warehouse_key"),
            "shipped_date_key": _DATE,
            "delivery_date_key": _DATE,
        },
    ),
    "fact_inventory": Contract(
        "inventory_id",
        not_null=("quantity_on_hand", "reorder_level", "safety_stock"),
        references={
            "warehouse_key": ("dim_warehouse_dbt", "warehouse_key"),
            "product_key": ("dim_product_dbt", "product_key"),
            "snapshot_date_key": _DATE,
        },
    ),
    "fact_deliveries": Contract(
        "shipment_id",
        not_null=("order_id",),
        references={
            "customer_key": ("dim_customer", "customer_key"),
            "supplier_key": ("dim_supplier", "supplier_key"),
            "warehouse_key": ("dim_warehouse", "warehouse_key"),
            "delivery_date_key": _DATE,
        },
    ),
}
