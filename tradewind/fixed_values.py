"""Values the data contract fixes: results are only right with exactly these."""

# Defaults the cleansing step fills in.
DEFAULT_RATING = "4.0"
DEFAULT_CAPACITY_SQFT = 100000
DEFAULT_WEIGHT_KG = "1.0"
DEFAULT_ORDER_QUANTITY = 1
DEFAULT_CURRENCY = "USD"
DEFAULT_QUANTITY_ON_HAND = 0
DEFAULT_REORDER_LEVEL = 100
DEFAULT_SAFETY_STOCK = 50
DEFAULT_BATTERY_LEVEL = 100
DEFAULT_KPI_RATING = "4.5"

# Cold-chain limit and calendar.
COLD_CHAIN_LIMIT_C = 8.0
CALENDAR_START = "2026-01-01"
CALENDAR_DAYS = 365
MISSING_DATE_KEY = 20260101

# Domains.
TRANSIT_MODES = ["Air Freight", "Sea Freight", "Road Truckload", "Rail Express"]
ACTIVE_STATUSES = ["IN_TRANSIT", "DELAYED"]

# Origin system recorded on each raw table.
SOURCE_SYSTEMS = {
    "raw_suppliers": "ERP_SUPPLIER_API",
    "raw_products": "ERP_CATALOG",
    "raw_warehouses": "WMS_FACILITY_DB",
    "raw_customers": "CRM_SYSTEM",
    "raw_orders": "ERP_ORDERS",
    "raw_shipments": "TMS_TRACKING_API",
    "raw_inventory": "WMS_INVENTORY",
    "raw_iot_sensors": "IOT_SENSOR_KAFKA",
}

# Topics.
TOPIC_IOT = "supply-chain-iot-telemetry"
TOPIC_SHIPMENTS = "supply-chain-shipment-events"

# Vendor categories by rating, highest first.
VENDOR_BANDS = [("4.5", "Tier 1 Preferred"), ("3.8", "Standard Vendor")]
VENDOR_OTHERWISE = "Under Watch / Risk"

# Stock statuses, most severe first.
STOCK_CRITICAL = "CRITICAL STOCKOUT"
STOCK_HIGH = "HIGH RISK"
STOCK_REORDER = "REORDER REQUIRED"
STOCK_HEALTHY = "HEALTHY"
CRITICAL_SAFETY_SHARE = 0.5

# Composite risk weights, defaults and bands.
RISK_WEIGHTS = {
    "supplier": 0.20,
    "transportation": 0.20,
    "weather": 0.15,
    "inventory": 0.20,
    "geopolitical": 0.15,
    "demand": 0.10,
}
RISK_DEFAULTS = {
    "supplier": 25.0,
    "transportation": 40.0,
    "weather": 30.0,
    "inventory": 20.0,
    "geopolitical": 15.0,
    "demand": 20.0,
}
RISK_BANDS = [(80.0, "CRITICAL"), (60.0, "HIGH"), (30.0, "MEDIUM")]
RISK_OTHERWISE = "LOW"

# Kg CO2 per tonne-kilometre.
EMISSION_FACTORS = {"Air": 0.50, "Road": 0.105, "Sea": 0.015, "Rail": 0.028}

# Transit mode codes of the delay model, and the code for others.
MODE_CODES = {"Air": 0, "Road": 1, "Sea": 2, "Rail": 3}
UNKNOWN_MODE_CODE = 2

# Size, seed and fallback of the two models.
FOREST_TREES = 50
BOOSTING_STAGES = 40
MODEL_SEED = 42
FORECAST_HORIZON_DAYS = 7
FALLBACK_CONFIDENCE_PCT = 85.0
FOREST_VERSION = "v1.2.0-RF"
FALLBACK_VERSION = "fallback-baseline"

# Share of passed checks below which a run is rejected.
QUALITY_GATE_PCT = 70.0
