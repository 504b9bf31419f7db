"""Cleansed, staged and star-schema tables in DuckDB SQL."""

import re

from oracle.bronze import CTES as RAW

CTES: dict[str, str] = dict(RAW)

_COLUMNS = {
    "suppliers": "supplier_id name contact_email country region tier rating",
    "products": "product_id sku name category unit_cost currency weight_kg supplier_id",
    "warehouses": "warehouse_id code name city country latitude longitude capacity_sqft temp_zone_type",
    "customers": "customer_id company_name industry country region tier",
    "orders": "order_id customer_id product_id supplier_id quantity unit_price currency order_date required_date status",
    "shipments": "shipment_id order_id origin_warehouse_id destination_city destination_country carrier mode status "
    "shipped_at estimated_delivery_at actual_delivery_at",
    "inventory": "inventory_id warehouse_id product_id quantity_on_hand reorder_level safety_stock last_counted_at",
    "iot_sensors": "event_id shipment_id device_id latitude longitude temperature_c humidity_pct battery_level recorded_at",
}

for _name, _text in _COLUMNS.items():
    _cols = _text.split()
    _order = ", ".join(f"{c} NULLS FIRST" for c in ["ingested_at", *_cols[1:]])
    CTES[f"first_{_name}"] = f"""
    SELECT {', '.join(_cols)} FROM raw_{_name}
    QUALIFY row_number() OVER (PARTITION BY {_cols[0]} ORDER BY {_order}) = 1"""


def number(col: str, dtype: str, default: str | None = None) -> str:
    cast = f"TRY_CAST({col} AS {dtype})"
    return cast if default is None else f"coalesce({cast}, CAST({default} AS {dtype}))"


def whole(col: str, default: int) -> str:
    return f"coalesce(TRY_CAST(trunc(TRY_CAST({col} AS DECIMAL(28,8))) AS BIGINT), {default})"


def money(col: str) -> str:
    return f"CAST(replace(replace({col}, '$', ''), ',', '') AS DECIMAL(12,2))"


def stamp(col: str) -> str:
    return f"TRY_CAST({col} AS TIMESTAMP)"


LATE_SECONDS = "(epoch_us(actual_delivery_at) - epoch_us(estimated_delivery_at))"

CTES |= {
    "silver_suppliers": f"""SELECT * REPLACE ({number('rating', 'DECIMAL(22,2)', '4.0')} AS rating), TRUE AS is_active
        FROM first_suppliers""",
    "silver_warehouses": f"""SELECT * REPLACE ({number('latitude', 'DECIMAL(9,6)')} AS latitude,
        {number('longitude', 'DECIMAL(9,6)')} AS longitude, {whole('capacity_sqft', 100000)} AS capacity_sqft)
        FROM first_warehouses""",
    "silver_products": f"""SELECT product_id, sku, name, category, {money('unit_cost')} AS unit_cost_usd,
        {number('weight_kg', 'DECIMAL(22,2)', '1.0')} AS weight_kg, supplier_id FROM first_products""",
    "silver_customers": "SELECT * FROM first_customers",
    "silver_orders": f"""SELECT order_id, customer_id, product_id, supplier_id, {whole('quantity', 1)} AS quantity,
        {money('unit_price')} AS unit_price_usd,
        CAST({whole('quantity', 1)} * {money('unit_price')} AS DECIMAL(33,2)) AS total_amount_usd,
        coalesce(currency, 'USD') AS original_currency, {stamp('order_date')} AS order_date,
        {stamp('required_date')} AS required_date, status FROM first_orders""",
    "typed_shipments": f"""SELECT * REPLACE ({stamp('shipped_at')} AS shipped_at,
        {stamp('estimated_delivery_at')} AS estimated_delivery_at, {stamp('actual_delivery_at')} AS actual_delivery_at)
        FROM first_shipments""",
    "silver_shipments": f"""SELECT *, CASE WHEN actual_delivery_at > estimated_delivery_at
            THEN CAST({LATE_SECONDS} // 3600000000 AS INTEGER) ELSE 0 END AS delay_hours, delay_hours > 0 AS is_delayed
        FROM typed_shipments""",
    "silver_inventory": f"""SELECT inventory_id, warehouse_id, product_id, {whole('quantity_on_hand', 0)} AS quantity_on_hand,
        {whole('reorder_level', 100)} AS reorder_level, {whole('safety_stock', 50)} AS safety_stock,
        {whole('quantity_on_hand', 0)} <= {whole('reorder_level', 100)} AS is_low_stock,
        {stamp('last_counted_at')} AS last_counted_at FROM first_inventory""",
    "silver_iot": f"""SELECT event_id, shipment_id, device_id, {number('latitude', 'DECIMAL(9,6)')} AS latitude,
        {number('longitude', 'DECIMAL(9,6)')} AS longitude, {number('temperature_c', 'DECIMAL(22,2)')} AS temperature_c,
        {number('humidity_pct', 'DECIMAL(22,2)')} AS humidity_pct, {whole('battery_level', 100)} AS battery_level,
        {stamp('recorded_at')} AS recorded_at,
        coalesce(TRY_CAST(temperature_c AS DOUBLE) > 8.0, FALSE) AS is_temp_breach FROM first_iot_sensors""",
}

CTES |= {
    "stg_suppliers": """SELECT supplier_id, trim(name) AS supplier_name, lower(contact_email) AS contact_email, country,
        region, tier, CAST(rating AS DECIMAL(3,2)) AS rating, ingested_at FROM strict_suppliers WHERE supplier_id IS NOT NULL""",
    "stg_products": f"""SELECT product_id, upper(trim(sku)) AS sku, trim(name) AS product_name, category,
        {money('unit_cost')} AS unit_cost_usd, CAST(weight_kg AS DECIMAL(10,2)) AS weight_kg, supplier_id, ingested_at
        FROM strict_products WHERE product_id IS NOT NULL""",
    "stg_warehouses": """SELECT warehouse_id, upper(trim(code)) AS warehouse_code, trim(name) AS warehouse_name, city, country,
        CAST(latitude AS DECIMAL(9,6)) AS latitude, CAST(longitude AS DECIMAL(9,6)) AS longitude,
        CAST(capacity_sqft AS INTEGER) AS capacity_sqft, temp_zone_type, ingested_at
        FROM strict_warehouses WHERE warehouse_id IS NOT NULL""",
    "stg_customers": """SELECT customer_id, trim(company_name) AS company_name, industry, country, region, tier, ingested_at
        FROM strict_customers WHERE customer_id IS NOT NULL""",
    "stg_orders": f"""SELECT order_id, customer_id, product_id, supplier_id, CAST(quantity AS INTEGER) AS quantity,
        {money('unit_price')} AS unit_price_usd,
        CAST(CAST(quantity AS INTEGER) * {money('unit_price')} AS DECIMAL(14,2)) AS total_amount_usd,
        CAST(order_date AS TIMESTAMP) AS order_date, CAST(required_date AS TIMESTAMP) AS required_date,
        status AS order_status FROM strict_orders WHERE order_id IS NOT NULL""",
    "stg_shipments": """SELECT shipment_id, order_id, origin_warehouse_id, destination_city, destination_country, carrier,
        mode AS transit_mode, status AS shipment_status, CAST(shipped_at AS TIMESTAMP) AS shipped_at,
        CAST(estimated_delivery_at AS TIMESTAMP) AS estimated_delivery_at,
        CAST(actual_delivery_at AS TIMESTAMP) AS actual_delivery_at, ingested_at
        FROM strict_shipments WHERE shipment_id IS NOT NULL""",
    "stg_inventory": """SELECT inventory_id, warehouse_id, product_id, CAST(quantity_on_hand AS INTEGER) AS quantity_on_hand,
        CAST(reorder_level AS INTEGER) AS reorder_level, CAST(safety_stock AS INTEGER) AS safety_stock,
        coalesce(CAST(quantity_on_hand AS INTEGER) <= CAST(safety_stock AS INTEGER), FALSE) AS is_low_stock,
        CAST(last_counted_at AS TIMESTAMP) AS last_counted_at, ingested_at
        FROM strict_inventory WHERE inventory_id IS NOT NULL""",
}


def keyed(table: str, natural: str, key: str, select: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {natural}) AS {key}, {select} FROM {table}"


def day_key(col: str, missing: str = "20260101") -> str:
    return f"coalesce(CAST(strftime({col}, '%Y%m%d') AS INTEGER), {missing})"


CTES |= {
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
            CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
            monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day_of_month,
            CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
        FROM (SELECT unnest(generate_series(date_trunc('day', min(moment)), date_trunc('day', max(moment)), INTERVAL 1 DAY)) AS d
              FROM (SELECT order_date AS moment FROM silver_orders UNION ALL SELECT shipped_at FROM silver_shipments
                    UNION ALL SELECT actual_delivery_at FROM silver_shipments
                    UNION ALL SELECT last_counted_at FROM stg_inventory)
              UNION SELECT TIMESTAMP '2026-01-01')""",
    "dim_supplier": keyed("silver_suppliers", "supplier_id", "supplier_key", "* RENAME (name AS supplier_name)"),
    "dim_product": keyed("silver_products", "product_id", "product_key", "* RENAME (name AS product_name)"),
    "dim_warehouse": keyed("silver_warehouses", "warehouse_id", "warehouse_key", "* RENAME (code AS warehouse_code, name AS warehouse_name)"),
    "dim_customer": keyed("silver_customers", "customer_id", "customer_key", "*"),
    "dim_region": """SELECT row_number() OVER (ORDER BY region) AS region_key, region AS region_name,
            CAST(NULL AS VARCHAR) AS subregion, CAST(NULL AS VARCHAR) AS continent, CAST(NULL AS VARCHAR) AS primary_hub
        FROM (SELECT region FROM silver_customers UNION SELECT region FROM silver_suppliers) WHERE region IS NOT NULL""",
    "dim_product_dbt": keyed("stg_products", "product_id", "product_key", "* EXCLUDE (ingested_at)"),
    "dim_warehouse_dbt": keyed("stg_warehouses", "warehouse_id", "warehouse_key", "* EXCLUDE (ingested_at)"),
    "dim_supplier_dbt": keyed("stg_suppliers", "supplier_id", "supplier_key", "* EXCLUDE (ingested_at), TRUE AS is_active"),
    "fact_orders": f"""SELECT order_id, customer_key, product_key, supplier_key, {day_key('order_date')} AS order_date_key,
            quantity, unit_price_usd, total_amount_usd, status AS order_status
        FROM silver_orders LEFT JOIN (SELECT supplier_id, supplier_key FROM dim_supplier) USING (supplier_id)
        LEFT JOIN (SELECT product_id, product_key FROM dim_product) USING (product_id)
        LEFT JOIN (SELECT customer_id, customer_key FROM dim_customer) USING (customer_id)""",
    "fact_orders_dbt": """SELECT order_id, customer_id, product_id, s.supplier_id, quantity, unit_price_usd,
            total_amount_usd, order_date, order_status
        FROM stg_orders o LEFT JOIN (SELECT supplier_id FROM stg_suppliers) s ON o.supplier_id = s.supplier_id""",
    "temp_breach_counts": """SELECT shipment_id, count(*) AS temp_breach_count FROM silver_iot
        WHERE is_temp_breach GROUP BY shipment_id""",
    "fact_shipments": f"""SELECT shipment_id, order_id, warehouse_key AS origin_warehouse_key,
            {day_key('shipped_at')} AS shipped_date_key, {day_key('actual_delivery_at')} AS delivery_date_key, carrier,
            mode AS transit_mode, status AS shipment_status, delay_hours, is_delayed,
            CAST(coalesce(temp_breach_count, 0) AS INTEGER) AS temp_breach_count
        FROM silver_shipments LEFT JOIN temp_breach_counts USING (shipment_id)
        LEFT JOIN dim_warehouse ON origin_warehouse_id = warehouse_id""",
    "fact_shipments_dbt": f"""SELECT shipment_id, order_id, warehouse_key AS origin_warehouse_key, carrier, transit_mode,
            shipment_status, shipped_at, estimated_delivery_at, actual_delivery_at,
            CASE WHEN actual_delivery_at > estimated_delivery_at THEN {LATE_SECONDS} / 3600000000.0 ELSE 0.0 END AS delay_hours,
            coalesce(actual_delivery_at > estimated_delivery_at, FALSE) AS is_delayed
        FROM stg_shipments LEFT JOIN dim_warehouse_dbt ON origin_warehouse_id = warehouse_id""",
    "fact_inventory": f"""SELECT inventory_id, warehouse_key, product_key, {day_key('last_counted_at', 'NULL')} AS snapshot_date_key,
            quantity_on_hand, reorder_level, safety_stock, is_low_stock,
            CAST(quantity_on_hand * unit_cost_usd AS DECIMAL(33,2)) AS inventory_value_usd, last_counted_at
        FROM stg_inventory LEFT JOIN dim_warehouse_dbt USING (warehouse_id)
        LEFT JOIN (SELECT product_id, product_key, unit_cost_usd FROM dim_product_dbt) USING (product_id)""",
    "fact_deliveries": f"""SELECT s.shipment_id, s.order_id, customer_key, supplier_key, warehouse_key,
            {day_key('actual_delivery_at', 'NULL')} AS delivery_date_key,
            CAST(date_diff('day', shipped_at, estimated_delivery_at) AS INTEGER) AS promised_days,
            CAST(date_diff('day', shipped_at, actual_delivery_at) AS INTEGER) AS actual_days,
            actual_delivery_at <= estimated_delivery_at AS on_time_delivery_flag,
            CAST(NULL AS DECIMAL(3,2)) AS customer_satisfaction_score
        FROM silver_shipments s LEFT JOIN silver_orders o ON s.order_id = o.order_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
        LEFT JOIN dim_supplier p ON o.supplier_id = p.supplier_id
        LEFT JOIN dim_warehouse w ON s.origin_warehouse_id = w.warehouse_id
        WHERE actual_delivery_at IS NOT NULL""",
}


def query(body: str, strict: bool = False) -> str:
    """``body`` with every table of this module it mentions, directly or not, defined.

    With ``strict`` the cleansed tables are built from the castable feeds.
    """

    def over_feeds(text: str) -> str:
        return re.sub(r"\braw_(?=[a-z])(?!payload)", "strict_", text) if strict else text

    needed: dict[str, str] = {}

    def need(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                definition = over_feeds(CTES[name])
                need(definition)
                needed.setdefault(name, definition)

    body = over_feeds(body)
    need(body)
    defined = ",\n".join(f"{name} AS ({definition})" for name, definition in needed.items())
    return f"WITH {defined}\n{body}" if needed else body
