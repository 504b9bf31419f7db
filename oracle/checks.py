"""Kernels, data-quality rules and scores in DuckDB SQL."""

from oracle.tables import _COLUMNS as FEED_COLUMNS
from oracle.tables import query, stamp, whole

KERNELS = {
    "dedup_keep_first": """SELECT order_id, product_id, supplier_id, unit_price, ingested_at FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY ingested_at, product_id, supplier_id, unit_price) = 1""",
    "coerce_number": """SELECT event_id, temperature_c AS text, TRY_CAST(temperature_c AS DECIMAL(5,2)) AS value
        FROM raw_iot_sensors""",
    "coerce_int_default": f"SELECT order_id, quantity AS text, {whole('quantity', 1)} AS value FROM raw_orders",
    "parse_currency": """SELECT order_id, text, TRY_CAST(replace(replace(text, '$', ''), ',', '') AS DECIMAL(12,2)) AS value
        FROM (SELECT order_id, CASE WHEN currency = 'EUR' THEN 'EUR ' || unit_price ELSE unit_price END AS text FROM raw_orders)""",
    "coerce_timestamp": f"SELECT order_id, order_date AS text, {stamp('order_date')} AS value FROM raw_orders",
    "default_value": "SELECT product_id, coalesce(currency, 'USD') AS currency FROM raw_products",
    "normalize_text": """SELECT product_id, upper(trim(sku)) AS sku, trim(name) AS name, lower(trim(category)) AS category
        FROM raw_products""",
    "require_key": "SELECT order_id, customer_id, status FROM raw_orders WHERE customer_id IS NOT NULL",
    "surrogate_key": """SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id, total_amount_usd
        FROM silver_orders""",
    "surrogate_key_loads": """SELECT row_number() OVER (ORDER BY CASE WHEN year(order_date) < 1994 THEN 1 WHEN year(order_date) < 1997 THEN 2 ELSE 3 END,
        order_id) AS order_key, order_id FROM silver_orders""",
}
KERNELS["coerce_timestamp_formats"] = """
    SELECT order_id, text, coalesce(CASE WHEN k NOT IN (1, 2, 3) THEN TRY_CAST(text AS TIMESTAMP) END, try_strptime(text, '%d/%m/%Y %H:%M'),
                                    try_strptime(text, '%Y%m%d'), try_strptime(text, '%d.%m.%Y')) AS value
    FROM (SELECT order_id, k, CASE k WHEN 1 THEN substr(t, 9, 2) || '/' || substr(t, 6, 2) || '/' || substr(t, 1, 4) || ' ' || substr(t, 12, 5)
                                     WHEN 2 THEN substr(t, 1, 4) || substr(t, 6, 2) || substr(t, 9, 2)
                                     WHEN 3 THEN substr(t, 9, 2) || '.' || substr(t, 6, 2) || '.' || substr(t, 1, 4) ELSE t END AS text
          FROM (SELECT order_id, order_date AS t, CAST(substr(order_id, 5, 10) AS BIGINT) % 4 AS k FROM raw_orders))"""
# Loads merged one after another end as all of them at once.
KERNELS["dedup_merged"] = KERNELS["dedup_keep_first"]


def _rule(name, layer, entity, kind, violations, description="", source=None) -> tuple[str, str, str]:
    sql = f"""SELECT '{layer}' AS layer, '{name}' AS test_name, '{description}' AS description, '{entity}' AS entity,
        '{kind}' AS rule_type, count(*) AS checked_rows, CAST(coalesce({violations}, 0) AS BIGINT) AS violations,
        CASE WHEN coalesce({violations}, 0) = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM {source or entity}"""
    return name, kind, sql


def _null(*columns: str) -> str:
    return f"count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in columns)})"


def _few(least: int) -> str:
    return f"greatest({least} - count(*), 0)"


def _orphans(column: str, parent: str, ref: str, nulls: bool = True) -> str:
    kept = f"{column} IS NULL OR" if nulls else f"{column} IS NOT NULL AND"
    return f"count(*) FILTER ({kept} {column} NOT IN (SELECT {ref} FROM {parent} WHERE {ref} IS NOT NULL))"


STANDING = [
    _rule("bronze_suppliers_not_empty", "bronze", "raw_suppliers", "not_empty", _few(1), "Bronze suppliers raw table must contain rows"),
    _rule("bronze_orders_not_empty", "bronze", "raw_orders", "not_empty", _few(1), "Bronze orders raw table must contain rows"),
    _rule("silver_suppliers_no_null_id", "silver", "suppliers", "not_null", _null("supplier_id"), "Silver suppliers supplier_id must not be null", "silver_suppliers"),
    _rule("silver_products_unique_sku", "silver", "products", "unique", "count(sku) - count(DISTINCT sku)", "Silver product SKUs must be unique", "silver_products"),
    _rule("silver_orders_positive_quantity", "silver", "orders", "positive", "count(*) FILTER (quantity <= 0)", "Silver order quantity must be greater than zero", "silver_orders"),
    _rule("silver_orders_referential_customer", "silver", "orders", "foreign_key", _orphans("customer_id", "silver_customers", "customer_id"), "All Silver orders must link to a valid customer", "silver_orders"),
    _rule("silver_shipments_referential_order", "silver", "shipments", "foreign_key", _orphans("order_id", "silver_orders", "order_id"), "All Silver shipments must link to a valid order", "silver_shipments"),
    _rule("silver_inventory_non_negative", "silver", "inventory", "non_negative", "count(*) FILTER (quantity_on_hand < 0)", "Silver inventory quantity on hand must be non-negative", "silver_inventory"),
    _rule("gold_fact_orders_valid_keys", "gold", "fact_orders", "not_null", _null("customer_key", "product_key", "supplier_key"), "Gold fact_orders dimension keys must not be null"),
    _rule("gold_dim_date_populated", "gold", "dim_date", "min_count", _few(365), "Gold dim_date dimension must contain at least 1 year of dates"),
]

DECLARED = [
    _rule("BR-01", "bronze", "raw_suppliers", "not_null", _null("supplier_id", "name")),
    _rule("BR-02", "bronze", "raw_warehouses", "not_null", _null("warehouse_id", "code")),
    _rule("BR-03", "bronze", "raw_orders", "not_null", _null("order_id", "customer_id", "product_id")),
    _rule("BR-04", "bronze", "raw_iot_sensors", "range", "count(*) FILTER (TRY_CAST(temperature_c AS DOUBLE) NOT BETWEEN -50 AND 100)"),
    _rule("SR-01", "silver", "suppliers", "unique", "count(supplier_id) - count(DISTINCT supplier_id)", source="silver_suppliers"),
    _rule("SR-02", "silver", "products", "unique", "count(sku) - count(DISTINCT sku)", source="silver_products"),
    _rule("SR-03", "silver", "orders", "positive", "count(*) FILTER (quantity <= 0)", source="silver_orders"),
    _rule("SR-04", "silver", "orders", "foreign_key", _orphans("customer_id", "silver_customers", "customer_id"), source="silver_orders"),
    _rule("SR-05", "silver", "shipments", "foreign_key", _orphans("order_id", "silver_orders", "order_id"), source="silver_shipments"),
    _rule("SR-06", "silver", "inventory", "non_negative", "count(*) FILTER (quantity_on_hand < 0)", source="silver_inventory"),
    _rule("GR-01", "gold", "fact_orders", "not_null", _null("order_id", "customer_key", "product_key", "supplier_key", "order_date_key")),
    _rule("GR-02", "gold", "fact_shipments", "not_null", _null("shipment_id", "order_id", "origin_warehouse_key", "shipped_date_key")),
    _rule("GR-03", "gold", "dim_date", "min_count", _few(365)),
]

_CONTRACTS = """
suppliers supplier_id not_null | suppliers supplier_id unique | suppliers name not_null
products product_id not_null | products product_id unique | products sku not_null | products name not_null
products unit_cost_usd not_null | products sku unique | products supplier_id reference suppliers
warehouses warehouse_id not_null | warehouses warehouse_id unique | warehouses code not_null | warehouses name not_null
warehouses code unique
customers customer_id not_null | customers customer_id unique | customers company_name not_null
orders order_id not_null | orders order_id unique | orders quantity not_null | orders unit_price_usd not_null
orders total_amount_usd not_null | orders order_date not_null | orders status not_null | orders quantity positive
orders customer_id reference customers | orders product_id reference products | orders supplier_id reference suppliers
shipments shipment_id not_null | shipments shipment_id unique | shipments status not_null
shipments order_id reference orders | shipments origin_warehouse_id reference warehouses warehouse_id
inventory inventory_id not_null | inventory inventory_id unique | inventory quantity_on_hand not_null
inventory reorder_level not_null | inventory safety_stock not_null | inventory quantity_on_hand non_negative
inventory warehouse_id reference warehouses | inventory product_id reference products
iot_sensors event_id not_null | iot_sensors event_id unique | iot_sensors device_id not_null
iot_sensors recorded_at not_null | iot_sensors shipment_id reference shipments
"""


def _source(entity: str) -> str:
    return "silver_iot" if entity == "iot_sensors" else f"silver_{entity}"


def _contract(words: list[str]) -> tuple[str, str, str]:
    entity, column, kind, *rest = words
    if kind == "reference":
        violations = _orphans(column, _source(rest[0]), rest[1] if len(rest) > 1 else column, nulls=False)
    else:
        violations = {
            "not_null": _null(column),
            "unique": f"count({column}) - count(DISTINCT {column})",
            "positive": f"count(*) FILTER ({column} <= 0)",
            "non_negative": f"count(*) FILTER ({column} < 0)",
        }[kind]
    return _rule(f"{entity}_{column}_{kind}", "silver", entity, kind, violations, source=_source(entity))


CONTRACT = [_contract(part.split()) for part in _CONTRACTS.replace("\n", "|").split("|") if part.strip()]


_GOLD_CONTRACTS = """
dim_supplier supplier_key | supplier_id supplier_name | supplier_id |
dim_product product_key | product_id sku product_name | product_id |
dim_warehouse warehouse_key | warehouse_id warehouse_code warehouse_name | warehouse_id |
dim_customer customer_key | customer_id company_name | customer_id |
dim_region region_key | region_name | region_name |
dim_date date_key | full_date year quarter month month_name day_of_month day_of_week day_name is_weekend | full_date |
fact_orders order_id | quantity unit_price_usd total_amount_usd order_status | | customer_key:dim_customer product_key:dim_product supplier_key:dim_supplier order_date_key:dim_date:date_key
fact_shipments shipment_id | order_id | | origin_warehouse_key:dim_warehouse:warehouse_key shipped_date_key:dim_date:date_key delivery_date_key:dim_date:date_key
fact_inventory inventory_id | quantity_on_hand reorder_level safety_stock | | warehouse_key:dim_warehouse_dbt product_key:dim_product_dbt snapshot_date_key:dim_date:date_key
fact_deliveries shipment_id | order_id | | customer_key:dim_customer supplier_key:dim_supplier warehouse_key:dim_warehouse delivery_date_key:dim_date:date_key
"""


def _gold_contract(line: str) -> list[tuple[str, str, str]]:
    head, required, unique, references = (part.split() for part in line.split("|"))
    table, key = head
    rules = []

    def add(kind: str, column: str, violations: str) -> None:
        rules.append(_rule(f"{table}_{column}_{kind}", "gold", table, kind, violations, source=table))

    for column in [key, *required]:
        add("not_null", column, _null(column))
    for column in [key, *unique]:
        add("unique", column, f"count({column}) - count(DISTINCT {column})")
    for reference in references:
        column, parent, *other = reference.split(":")
        add("reference", column, _orphans(column, parent, other[0] if other else column, nulls=False))
    return rules


CONTRACT += [rule for line in _GOLD_CONTRACTS.strip().splitlines() for rule in _gold_contract(line)]


def _all(rules) -> str:
    return " UNION ALL ".join(sql for _, _, sql in rules)


def _kind(kind: str) -> str:
    return _all([r for r in STANDING + DECLARED if r[1] == kind])


_SUMMARY = f"""SELECT count(*) AS total_tests, count(*) FILTER (status = 'PASSED') AS passed,
    count(*) FILTER (status <> 'PASSED') AS failed,
    round_even(count(*) FILTER (status = 'PASSED') / count(*) * 100.0, 2) AS score_pct FROM ({_all(STANDING)})"""

QUALITY = {
    f"dq_{kind}": _kind(kind)
    for kind in ("not_empty", "not_null", "unique", "positive", "non_negative", "foreign_key", "range", "min_count")
} | {
    "dq_null_rate": " UNION ALL ".join(
        f"""SELECT 'raw_{feed}' AS entity, '{c}' AS column_name, count(*) AS checked_rows, count(*) - count({c}) AS null_rows,
        (count(*) - count({c})) / count(*) AS null_rate FROM raw_{feed}"""
        for feed, columns in FEED_COLUMNS.items()
        for c in columns.split()
    ),
    "dq_freshness": " UNION ALL ".join(
        f"""SELECT '{name}' AS entity, newest, (epoch_us(TIMESTAMP '2001-12-31 12:00:00') - epoch_us(newest)) / 3600000000.0 AS age_hours,
        CASE WHEN newest >= TIMESTAMP '2001-12-29 12:00:00' THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT max(ingested_at) AS newest FROM {name})"""
        for name in [f"raw_{feed}" for feed in FEED_COLUMNS]
    ),
    "dq_run_rules": _all(DECLARED),
    "dq_report": _all(STANDING),
    "dq_summary": _SUMMARY,
    "dq_contract": _all(CONTRACT),
    "ops_metrics": f"""SELECT 'data_quality_score_pct' AS metric, score_pct AS value FROM ({_SUMMARY})
        UNION ALL SELECT 'active_shipments_total', CAST(count(*) FILTER (status IN ('IN_TRANSIT', 'DELAYED')) AS DOUBLE) FROM silver_shipments
        UNION ALL SELECT 'iot_temp_breach_total', CAST(count(*) FILTER (is_temp_breach) AS DOUBLE) FROM silver_iot""",
}

_LEVEL = "CASE WHEN {0} > 80 THEN 'CRITICAL' WHEN {0} > 60 THEN 'HIGH' WHEN {0} > 30 THEN 'MEDIUM' ELSE 'LOW' END"

_DISTANCE = """(SELECT s.*, 111.0::DOUBLE * CAST(abs(a.latitude - b.latitude) + abs(a.longitude - b.longitude) AS DOUBLE) AS distance_km
    FROM silver_shipments s LEFT JOIN silver_warehouses a ON s.origin_warehouse_id = a.warehouse_id
    LEFT JOIN (SELECT country, min(latitude) AS latitude, min(longitude) AS longitude FROM silver_warehouses GROUP BY country) b
    ON s.destination_country = b.country)"""

_MONTHLY = """(SELECT product_id, CAST(date_trunc('month', order_date) AS DATE) AS month_start, CAST(sum(quantity) AS BIGINT) AS units,
    sum(total_amount_usd) AS revenue, CAST(any_value(day(last_day(order_date))) AS BIGINT) AS days
    FROM silver_orders WHERE order_date IS NOT NULL GROUP BY 1, 2)"""


def _ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0.0))"


SCORES = {
    "composite_risk": f"""
    SELECT supplier_id, composite_risk_score, {_LEVEL.format('composite_risk_score')} AS risk_level, supplier_risk,
           transportation_risk, 30.0::DOUBLE AS weather_risk, inventory_risk, 15.0::DOUBLE AS geopolitical_risk, 20.0::DOUBLE AS demand_risk
    FROM (SELECT *, round_even(supplier_risk * 0.2::DOUBLE + transportation_risk * 0.2::DOUBLE + 30.0::DOUBLE * 0.15::DOUBLE
                 + inventory_risk * 0.2::DOUBLE + 15.0::DOUBLE * 0.15::DOUBLE + 20.0::DOUBLE * 0.1::DOUBLE, 1) AS composite_risk_score
          FROM (SELECT supplier_id, CAST((5 - rating) * 50 AS DOUBLE) AS supplier_risk,
                       coalesce(late / orders * 100.0::DOUBLE, 40.0) AS transportation_risk,
                       coalesce(low / items * 100.0::DOUBLE, 20.0) AS inventory_risk
                FROM silver_suppliers
                LEFT JOIN (SELECT supplier_id, CAST(count(*) AS DOUBLE) AS orders, CAST(count(*) FILTER (status = 'DELAYED') AS DOUBLE) AS late
                           FROM silver_orders GROUP BY 1) USING (supplier_id)
                LEFT JOIN (SELECT supplier_id, CAST(count(*) AS DOUBLE) AS items, CAST(count(*) FILTER (is_low_stock) AS DOUBLE) AS low
                           FROM silver_inventory JOIN (SELECT product_id, supplier_id FROM silver_products) USING (product_id)
                           GROUP BY 1) USING (supplier_id)))""",
    "risk_level": f"""SELECT carrier, mode, p AS delay_probability_pct, {_LEVEL.format('p')} AS risk_level
    FROM (SELECT carrier, mode, round_even(CAST(count(*) FILTER (is_delayed) AS DOUBLE) / count(*) * 100.0::DOUBLE, 1) AS p
          FROM silver_shipments GROUP BY carrier, mode)""",
    "carbon_kg": f"""
    SELECT shipment_id, mode, distance_km, CAST(quantity * weight_kg AS DOUBLE) / 1000.0::DOUBLE * distance_km *
           CASE split_part(mode, ' ', 1) WHEN 'Air' THEN 0.5::DOUBLE WHEN 'Road' THEN 0.105::DOUBLE
                WHEN 'Sea' THEN 0.015::DOUBLE WHEN 'Rail' THEN 0.028::DOUBLE END AS carbon_kg
    FROM {_DISTANCE} LEFT JOIN (SELECT order_id, quantity, weight_kg FROM silver_orders
        JOIN (SELECT product_id, weight_kg FROM silver_products) USING (product_id)) USING (order_id)""",
    "demand_features": f"""
    SELECT product_id, month_start, historical_avg, CAST(month(month_start) AS INTEGER) AS month,
           CAST(coalesce(unit_price_usd < usual_price * 0.9::DOUBLE, FALSE) AS INTEGER) AS is_promotion, unit_price_usd,
           {_ratio('units', 'days')} * 7.0::DOUBLE AS demand_7_days
    FROM (SELECT *, {_ratio('sum(units) OVER w', 'month_start - min(month_start) OVER w')} AS historical_avg,
                 {_ratio('sum(revenue) OVER w', 'sum(units) OVER w')} AS usual_price, {_ratio('revenue', 'units')} AS unit_price_usd
          FROM {_MONTHLY}
          WINDOW w AS (PARTITION BY product_id ORDER BY month_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    "upcoming_demand": f"""
    SELECT product_id, {_ratio('sum(units)', f"(CAST((SELECT max(month_start) FROM {_MONTHLY}) + INTERVAL 1 MONTH AS DATE) - min(month_start))")} AS historical_avg,
           CAST(month((SELECT max(month_start) FROM {_MONTHLY}) + INTERVAL 1 MONTH) AS INTEGER) AS month, 0 AS is_promotion,
           {_ratio('sum(revenue)', 'sum(units)')} AS unit_price_usd
    FROM {_MONTHLY} GROUP BY product_id""",
    "delay_features": f"""
    SELECT shipment_id, coalesce(distance_km, 3500.0) AS distance_km,
           CASE split_part(mode, ' ', 1) WHEN 'Air' THEN 0 WHEN 'Road' THEN 1 WHEN 'Sea' THEN 2 WHEN 'Rail' THEN 3 ELSE 2 END AS mode_code,
           coalesce(humidity, 0.4) AS weather_severity, coalesce(congestion, 0.0) AS port_congestion, mode,
           actual_delivery_at IS NOT NULL AS is_delivered, CAST(is_delayed AS INTEGER) AS is_delayed
    FROM {_DISTANCE}
    LEFT JOIN (SELECT shipment_id, {_ratio('sum(humidity_pct)', 'count(humidity_pct) * 100')} AS humidity FROM silver_iot GROUP BY 1) USING (shipment_id)
    LEFT JOIN (SELECT origin_warehouse_id, {_ratio('count(*) FILTER (actual_delivery_at IS NULL)', 'count(*)')} AS congestion
               FROM silver_shipments GROUP BY 1) USING (origin_warehouse_id)""",
}

# What a forecast or prediction must hold whatever the fitted trees are.
SCORES["demand_forecast_sound"] = f"""
    SELECT product_id, CASE WHEN known THEN 'SUCCESS' ELSE 'FALLBACK' END AS status,
           CASE WHEN known THEN 'v1.2.0-RF' ELSE 'fallback-baseline' END AS model_version,
           CASE WHEN NOT known THEN CAST(trunc(coalesce(historical_avg, 0.0) * 7) AS INTEGER) END AS average_demand, TRUE AS sound
    FROM (SELECT *, historical_avg IS NOT NULL AND unit_price_usd IS NOT NULL AS known FROM ({SCORES['upcoming_demand']}))"""
SCORES["delay_prediction_sound"] = f"""
    SELECT shipment_id, mode AS transport_mode, weather_severity, port_congestion, TRUE AS sound FROM ({SCORES['delay_features']})"""

# The gate runs on the castable feeds and stops below 70 percent.
GATE = query(f"SELECT * FROM ({_SUMMARY}) WHERE score_pct >= 70", strict=True)

SQL = {"dq_gate": GATE} | {name: query(body) for group in (KERNELS, QUALITY, SCORES) for name, body in group.items()}
