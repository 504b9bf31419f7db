"""Raw feeds in DuckDB SQL: the checking side's own derivation from the driver tables."""


def _defect(strict: bool, value: str, *cases: tuple[str, str]) -> str:
    if strict:
        return value
    whens = " ".join(f"WHEN {cond} THEN {text}" for cond, text in cases)
    return f"CASE {whens} ELSE {value} END"


def _dollars(cents: str) -> str:
    return f"'$' || format('{{:,}}', ({cents}) // 100) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0')"


def _hundredths(n: str) -> str:
    return f"CAST(({n}) // 100 AS VARCHAR) || '.' || lpad(CAST(({n}) % 100 AS VARCHAR), 2, '0')"


def _id(prefix: str, key: str, width: int = 10) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), {width}, '0')"


_ISO = "'%Y-%m-%dT%H:%M:%S'"
_LOAD = "TIMESTAMP '2001-12-31 00:00:00'"
_LINE_STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderstatus = 'O' THEN 'IN_TRANSIT' "
    "WHEN l_linenumber = 3 THEN 'CUSTOMS_HOLD' ELSE 'DELAYED' END"
)
_LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_LINE_ID = "lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-' || CAST(l_linenumber AS VARCHAR)"


def suppliers(strict: bool) -> str:
    rating = _hundredths("300 + ((CAST(round(s_acctbal * 100) AS BIGINT) + 100000) * 200) // 1100000")
    return f"""
    SELECT {_id('SUP-', 's_suppkey')} AS supplier_id, '  ' || s_name || ' ' AS name,
           upper(replace(s_name, '#', '.')) || '@SUPPLIERS.EXAMPLE' AS contact_email,
           n_name AS country, r_name AS region,
           CASE WHEN s_acctbal >= 5000 THEN 'Tier 1' ELSE 'Tier 2' END AS tier,
           {_defect(strict, rating, ("s_suppkey % 13 = 5", "'n/a'"), ("s_suppkey % 17 = 3", "NULL"))} AS rating,
           'ERP_SUPPLIER_API' AS source_system, {_LOAD} AS ingested_at
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


def products(strict: bool) -> str:
    weight = _defect(strict, "CAST(p_size AS VARCHAR) || '.5'", ("p_partkey % 19 = 0", "NULL"), ("p_partkey % 23 = 0", "'heavy'"))
    return f"""
    SELECT {_id('PRD-', 'p_partkey')} AS product_id,
           '  ' || lower(p_brand) || '-' || CAST(p_partkey AS VARCHAR) || ' ' AS sku,
           '  ' || p_name || ' ' AS name, p_type AS category,
           {_dollars('CAST(round(p_retailprice * 100) AS BIGINT)')} AS unit_cost,
           CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
           {weight} AS weight_kg,
           {_id('SUP-', 'p_partkey % (SELECT count(*) FROM supplier)')} AS supplier_id,
           'ERP_CATALOG' AS source_system, {_LOAD} AS ingested_at
    FROM part"""


def warehouses(strict: bool) -> str:
    lat = _defect(strict, "CAST((n_nationkey * 7) % 120 - 60 AS VARCHAR) || '.250000'", ("n_nationkey % 11 = 7", "'N/A'"))
    cap = _defect(strict, "CAST(n_nationkey * 5000 + 100000 AS VARCHAR)", ("n_nationkey % 9 = 4", "'unknown'"))
    return f"""
    SELECT {_id('WH-', 'n_nationkey', 3)} AS warehouse_id,
           '  hub-' || CAST(n_nationkey AS VARCHAR) || ' ' AS code,
           '  ' || n_name || ' Distribution Hub ' AS name, n_name || ' City' AS city, n_name AS country,
           {lat} AS latitude, CAST((n_nationkey * 13) % 300 - 150 AS VARCHAR) || '.500000' AS longitude,
           {cap} AS capacity_sqft,
           CASE n_nationkey % 3 WHEN 0 THEN 'Cold Storage' WHEN 1 THEN 'Ambient' ELSE 'Frozen' END AS temp_zone_type,
           'WMS_FACILITY_DB' AS source_system, {_LOAD} AS ingested_at
    FROM nation"""


def customers(strict: bool) -> str:
    return f"""
    SELECT {_id('CUS-', 'c_custkey')} AS customer_id, '  ' || c_name || ' ' AS company_name,
           c_mktsegment AS industry, n_name AS country, r_name AS region,
           CASE WHEN c_acctbal >= 5000 THEN 'Enterprise' ELSE 'Mid-Market' END AS tier,
           'CRM_SYSTEM' AS source_system, {_LOAD} AS ingested_at
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


def orders(strict: bool) -> str:
    units = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"
    qty = _defect(strict, units, ("l_orderkey % 29 = 0", "'n/a'"), ("l_orderkey % 31 = 7", "'0'"), ("l_orderkey % 37 = 3", "NULL"))
    if not strict:
        qty = f"CASE WHEN l_orderkey % 41 = 5 THEN ({qty}) || '.7' ELSE ({qty}) END"
    cust = _defect(strict, _id("CUS-", "o_custkey"), ("l_orderkey % 97 = 0", "NULL"), ("o_custkey % 50 = 7", "'CUS-UNKNOWN'"))
    date = _defect(strict, f"strftime(o_orderdate, {_ISO})", ("l_orderkey % 43 = 9", "'unknown'"))
    return f"""
    SELECT 'ORD-' || {_LINE_ID} AS order_id, {cust} AS customer_id,
           {_id('PRD-', 'l_partkey')} AS product_id, {_id('SUP-', 'l_suppkey')} AS supplier_id,
           {qty} AS quantity,
           {_dollars('CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)')} AS unit_price,
           CASE WHEN l_orderkey % 6 = 5 THEN NULL WHEN l_orderkey % 5 = 1 THEN 'EUR' ELSE 'USD' END AS currency,
           {date} AS order_date,
           strftime(o_orderdate + INTERVAL 30 DAY, {_ISO}) AS required_date,
           CASE WHEN o_orderstatus = 'P' AND l_linenumber = 7 THEN 'CANCELLED' ELSE {_LINE_STATUS} END AS status,
           'ERP_ORDERS' AS source_system, l_shipdate AS ingested_at
    FROM {_LINES}"""


def shipments(strict: bool) -> str:
    est = "(l_shipdate + to_days(3 + CAST(l_quantity AS INTEGER) % 8))"
    disc = "CAST(round(l_discount * 100) AS INTEGER)"
    late = f"(({disc} - 4) * 720 + CASE WHEN {disc} = 4 THEN 40 ELSE 0 END)"
    order = _defect(strict, f"'ORD-' || {_LINE_ID}", ("l_orderkey % 89 = 2", "'ORD-UNKNOWN'"))
    shipped = _defect(strict, f"strftime(l_shipdate, {_ISO})", ("l_orderkey % 47 = 11", "'not recorded'"))
    return f"""
    SELECT 'SHP-' || {_LINE_ID} AS shipment_id, {order} AS order_id,
           {_id('WH-', 'l_suppkey % 25', 3)} AS origin_warehouse_id,
           'Port ' || CAST(o_custkey % 25 AS VARCHAR) AS destination_city,
           'NATION_' || CAST(o_custkey % 25 AS VARCHAR) AS destination_country,
           'CARRIER-' || CAST(l_orderkey % 7 AS VARCHAR) AS carrier,
           CASE l_linenumber % 4 WHEN 0 THEN 'Air Freight' WHEN 1 THEN 'Sea Freight'
                WHEN 2 THEN 'Road Truckload' ELSE 'Rail Express' END AS mode,
           {_LINE_STATUS} AS status, {shipped} AS shipped_at,
           strftime({est}, {_ISO}) AS estimated_delivery_at,
           CASE WHEN o_orderstatus = 'F' THEN strftime({est} + to_minutes({late}), {_ISO}) END AS actual_delivery_at,
           'TMS_TRACKING_API' AS source_system, l_shipdate AS ingested_at
    FROM {_LINES}"""


def inventory(strict: bool) -> str:
    qty = _defect(strict, "CAST((units * 31 + l_partkey * 17) % 1500 AS VARCHAR)", ("l_partkey % 53 = 0", "'n/a'"), ("l_partkey % 67 = 1", "'-5'"))
    reorder = _defect(strict, "CAST(l_partkey % 201 + 100 AS VARCHAR)", ("l_partkey % 59 = 0", "NULL"))
    safety = _defect(strict, "CAST(l_partkey % 101 + 50 AS VARCHAR)", ("l_partkey % 61 = 0", "''"))
    return f"""
    SELECT {_id('INV-', 'warehouse', 3)} || '-' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS inventory_id,
           {_id('WH-', 'warehouse', 3)} AS warehouse_id, {_id('PRD-', 'l_partkey')} AS product_id,
           {qty} AS quantity_on_hand, {reorder} AS reorder_level, {safety} AS safety_stock,
           strftime(counted, {_ISO}) AS last_counted_at, 'WMS_INVENTORY' AS source_system, counted AS ingested_at
    FROM (SELECT l_partkey, l_suppkey % 25 AS warehouse, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
                 max(l_shipdate) AS counted
          FROM lineitem GROUP BY ALL)"""


def iot_sensors(strict: bool) -> str:
    temp = _defect(
        strict,
        _hundredths("CAST(round(value * 100) AS BIGINT) // 10"),
        ("event_type = 'error'", "'ERR'"),
        ("event_id % 101 = 0", "'-99.90'"),
    )
    battery = _defect(strict, "CAST((event_id * 7) % 101 AS VARCHAR)", ("event_id % 23 = 0", "NULL"))
    return f"""
    SELECT {_id('EVT-', 'event_id')} AS event_id,
           {_id('SHP-', 'event_id % (SELECT count(*) FROM orders)')} || '-' || CAST(event_id % 7 + 1 AS VARCHAR) AS shipment_id,
           'DEV-' || CAST(user_id AS VARCHAR) AS device_id,
           CAST(event_id % 120 - 60 AS VARCHAR) || '.25' AS latitude,
           CAST(event_id % 300 - 150 AS VARCHAR) || '.5' AS longitude,
           {temp} AS temperature_c, json_extract_string(props, '$.k') AS humidity_pct, {battery} AS battery_level,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS recorded_at, props AS raw_payload,
           'IOT_SENSOR_KAFKA' AS source_system, ts + to_seconds(delivery) AS ingested_at
    FROM events JOIN (VALUES (0), (1)) AS d(delivery) ON delivery = 0 OR event_id % 10 = 0"""


FEEDS = {
    "suppliers": suppliers,
    "products": products,
    "warehouses": warehouses,
    "customers": customers,
    "orders": orders,
    "shipments": shipments,
    "inventory": inventory,
    "iot_sensors": iot_sensors,
}

CTES: dict[str, str] = {}
for _name, _build in FEEDS.items():
    CTES[f"raw_{_name}"] = _build(False)
    CTES[f"strict_{_name}"] = _build(True)
