"""Sources, sinks and streams in DuckDB SQL: what the files must hold in the end."""

from oracle.checks import QUALITY
from oracle.tables import query

_READING = """SELECT event_id, shipment_id, device_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
    TRY_CAST(temperature_c AS DOUBLE) AS temperature_c, CAST(humidity_pct AS DOUBLE) AS humidity_pct,
    TRY_CAST(battery_level AS INTEGER) AS battery_level, recorded_at FROM raw_iot_sensors"""

_FIELDS = "event_id shipment_id device_id latitude longitude temperature_c humidity_pct battery_level recorded_at".split()
_BROKEN = "CAST(substr(event_id, 5) AS BIGINT) % 211 = 0"
_PARSED = "SELECT " + ", ".join(f"CASE WHEN {_BROKEN} THEN NULL ELSE {c} END AS {c}" for c in _FIELDS) + f" FROM ({_READING})"
_ENRICHED = f"""SELECT *, coalesce(temperature_c > 8.0, FALSE) AS is_temp_breach, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
    FROM ({_PARSED})"""

_MESSAGES = """SELECT 'EVT-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS event_id,
    'SHP-' || l_orderkey || '-' || l_linenumber AS shipment_id,
    CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS status,
    greatest(0, CAST(round(l_discount * 100) AS INTEGER) - 4) * 12 AS delay_hours,
    'PORT-' || (o_custkey % 25) AS location, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS updated_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_TRACKING = f"""SELECT 'EVT-' || event_id AS event_id, 'SHP-' || user_id AS shipment_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, CAST(event_id % 120 - 60 AS DOUBLE) AS latitude,
    CAST(event_id % 300 - 150 AS DOUBLE) AS longitude, value / 10 AS temperature, {_K} % 60 AS speed,
    CASE event_type WHEN 'purchase' THEN 'DELIVERED' WHEN 'error' THEN 'DELAYED' WHEN 'signup' THEN 'PORT_CHECKIN'
         ELSE 'IN_TRANSIT' END AS status FROM events"""

_STATE = f"""SELECT 'SHIPMENT' AS entity_type, shipment_id AS entity_id, latitude, longitude, status, speed,
    CASE WHEN temperature > 8.0 THEN 'BREACH' ELSE 'NORMAL' END AS cold_chain_status, CAST(timestamp AS TIMESTAMP) AS updated_at
    FROM ({_TRACKING}) QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY timestamp DESC, event_id DESC) = 1"""

# A timer lasts a day after delivery and thirty after anything else; the watermark ends an hour before the newest event.
_LIVE = f"""SELECT * FROM ({_STATE})
    WHERE epoch_us(updated_at) // 1000 + 86400000::BIGINT * CASE WHEN status = 'DELIVERED' THEN 1 ELSE 30 END
          >= (SELECT max(epoch_us(ts)) // 1000 - 3600000 FROM events)"""

_PLANS = """SELECT 'SHP-' || c_custkey AS entity_id, 'WH-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS destination_id,
    'CARRIER-' || (c_custkey % 7) AS carrier, (['Air Freight', 'Sea Freight', 'Road Truckload', 'Rail Express'])[c_custkey % 4 + 1] AS mode,
    TIMESTAMP '2024-01-20 00:00:00' + to_days(CAST(c_custkey % 15 AS INTEGER)) AS promised_at FROM customer"""

_OBJECTS = f"""SELECT * FROM (
    WITH ends AS (
      SELECT warehouse_id, city, CAST(latitude AS DOUBLE) AS lat, CAST(longitude AS DOUBLE) AS lon FROM silver_warehouses),
    lanes AS (SELECT carrier, mode, CAST(count(*) FILTER (is_delayed) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS late
              FROM silver_shipments GROUP BY carrier, mode),
    hubs AS (SELECT entity_id, arg_min(city, (abs(latitude - lat) + abs(longitude - lon), warehouse_id)) AS city
             FROM ({_STATE}), ends WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY entity_id),
    planned AS (
      SELECT s.*, hubs.city, p.promised_at, coalesce(l.late, 0.0::DOUBLE) AS late, e.lat, e.lon,
             (abs(latitude - e.lat) + abs(longitude - e.lon)) * 111.0::DOUBLE / (CAST(speed AS DOUBLE) * 1.852::DOUBLE) AS hours
      FROM ({_STATE}) s LEFT JOIN hubs USING (entity_id) LEFT JOIN ({_PLANS}) p USING (entity_id)
      LEFT JOIN lanes l USING (carrier, mode) LEFT JOIN ends e ON p.destination_id = e.warehouse_id),
    arriving AS (
      SELECT *, CASE WHEN status = 'DELIVERED' THEN updated_at
                     WHEN speed > 0 AND lat IS NOT NULL AND lon IS NOT NULL THEN updated_at + to_seconds(CAST(floor(hours * 3600.0::DOUBLE) AS BIGINT))
                     ELSE promised_at END AS eta FROM planned),
    delayed AS (
      SELECT *, CASE WHEN status = 'DELIVERED' THEN 0.0::DOUBLE ELSE floor((1.0::DOUBLE - (1.0::DOUBLE - late) * (1.0::DOUBLE - coalesce(
        least(1.0::DOUBLE, greatest(0.0::DOUBLE, CAST(epoch_us(eta) - epoch_us(promised_at) AS DOUBLE) / 3600000000.0::DOUBLE) / 72.0::DOUBLE),
        0.0::DOUBLE))) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE END AS delay_probability FROM arriving),
    scored AS (
      SELECT *, round_even(25.0::DOUBLE * 0.2::DOUBLE + delay_probability * 100.0::DOUBLE * 0.2::DOUBLE + 30.0::DOUBLE * 0.15::DOUBLE
                           + 20.0::DOUBLE * 0.2::DOUBLE + 15.0::DOUBLE * 0.15::DOUBLE + 20.0::DOUBLE * 0.1::DOUBLE, 1) AS risk_score FROM delayed)
    SELECT entity_type, entity_id, status, speed AS speed_knots, eta, delay_probability, risk_score,
           CASE WHEN risk_score > 80 THEN 'CRITICAL' WHEN risk_score > 60 THEN 'HIGH' WHEN risk_score > 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
           cold_chain_status, updated_at, latitude, longitude, city FROM scored)"""

BODIES = {
    "read_layer": "SELECT * FROM silver_customers",
    "write_layer": "SELECT * FROM silver_products UNION ALL SELECT * FROM silver_products",
    "read_bronze_csv": """SELECT *, to_json({supplier_id: supplier_id, country: country, tier: tier})::VARCHAR AS raw_payload
        FROM raw_suppliers""",
    "read_bronze_json": "SELECT product_id, sku, name, category, unit_cost, currency, weight_kg, supplier_id FROM strict_products",
    "write_lake_snapshot": """SELECT *, DATE '2001-12-30' AS ingest_date FROM silver_customers
        UNION ALL SELECT *, DATE '2001-12-31' FROM silver_customers""",
    "stamp_bronze": """SELECT shipment_id, status, 'TMS_TRACKING_API' AS source_system, TIMESTAMP '2002-01-01 00:00:00' AS ingested_at
        FROM raw_shipments""",
    "materialize": "SELECT * FROM dim_product_dbt",
    "to_kafka_records": """SELECT 'supply-chain-shipment-events' AS topic, shipment_id AS key,
        to_json({shipment_id: shipment_id, carrier: carrier, status: status, delay_hours: delay_hours})::VARCHAR AS value
        FROM silver_shipments""",
    "stream_kafka_iot": "SELECT 'supply-chain-iot-telemetry' AS topic, event_id AS key, CASE WHEN "
    + _BROKEN
    + " THEN '#' ELSE '' END || to_json({"
    + ", ".join(f"{c}: {c}" for c in _FIELDS)
    + f"}})::VARCHAR AS value FROM ({_READING})",
    "stream_kafka_shipments": f"""SELECT 'supply-chain-shipment-events' AS topic, shipment_id AS key,
        to_json({{event_id: event_id, shipment_id: shipment_id, status: status, delay_hours: delay_hours, location: location,
        updated_at: updated_at}})::VARCHAR AS value FROM ({_MESSAGES})""",
    "parse_json_stream": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total,
        o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS ordered_at FROM orders""",
    "parse_iot_stream": _PARSED,
    "bounded_ingest": _PARSED,
    "land_bronze_stream": _PARSED,
    "enrich_iot_stream": _ENRICHED,
    "console_sink": f"SELECT count(*) AS readings, count(*) FILTER (is_temp_breach) AS breaches FROM ({_ENRICHED})",
    "breach_alerts": f"SELECT * FROM ({_ENRICHED}) WHERE is_temp_breach",
    "unique_events": f"""SELECT DISTINCT * REPLACE (CAST(recorded_at AS TIMESTAMP) AS recorded_at) FROM ({_PARSED})
        WHERE event_id IS NOT NULL""",
    "parse_shipment_stream": _MESSAGES,
    "parse_tracking_events": _TRACKING,
    "parse_weather_events": f"""SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, 'PORT-' || (user_id % 25) AS location,
        value / 10 AS temperature, CAST({_K} AS DOUBLE) AS wind_speed, CAST({_K} AS DOUBLE) / 100 AS storm_probability,
        event_type AS condition FROM events""",
    "entity_state": _STATE,
    "entity_state_stream": _STATE,
    "entity_state_live": _LIVE,
    "entity_objects": _OBJECTS,
    # How long a run takes no SQL can tell, only that it takes some time.
    "ops_gauges": f"""SELECT metric, value, value > 0 AS measured FROM ({QUALITY['ops_metrics']}) WHERE metric <> 'iot_temp_breach_total'
        UNION ALL SELECT 'iot_temp_breach_total', CAST(count(*) AS DOUBLE), count(*) > 0 FROM ({_ENRICHED}) WHERE is_temp_breach
        UNION ALL SELECT 'etl_latency_ms', NULL, TRUE""",
}

SQL = {name: query(body) for name, body in BODIES.items()}
