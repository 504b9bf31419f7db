"""Sources, sinks and streams, fed from the driver's tables through real files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import fixed_values as fixed
from tradewind import schemas
from tradewind.operators import gold, silver, staging
from tradewind.plans import landing
from tradewind.sources import driver_tables as feeds
from tradewind.sources import files, kafka
from tradewind.sources.driver_tables import DriverTables
from tradewind.sources.shared import fresh_path
from tradewind.streaming import expiry, jobs, progress, snapshots, state, transforms

SNAPSHOT_DAYS = ["2001-12-30", "2001-12-31"]


def _read_layer(spark: SparkSession, folder: str) -> DataFrame:
    customers = silver.silver_customers(feeds.raw_customers(DriverTables(spark, folder)))
    root = fresh_path(spark, "read-layer")
    files.write_layer(customers, root, "silver", "customers")
    return files.read_layer(spark, root, "silver", "customers", customers.schema)


def _write_layer(spark: SparkSession, folder: str) -> DataFrame:
    """Replace, then append: the table ends up with every row twice."""
    products = silver.silver_products(feeds.raw_products(DriverTables(spark, folder)))
    root = fresh_path(spark, "write-layer")
    files.write_layer(products, root, "silver", "products", "replace")
    written = files.read_layer(spark, root, "silver", "products", products.schema)
    files.write_layer(products, root, "silver", "products", "append")
    return files.read_layer(spark, root, "silver", "products", written.schema)


def _read_bronze_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "bronze-csv")
    files.write_bronze_csv(feeds.raw_suppliers(DriverTables(spark, folder)), path)
    return files.read_bronze_csv(spark, path, schemas.RAW["raw_suppliers"])


def _read_bronze_json(spark: SparkSession, folder: str) -> DataFrame:
    """Products as JSON arrays, numbers as JSON numbers, read back as text."""
    products = feeds.raw_products(DriverTables(spark, folder), strict=True).select(*schemas.RAW_COLUMNS["raw_products"])
    numeric = products.withColumn("weight_kg", F.col("weight_kg").cast("double"))
    path = fresh_path(spark, "bronze-json")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files.write_bronze_json(numeric, path, "product_id", files.array_files(products.count(), least))
    return files.read_bronze_json(spark, path, products.schema).drop("file")


def _write_lake_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Two days' snapshots, the first written again: the second must survive."""
    customers = silver.silver_customers(feeds.raw_customers(DriverTables(spark, folder)))
    root = fresh_path(spark, "snapshot")
    for day in [*SNAPSHOT_DAYS, SNAPSHOT_DAYS[0]]:
        files.write_lake_snapshot(customers, root, "silver", "customers", F.lit(day))
    return files.read_layer(spark, root, "silver", "customers")


def _stamp_bronze(spark: SparkSession, folder: str) -> DataFrame:
    bare = feeds.raw_shipments(DriverTables(spark, folder)).select("shipment_id", "status")
    return files.stamp_bronze(bare, "raw_shipments", F.lit("2002-01-01 00:00:00").cast("timestamp"))


def _materialize(spark: SparkSession, folder: str) -> DataFrame:
    """A staged view and a written mart on top of it."""
    raw = feeds.raw_products(DriverTables(spark, folder), strict=True)
    staged = files.materialize(spark, "stg_products", staging.stg_products, raw)
    return files.materialize(spark, "dim_product", gold.dim_product, staged, root=fresh_path(spark, "models"))


def _to_kafka_records(spark: SparkSession, folder: str) -> DataFrame:
    shipments = silver.silver_shipments(feeds.raw_shipments(DriverTables(spark, folder)))
    payload = ["shipment_id", "carrier", "status", "delay_hours"]
    records = kafka.to_kafka_records(shipments, fixed.TOPIC_SHIPMENTS, F.col("shipment_id"), payload)
    return records.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# Streams: the events and order lines as unbounded file sources, shaped as topic records.


def _broken(event_id: Column, value: Column) -> Column:
    """Every 211th message is not JSON."""
    return F.when(event_id % 211 == 0, F.concat(F.lit("#").cast("binary"), value)).otherwise(value)


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def iot_records(tables: DriverTables) -> DataFrame:
    readings = feeds.iot_readings(tables.stream("events"), feeds.order_count(tables))
    records = kafka.to_kafka_records(_typed(readings, schemas.IOT_EVENT), fixed.TOPIC_IOT, F.col("event_id"))
    number = F.substr(F.col("key").cast("string"), F.lit(5)).cast("bigint")
    return records.withColumn("value", _broken(number, F.col("value")))


def shipment_messages(tables: DriverTables) -> DataFrame:
    """Status messages of order lines."""
    status = F.when(F.col("o_orderstatus") == "F", "DELIVERED").otherwise("IN_TRANSIT")
    line_id = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))
    late = F.greatest(F.lit(0), F.round(F.col("l_discount") * 100).cast("int") - 4) * 12
    messages = feeds.order_lines(tables).select(
        F.concat(F.lit("EVT-"), line_id).alias("event_id"),
        F.concat(F.lit("SHP-"), F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))).alias("shipment_id"),
        status.alias("status"),
        late.alias("delay_hours"),
        F.concat(F.lit("PORT-"), (F.col("o_custkey") % feeds.NATIONS).cast("string")).alias("location"),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
    )
    return kafka.to_kafka_records(messages, fixed.TOPIC_SHIPMENTS, F.col("shipment_id"))


def shipment_records(spark: SparkSession, folder: str) -> DataFrame:
    """The topic of status messages: landed as files once, streamed from there without a join."""
    return landing.streamed(spark, folder, "shipment_messages", shipment_messages)


def _moment() -> Column:
    return F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def tracking_records(events: DataFrame) -> DataFrame:
    e, kind = F.col("event_id"), F.col("event_type")
    status = (
        F.when(kind == "purchase", "DELIVERED").when(kind == "error", "DELAYED").when(kind == "signup", "PORT_CHECKIN")
    ).otherwise("IN_TRANSIT")
    messages = events.select(
        F.concat(F.lit("EVT-"), e.cast("string")).alias("event_id"),
        F.concat(F.lit("SHP-"), F.col("user_id").cast("string")).alias("shipment_id"),
        _moment().alias("timestamp"),
        (e % 120 - 60).cast("double").alias("latitude"),
        (e % 300 - 150).cast("double").alias("longitude"),
        (F.col("value") / 10).alias("temperature"),
        (F.get_json_object("props", "$.k").cast("int") % 60).alias("speed"),
        status.alias("status"),
    )
    records = kafka.to_kafka_records(messages, "shipment_events", F.col("shipment_id"), messages.columns)
    return records


def weather_records(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    messages = events.select(
        _moment().alias("timestamp"),
        F.concat(F.lit("PORT-"), (F.col("user_id") % feeds.NATIONS).cast("string")).alias("location"),
        (F.col("value") / 10).alias("temperature"),
        k.alias("wind_speed"),
        (k / 100).alias("storm_probability"),
        F.col("event_type").alias("condition"),
    )
    return kafka.to_kafka_records(messages, "weather_events", F.col("location"))


def _as_text(records: DataFrame) -> DataFrame:
    return records.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _stream_kafka_iot(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.drained(_as_text(iot_records(DriverTables(spark, folder))), "iot-records")


def _stream_kafka_shipments(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.drained(_as_text(shipment_records(spark, folder)), "shipment-records")


def _parsed_iot(tables: DriverTables) -> DataFrame:
    return transforms.parse_iot_stream(iot_records(tables))


def _parse_iot_stream(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.drained(_parsed_iot(DriverTables(spark, folder)), "iot-parsed")


def _enriched(tables: DriverTables) -> DataFrame:
    fixed_arrival = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return transforms.enrich_iot_stream(_parsed_iot(tables), ingested_at=fixed_arrival)


def _enrich_iot_stream(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.drained(_enriched(DriverTables(spark, folder)), "iot-enriched")


def _console_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The telemetry job printing to the console; readings and breaches as its progress reports them."""
    observed = transforms.counting(_enriched(DriverTables(spark, folder)), "telemetry")
    job = jobs.console_sink(observed, rows=1)
    with progress.listening(spark) as totals:
        query = job.option("checkpointLocation", fresh_path(spark, "console")).trigger(availableNow=True).start()
        query.awaitTermination()
        seen = totals.of(query)
    counts = [(int(seen.get("telemetry.readings", 0)), int(seen.get("telemetry.breaches", 0)))]
    return spark.createDataFrame(counts, "readings bigint, breaches bigint")


def _breach_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.drained(transforms.breach_alerts(_enriched(DriverTables(spark, folder))), "iot-alerts")


def _unique_events(spark: SparkSession, folder: str) -> DataFrame:
    parsed = _parsed_iot(DriverTables(spark, folder)).filter("event_id IS NOT NULL")
    return jobs.drained(transforms.unique_events(parsed, "event_id", "recorded_at", "60 days"), "iot-unique")


def _parse_shipment_stream(spark: SparkSession, folder: str) -> DataFrame:
    parsed = transforms.parse_shipment_stream(shipment_records(spark, folder))
    return jobs.drained(parsed, "shipments-parsed")


def _two_topics(tables: DriverTables) -> DataFrame:
    events = tables.stream("events")
    return tracking_records(events).union(weather_records(events))


def _parse_tracking_events(spark: SparkSession, folder: str) -> DataFrame:
    routed = transforms.route(_two_topics(DriverTables(spark, folder)), "shipment_events")
    return jobs.drained(transforms.parse_tracking_events(routed), "tracking")


def _parse_weather_events(spark: SparkSession, folder: str) -> DataFrame:
    routed = transforms.route(_two_topics(DriverTables(spark, folder)), "weather_events")
    return jobs.drained(transforms.parse_weather_events(routed), "weather")


ORDER_EVENT = "order_id bigint, customer_id bigint, total double, priority string, ordered_at string"


def _parse_json_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A topic without a fixed layout: the caller brings the schema."""
    ordered = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    messages = DriverTables(spark, folder).stream("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderpriority").alias("priority"),
        ordered.alias("ordered_at"),
    )
    records = kafka.to_kafka_records(messages, "order-events", F.col("order_id"))
    return jobs.drained(transforms.parse_json_stream(records, T.StructType.fromDDL(ORDER_EVENT)), "order-events")


def _flat(states: DataFrame) -> DataFrame:
    return states.select(
        "entity_type", "entity_id", "current_location.latitude", "current_location.longitude", "status", "speed",
        "cold_chain_status", "updated_at",
    )


def _entity_state(spark: SparkSession, folder: str) -> DataFrame:
    records = tracking_records(DriverTables(spark, folder)["events"])
    return _flat(state.entity_state(transforms.parse_tracking_events(records)))


def _tracked(spark: SparkSession, folder: str) -> tuple[str, T.StructType]:
    """All tracking events streamed through expiring state; where its snapshots are, and what they hold."""
    records = tracking_records(DriverTables(spark, folder).stream("events"))
    changes = expiry.expiring_state_updates(transforms.parse_tracking_events(records))
    path = fresh_path(spark, "entity-state")
    snapshots.write_changes(changes, f"{path}/state", f"{path}/checkpoint").awaitTermination()
    snapshots.compact(spark, f"{path}/state", changes.schema)
    return f"{path}/state", changes.schema


def _entity_state_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Whatever was ever tracked, ended or not."""
    path, schema = _tracked(spark, folder)
    return _flat(snapshots.read_entities(spark, path, schema, history=True))


def _entity_state_live(spark: SparkSession, folder: str) -> DataFrame:
    """Entities whose timers have not fired when the stream ends."""
    return _flat(snapshots.read_entities(spark, *_tracked(spark, folder)))


def entity_plans(customers: DataFrame) -> DataFrame:
    """Where each tracked shipment is going, on which lane, and when it was promised."""
    k = F.col("c_custkey")
    modes = F.array(*[F.lit(m) for m in fixed.TRANSIT_MODES])
    return customers.select(
        F.concat(F.lit("SHP-"), k.cast("string")).alias("entity_id"),
        F.concat(F.lit("WH-"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("destination_id"),
        F.concat(F.lit("CARRIER-"), (k % feeds.CARRIERS).cast("string")).alias("carrier"),
        F.element_at(modes, (k % 4 + 1).cast("int")).alias("mode"),
        F.timestamp_add("DAY", (k % 15).cast("int"), F.lit("2024-01-20 00:00:00").cast("timestamp")).alias("promised_at"),
    )


def entity_states(spark: SparkSession, folder: str) -> DataFrame:
    return state.entity_state(transforms.parse_tracking_events(tracking_records(DriverTables(spark, folder)["events"])))


def telemetry_gauges(spark: SparkSession, folder: str) -> DataFrame:
    """Breaches seen and milliseconds taken by a run of the telemetry stream, as its listener heard them."""
    observed = transforms.counting(_enriched(DriverTables(spark, folder)), "telemetry")
    path = fresh_path(spark, "telemetry")
    with progress.listening(spark) as totals:
        query = jobs.bounded_ingest(observed, f"{path}/data", f"{path}/checkpoint")
        query.awaitTermination()
        seen = totals.of(query)
    gauges = [("iot_temp_breach_total", seen.get("telemetry.breaches", 0.0)), (progress.LATENCY, seen[progress.LATENCY])]
    return spark.createDataFrame(gauges, "metric string, value double")


def _bounded_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Drain twice with one checkpoint: the second run finds nothing new."""
    path = fresh_path(spark, "bounded-ingest")
    parsed = _parsed_iot(DriverTables(spark, folder))
    for _ in range(2):
        jobs.bounded_ingest(parsed, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{path}/data")


def _land_bronze_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the archive that the landed table holds as well."""
    path = fresh_path(spark, "land-bronze")
    parsed = _parsed_iot(DriverTables(spark, folder))
    jobs.land_bronze_stream(parsed, f"{path}/table", f"{path}/archive", f"{path}/checkpoint").awaitTermination()
    landed = spark.read.schema(parsed.schema).parquet(f"{path}/table").drop("batch_id")
    archived = spark.read.schema(parsed.schema).json(f"{path}/archive").drop("batch_id")
    return archived.intersectAll(landed)


IO = {
    "read_layer": _read_layer,
    "read_bronze_csv": _read_bronze_csv,
    "read_bronze_json": _read_bronze_json,
    "write_layer": _write_layer,
    "write_lake_snapshot": _write_lake_snapshot,
    "stamp_bronze": _stamp_bronze,
    "materialize": _materialize,
    "to_kafka_records": _to_kafka_records,
}

STREAMS = {
    "stream_kafka_iot": _stream_kafka_iot,
    "stream_kafka_shipments": _stream_kafka_shipments,
    "parse_json_stream": _parse_json_stream,
    "parse_iot_stream": _parse_iot_stream,
    "enrich_iot_stream": _enrich_iot_stream,
    "breach_alerts": _breach_alerts,
    "console_sink": _console_sink,
    "unique_events": _unique_events,
    "parse_shipment_stream": _parse_shipment_stream,
    "parse_tracking_events": _parse_tracking_events,
    "parse_weather_events": _parse_weather_events,
    "entity_state": _entity_state,
    "entity_state_stream": _entity_state_stream,
    "entity_state_live": _entity_state_live,
    "bounded_ingest": _bounded_ingest,
    "land_bronze_stream": _land_bronze_stream,
}
