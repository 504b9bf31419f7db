"""Parsing and enriching event streams; every function works on batches too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import fixed_values as fixed
from tradewind import schemas
from tradewind.functions.measures import exceeds


def route(records: DataFrame, topic: str) -> DataFrame:
    """The records of one topic from a source subscribed to several."""
    return records.filter(F.col("topic") == topic)


def parse_json_stream(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` from JSON values; malformed JSON gives NULL fields."""
    event = F.from_json(F.col("value").cast("string"), schema)
    return records.select(event.alias("event")).select("event.*")


def parse_iot_stream(records: DataFrame) -> DataFrame:
    return parse_json_stream(records, schemas.IOT_EVENT)


def parse_shipment_stream(records: DataFrame) -> DataFrame:
    return parse_json_stream(records, schemas.SHIPMENT_EVENT)


def parse_tracking_events(records: DataFrame) -> DataFrame:
    return parse_json_stream(records, schemas.TRACKING_EVENT)


def parse_weather_events(records: DataFrame) -> DataFrame:
    return parse_json_stream(records, schemas.WEATHER_EVENT)


def enrich_iot_stream(
    readings: DataFrame, limit_c: float = fixed.COLD_CHAIN_LIMIT_C, ingested_at: Column | None = None
) -> DataFrame:
    """Add the breach flag and the time of arrival."""
    arrived = F.current_timestamp() if ingested_at is None else ingested_at
    return readings.withColumns({"is_temp_breach": exceeds(F.col("temperature_c"), limit_c), "ingested_at": arrived})


def breach_alerts(enriched: DataFrame) -> DataFrame:
    return enriched.filter("is_temp_breach")


def counting(enriched: DataFrame, observation: str | Observation = "telemetry") -> DataFrame:
    """Count readings and breaches as they pass, without a second pass.

    On a stream the counts of each micro-batch appear in the query's progress
    under the observation's name.
    """
    return enriched.observe(
        observation,
        F.count(F.lit(1)).alias("readings"),
        F.count_if("is_temp_breach").alias("breaches"),
    )


def unique_events(events: DataFrame, event_id: str, moment: str, lateness: str = "1 day") -> DataFrame:
    """Each event once, as long as its copies arrive within ``lateness`` of each other.

    The watermark bounds the ids held as state.
    """
    timed = events.withColumn(moment, F.try_to_timestamp(F.col(moment)))
    return timed.withWatermark(moment, lateness).dropDuplicatesWithinWatermark([event_id])


def breach_windows(enriched: DataFrame, moment: str, width: str = "1 hour", lateness: str = "1 day") -> DataFrame:
    """Readings and breaches per tumbling window of event time."""
    return (
        enriched.withWatermark(moment, lateness)
        .groupBy(F.window(moment, width).alias("window"))
        .agg(F.count("*").alias("readings"), F.count_if("is_temp_breach").alias("breaches"))
        .select(F.col("window.start").alias("window_start"), "readings", "breaches")
    )
