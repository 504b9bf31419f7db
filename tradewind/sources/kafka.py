"""Kafka topics as streams, and frames as Kafka records.

Reading and writing topics needs Spark's Kafka connector on the class path.
Everything after the source works on any frame with binary ``key`` and
``value`` columns, so a file stream can feed the same transformations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tradewind import fixed_values as fixed


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str) -> DataFrame:
    source = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    return spark.readStream.format("kafka").options(**source, **options).load()


def stream_kafka_iot(spark: SparkSession, servers: str, starting_offsets: str = "latest") -> DataFrame:
    return kafka_stream(spark, servers, fixed.TOPIC_IOT, starting_offsets)


def stream_kafka_shipments(spark: SparkSession, servers: str, starting_offsets: str = "latest") -> DataFrame:
    return kafka_stream(spark, servers, fixed.TOPIC_SHIPMENTS, starting_offsets)


def to_kafka_records(df: DataFrame, topic: str, key: Column, value: Sequence[str] | None = None) -> DataFrame:
    """``topic``, UTF-8 ``key`` and JSON ``value``; ``value`` names the payload columns."""
    payload = F.to_json(F.struct(*(value or df.columns)), {"ignoreNullFields": "false"})
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
    )


def write_kafka(records: DataFrame, servers: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_kafka_stream(records: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    options = {"kafka.bootstrap.servers": servers, "checkpointLocation": checkpoint}
    return records.writeStream.format("kafka").options(**options)
