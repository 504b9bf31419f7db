"""The current state of every tracked entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind import fixed_values as fixed
from tradewind.functions.measures import exceeds
from tradewind.operators.dedup import latest_per_key, require_key

MOMENT, _KEY = "timestamp", "shipment_id"


def describe(row: Column | None = None) -> list[Column]:
    def field(name: str) -> Column:
        return F.col(name) if row is None else row[name]

    warm = exceeds(field("temperature"), fixed.COLD_CHAIN_LIMIT_C)
    return [
        F.lit("SHIPMENT").alias("entity_type"),
        F.col(_KEY).alias("entity_id"),
        F.struct(field("latitude").alias("latitude"), field("longitude").alias("longitude")).alias("current_location"),
        field("status").alias("status"),
        field("speed").alias("speed"),
        F.when(warm, "BREACH").otherwise("NORMAL").alias("cold_chain_status"),
        field(MOMENT).alias("updated_at"),
    ]


def entity_state(tracking: DataFrame) -> DataFrame:
    """Newest known state per shipment from bounded tracking events."""
    timed = require_key(tracking, _KEY).withColumn(MOMENT, F.try_to_timestamp(F.col(MOMENT)))
    return latest_per_key(timed, [_KEY], MOMENT).select(*describe())


def entity_state_updates(tracking: DataFrame) -> DataFrame:
    """The same over a stream, for update mode: one row per entity that changed.

    The state store keeps one row per entity, spread over the executors by id;
    a batch's events of one entity are reduced before they are shuffled.
    """
    timed = require_key(tracking, _KEY).withColumn(MOMENT, F.try_to_timestamp(F.col(MOMENT)))
    order = [MOMENT, *[c for c in tracking.columns if c not in (_KEY, MOMENT)]]
    newest = timed.groupBy(_KEY).agg(F.max(F.struct(*order)).alias("newest"))
    return newest.select(*describe(F.col("newest")))


def write_state(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch's changes; a batch run twice replaces its own folder."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        updates.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(append)
        .start()
    )


def read_state(changes: DataFrame) -> DataFrame:
    """Current state from the log of changes: the last batch of each entity wins."""
    return latest_per_key(changes, ["entity_id"], "batch_id").drop("batch_id")
