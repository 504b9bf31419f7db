"""Streaming jobs: sinks, triggers and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tradewind.sources.shared import fresh_path
from tradewind.streaming.transforms import enrich_iot_stream, parse_iot_stream, parse_shipment_stream


def console_sink(stream: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Each batch's first ``rows`` rows on the console, untruncated.

    Spark's console format brings the whole batch to the driver before it prints the first rows.  Here every
    row still passes its task, once, so what the stream observes is counted, but a task hands on ``rows`` rows at most.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        # Ids grow with the task and the place in it, so these are the rows the batch starts with.
        first = batch.orderBy(F.monotonically_increasing_id()).limit(rows)
        line = "-" * 43
        print(line, f"Batch: {batch_id}", line, sep="\n")
        first.show(rows, truncate=False)

    return stream.writeStream.outputMode("append").foreachBatch(show)


def iot_job(records: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Telemetry records, parsed and enriched, to the console."""
    return console_sink(enrich_iot_stream(parse_iot_stream(records))).option("checkpointLocation", checkpoint)


def shipment_job(records: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Shipment status records, parsed, to the console."""
    return console_sink(parse_shipment_stream(records)).option("checkpointLocation", checkpoint)


def bounded_ingest(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Write everything the source holds now, once, then stop.

    A later run with the same checkpoint goes on where this one ended; a run
    cut short repeats no row, as the file sink records what it committed.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def land_bronze_stream(stream: DataFrame, table_path: str, archive_path: str, checkpoint: str) -> StreamingQuery:
    """Land each batch as table rows and as a JSON archive.

    Both go to a folder named after the batch, so a batch that runs twice
    replaces itself.  The archive is made from the written rows: the source is
    read once and nothing is held.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = f"{table_path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(rows)
        written = batch.sparkSession.read.schema(batch.schema).parquet(rows)
        written.write.mode("overwrite").json(f"{archive_path}/batch_id={batch_id}")

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(land)
        .start()
    )


def drained(stream: DataFrame, label: str) -> DataFrame:
    """Run a bounded ingest into a fresh shared folder and read back what it wrote."""
    spark = stream.sparkSession
    path = fresh_path(spark, label)
    bounded_ingest(stream, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")
