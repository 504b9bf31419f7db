"""Sources, sinks and streaming jobs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind import schemas
from tradewind.sources import files, kafka, shared
from tradewind.streaming import jobs, state, transforms


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_csv_keeps_quotes_blanks_and_json(spark, rows, folder):
    schema = "id string, name string, raw_payload string"
    data = [("1", '  say "hi", twice ', '{"a": "x,y", "b": "\\"q\\""}'), ("2", None, "{}")]
    files.write_bronze_csv(rows(schema, data), f"{folder}/csv")
    assert sorted(map(tuple, files.read_bronze_csv(spark, f"{folder}/csv", schema).collect())) == data


def test_json_array_with_numbers_reads_as_text(spark, folder):
    spark.createDataFrame([('[\n  {"id": "P1", "weight": 1.2, "qty": "7"},\n  {"id": "P2", "weight": 3}\n]',)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{folder}/j")
    got = files.read_bronze_json(spark, f"{folder}/j", "id string, weight string, qty string").collect()
    assert sorted(map(tuple, got), key=str) == [("P1", "1.2", "7"), ("P2", "3", None)]


def test_json_arrays_round_trip(spark, rows, folder):
    data = [(f"id{i}", i) for i in range(500)]
    files.write_bronze_json(rows("id string, n int", data), f"{folder}/j", "id", 3)
    got = files.read_bronze_json(spark, f"{folder}/j", "id string, n int")
    assert sorted((r.id, r.n) for r in got.collect()) == sorted(data)
    assert len(got.inputFiles()) == 3


def test_missing_layer_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_layer(spark, folder, "silver", "nothing").count()


def test_snapshot_replaces_only_its_day(spark, rows, folder):
    for day, ids in [("2026-08-05", ["a", "b"]), ("2026-08-13", ["c"]), ("2026-08-05", ["d"])]:
        files.write_lake_snapshot(rows("id string", [(i,) for i in ids]), folder, "silver", "t", F.lit(day))
    got = files.read_layer(spark, folder, "silver", "t").collect()
    assert sorted((r.id, str(r.ingest_date)) for r in got) == [("c", "2026-08-13"), ("d", "2026-08-05")]


def test_stamp_fills_only_what_is_missing(rows):
    feed = rows("id string, source_system string", [("a", "OTHER"), ("b", None)])
    got = files.stamp_bronze(feed, "raw_orders").orderBy("id").collect()
    assert [r.source_system for r in got] == ["OTHER", "ERP_ORDERS"]
    assert all(r.ingested_at for r in got)


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    class Conf(dict):
        def set(self, key, value):
            self[key] = value

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError):
        shared.shared_dir(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared.shared_dir(Session) == "hdfs:///shared"
    Session.conf = Conf({"spark.master": "local[2]"})
    assert shared.shared_dir(Session) == shared.shared_dir(Session) == Session.conf["spark.checkpoint.dir"]


READING = '{"event_id": "%s", "shipment_id": "S1", "device_id": "D", "temperature_c": %s, "battery_level": 90, "recorded_at": "%s", "is_temp_breach": true}'


@pytest.fixture
def messages(rows):
    data = [
        READING % ("E1", "8.0", "2026-01-01T00:10:00"),
        READING % ("E2", "8.5", "2026-01-01T00:20:00"),
        READING % ("E2", "8.5", "2026-01-01T00:20:00"),
        READING % ("E3", "null", "2026-01-01T01:10:00"),
        "{broken",
    ]
    return rows("value string", [(d,) for d in data]).select(F.col("value").cast("binary").alias("value"))


@pytest.fixture
def stream(spark, messages, folder):
    messages.write.parquet(f"{folder}/source")
    return spark.readStream.schema(messages.schema).parquet(f"{folder}/source")


def as_set(frame):
    return sorted(map(str, frame.collect()))


def test_malformed_json_gives_null_fields(messages):
    parsed = transforms.parse_iot_stream(messages)
    assert parsed.columns == schemas.IOT_EVENT.fieldNames()
    assert parsed.filter("event_id IS NULL").count() == 1


def test_stream_equals_batch(messages, stream):
    arrived = F.lit(dt.datetime(2026, 1, 2))

    def flow(records):
        return transforms.enrich_iot_stream(transforms.parse_iot_stream(records), ingested_at=arrived)

    assert as_set(jobs.drained(flow(stream), "t")) == as_set(flow(messages))
    alerts = transforms.breach_alerts(flow(messages))
    assert [r.event_id for r in alerts.collect()] == ["E2", "E2"]


def test_copies_are_dropped_from_the_stream(stream):
    unique = transforms.unique_events(transforms.parse_iot_stream(stream).filter("event_id IS NOT NULL"), "event_id", "recorded_at")
    assert sorted(r.event_id for r in jobs.drained(unique, "t").collect()) == ["E1", "E2", "E3"]


def test_breach_windows(messages):
    parsed = transforms.parse_iot_stream(messages).withColumn("at", F.try_to_timestamp("recorded_at"))
    flagged = transforms.enrich_iot_stream(parsed).filter("at IS NOT NULL")
    got = transforms.breach_windows(flagged, "at").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.readings, r.breaches) for r in got] == [(0, 3, 2), (1, 1, 0)]


def test_counting_on_a_batch_and_a_stream(messages, stream, folder):
    seen = Observation("seen")
    flagged = transforms.enrich_iot_stream(transforms.parse_iot_stream(messages))
    transforms.counting(flagged, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"readings": 5, "breaches": 2}
    live = transforms.counting(transforms.enrich_iot_stream(transforms.parse_iot_stream(stream)))
    query = jobs.bounded_ingest(live, f"{folder}/out", f"{folder}/cp")
    query.awaitTermination()
    metrics = [p["observedMetrics"]["telemetry"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["breaches"] for m in metrics) == 2


def test_bounded_ingest_goes_on_where_it_ended(spark, messages, stream, folder):
    def drain():
        jobs.bounded_ingest(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
        return spark.read.parquet(f"{folder}/out").count()

    assert (drain(), drain()) == (5, 5)
    messages.write.mode("append").parquet(f"{folder}/source")
    assert drain() == 10


def test_landing_writes_table_and_archive(spark, stream, folder):
    parsed = transforms.parse_iot_stream(stream)
    jobs.land_bronze_stream(parsed, f"{folder}/table", f"{folder}/archive", f"{folder}/cp").awaitTermination()
    assert spark.read.parquet(f"{folder}/table").count() == 5
    assert spark.read.json(f"{folder}/archive").filter("event_id IS NOT NULL").count() == 4


@pytest.mark.parametrize("job", [jobs.iot_job, jobs.shipment_job])
def test_console_jobs_run(stream, folder, job):
    query = job(stream, f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) == 5


def test_kafka_records(rows):
    frame = rows("id string, status string, n int", [("S1", None, 3)])
    record = kafka.to_kafka_records(frame, fixed.TOPIC_SHIPMENTS, F.col("id"), ["status", "n"]).first()
    assert (record.topic, bytes(record.key), bytes(record.value)) == ("supply-chain-shipment-events", b"S1", b'{"status":null,"n":3}')


def test_route_by_topic(rows):
    frame = rows("topic string, value string", [("a", "1"), ("b", "2")])
    assert [r.value for r in transforms.route(frame, "b").collect()] == ["2"]


def test_kafka_source_names_the_missing_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.stream_kafka_iot(spark, "broker:9092")


def tracking(shipment, moment, status, temperature=5.0):
    return ("E" + moment, shipment, moment, 1.0, 2.0, temperature, 10, status)


def test_entity_state_stream_equals_batch(spark, rows, folder):
    first = [tracking("A", "2026-01-01T00:00:00", "IN_TRANSIT"), tracking("B", "2026-01-01T00:00:00", "DELAYED", 9.0)]
    second = [tracking("A", "2026-01-02T00:00:00", "DELIVERED"), tracking("B", "2025-12-31T00:00:00", "IN_TRANSIT")]
    path = f"{folder}/events"
    for part in (first, second):
        rows(schemas.TRACKING_EVENT, part).write.mode("append").parquet(path)
        live = spark.readStream.schema(schemas.TRACKING_EVENT).parquet(path)
        state.write_state(state.entity_state_updates(live), f"{folder}/log", f"{folder}/cp").awaitTermination()
    current = state.read_state(spark.read.parquet(f"{folder}/log"))
    batch = state.entity_state(rows(schemas.TRACKING_EVENT, first + second))
    assert as_set(current.select(*batch.columns)) == as_set(batch)
    assert {r.entity_id: (r.status, r.cold_chain_status) for r in batch.collect()} == {"A": ("DELIVERED", "NORMAL"), "B": ("DELAYED", "BREACH")}
