"""Tracked entities: state that ends, snapshots, gauges of runs, and the full state object."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import entities
from tradewind.streaming import expiry, jobs, progress, snapshots, transforms


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def tracking(shipment, moment, status, temperature=4.0, event="e"):
    return (event, shipment, moment, 1.0, 2.0, temperature, 10, status)


class Feed:
    """Tracking events that arrive part by part, streamed through expiring state."""

    def __init__(self, spark, folder, **choices):
        self.spark, self.folder, self.choices = spark, folder, choices
        self.root, self.seen = f"{folder}/state", []

    def add(self, *events):
        part = self.spark.createDataFrame(list(events), schemas.TRACKING_EVENT)
        part.coalesce(1).write.mode("append").parquet(f"{self.folder}/events")
        changes = expiry.expiring_state_updates(self.spark.readStream.schema(schemas.TRACKING_EVENT).parquet(f"{self.folder}/events"))
        self.schema = changes.schema
        query = snapshots.write_changes(changes, self.root, f"{self.folder}/checkpoint", **self.choices)
        query.awaitTermination()
        operators = [p["stateOperators"][0] for p in query.recentProgress]
        self.held = operators[-1]["numRowsTotal"]
        self.dropped = sum(o["numRowsDroppedByWatermark"] for o in operators)

    def now(self, history=False):
        rows = snapshots.read_entities(self.spark, self.root, self.schema, history).collect()
        return {r.entity_id: (r.status, str(r.updated_at)[:10]) for r in rows}


@pytest.mark.parametrize("compact_every", [None, 2])
def test_state_shrinks_after_delivery(spark, folder, compact_every):
    feed = Feed(spark, folder, compact_every=compact_every)
    feed.add(tracking("A", "2026-01-01T00:00:00", "IN_TRANSIT"), tracking("B", "2026-01-01T00:00:00", "DELAYED"), tracking(None, "2026-01-01T00:00:00", "DELAYED"), tracking("N", "soon", "DELAYED"))
    assert feed.held == 2
    # B's event is older than its newest one; A has arrived and is kept for a day.
    feed.add(tracking("A", "2026-01-02T00:00:00", "DELIVERED"), tracking("B", "2025-12-31T23:30:00", "IN_TRANSIT"), tracking("C", "2026-01-02T00:00:00", "IN_TRANSIT"))
    assert feed.held == 3 and feed.now()["B"] == ("DELAYED", "2026-01-01")
    # The watermark passes A's timer.
    feed.add(tracking("C", "2026-01-04T00:00:00", "IN_TRANSIT"))
    assert feed.held == 2 and set(feed.now()) == {"B", "C"}
    assert feed.now(history=True)["A"] == ("DELIVERED", "2026-01-02")
    # Too late for the watermark, whoever it is: dropped and counted.
    feed.add(tracking("D", "2026-01-03T00:00:00", "IN_TRANSIT"))
    assert feed.dropped == 1 and set(feed.now()) == {"B", "C"}
    # A reports again and lives anew; a month later the idle ones have ended.
    feed.add(tracking("A", "2026-01-05T00:00:00", "IN_TRANSIT"))
    assert feed.now()["A"] == ("IN_TRANSIT", "2026-01-05") and feed.held == 3
    feed.add(tracking("E", "2026-03-01T00:00:00", "IN_TRANSIT"))
    assert feed.held == 1 and set(feed.now()) == {"E"} and set(feed.now(history=True)) == {"A", "B", "C", "E"}


def test_what_is_read_is_bounded_by_the_living(spark, folder):
    feed = Feed(spark, folder)
    for day in range(1, 5):
        feed.add(*(tracking(f"S{day}-{k}", f"2026-01-{day:02}T00:00:00", "DELIVERED") for k in range(20)), tracking("L", f"2026-01-{day:02}T01:00:00", "IN_TRANSIT"))
    before = feed.now()
    assert snapshots.compact(spark, feed.root, feed.schema) == 1
    assert snapshots.compact(spark, feed.root, feed.schema) == 1, "nothing new, no new version"
    snapshots.vacuum(spark, feed.root, keep=1)
    assert feed.now() == before and len(before) < 50
    read = snapshots.read_entities(spark, feed.root, feed.schema)
    assert all("snapshots/version=1" in f for f in read.inputFiles())
    assert spark.read.parquet(f"{feed.root}/snapshots/version=1").count() == len(before)
    assert len(feed.now(history=True)) == 81


def test_a_compaction_cut_half_way_leaves_the_old_version(spark, folder, monkeypatch):
    feed = Feed(spark, folder)
    feed.add(tracking("A", "2026-01-01T00:00:00", "IN_TRANSIT"))
    assert snapshots.compact(spark, feed.root, feed.schema) == 1
    feed.add(tracking("A", "2026-01-02T00:00:00", "DELAYED"), tracking("B", "2026-01-02T00:00:00", "IN_TRANSIT"))
    before = feed.now()

    def cut(*_):
        raise RuntimeError("cut")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "_point", cut)
        with pytest.raises(RuntimeError):
            snapshots.compact(spark, feed.root, feed.schema)
    assert snapshots.pointer(spark, feed.root)[0] == 1 and feed.now() == before == {"A": ("DELAYED", "2026-01-02"), "B": ("IN_TRANSIT", "2026-01-02")}
    # The next one replaces what the cut one left.
    assert snapshots.compact(spark, feed.root, feed.schema) == 2 and feed.now() == before


def test_vacuum_keeps_versions_being_read(spark, folder):
    feed = Feed(spark, folder, compact_every=1)
    feed.add(tracking("A", "2026-01-01T00:00:00", "IN_TRANSIT"))
    assert snapshots.vacuum(spark, feed.root) == []
    for day in (2, 3, 4):
        feed.add(tracking("A", f"2026-01-{day:02}T00:00:00", "IN_TRANSIT"))
    newest = snapshots.pointer(spark, feed.root)[0]
    assert any("snapshots/version=1" in g for g in snapshots.vacuum(spark, feed.root))
    assert spark.read.parquet(f"{feed.root}/snapshots/version={newest - 1}").count() == 1
    assert feed.now() == {"A": ("IN_TRANSIT", "2026-01-04")}


def test_nothing_yet(spark, folder):
    schema = expiry.expiring_state_updates(spark.createDataFrame([], schemas.TRACKING_EVENT)).schema
    assert snapshots.pointer(spark, folder) == (0, -1)
    assert snapshots.read_entities(spark, folder, schema, history=True).collect() == []
    assert snapshots.compact(spark, folder, schema) == 0 and snapshots.vacuum(spark, folder) == []


def test_listener_hears_of_more_batches_than_progress_keeps(spark, rows, folder):
    for k in range(7):
        rows("temperature_c double, is_temp_breach boolean", [(float(k), k % 2 == 0)] * (k + 1)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = spark.readStream.schema("temperature_c double, is_temp_breach boolean").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        with progress.listening(spark) as totals:
            query = jobs.bounded_ingest(transforms.counting(stream, "telemetry"), f"{folder}/out", f"{folder}/checkpoint")
            query.awaitTermination()
            seen = totals.of(query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) < 7 and seen["batches"] == 7
    assert (seen["telemetry.readings"], seen["telemetry.breaches"], seen["rows"]) == (28, 16, 28) and seen[progress.LATENCY] > 0


@pytest.mark.parametrize("seed,places", [(1, 40), (2, 3), (3, 1), (4, 300)])
def test_nearest_place_equals_all_compared(rows, seed, places):
    rnd = random.Random(seed)
    spot = lambda spread: (rnd.randrange(-spread, spread) / 4, rnd.randrange(-2 * spread, 2 * spread) / 4)
    known = [(f"P{k:03}", f"city {k}", *spot(360)) for k in range(places)] + [("P-none", "nowhere", None, 1.0)]
    known += [("Q" + known[0][0], "twin", *known[0][2:])]
    points = [(k, *spot(340)) for k in range(400)] + [(900, None, 1.0), (901, 95.0, 400.0)] + [(k + 1000, *known[0][2:]) for k in range(5)]
    frame = rows("n int, a double, b double", points)
    found = entities.with_nearest(frame, rows("id string, label string, lat double, lon double", known), F.col("a"), F.col("b"), "hub")
    got = {r.n: r.hub and r.hub.id for r in found.collect()}
    assert len(got) == len(points)
    for n, a, b in points:
        options = [(abs(a - x) + abs(b - y), i) for i, _, x, y in known if x is not None] if a is not None else []
        assert got[n] == (min(options)[1] if options else None)


def test_objects_without_plans_or_speed(rows):
    state = "entity_type string, entity_id string, current_location struct<latitude double, longitude double>, status string, speed int, cold_chain_status string, updated_at timestamp"
    at = "2026-01-01 00:00:00"
    frame = rows("i string, s string, v int", [("A", "IN_TRANSIT", 0), ("B", "DELIVERED", 5), ("C", "DELAYED", 60), ("D", "IN_TRANSIT", None)]).selectExpr(
        "'SHIPMENT' AS entity_type", "i AS entity_id", "named_struct('latitude', 1.0D, 'longitude', 0.0D) AS current_location", "s AS status", "v AS speed", "'NORMAL' AS cold_chain_status", f"timestamp '{at}' AS updated_at"
    )
    assert frame.schema.simpleString() == rows(state, []).schema.simpleString()
    plans = rows("entity_id string, destination_id string, carrier string, mode string, promised_at string", [(i, "W1", "K", "Air Freight", "2026-01-02 00:00:00") for i in "ABC"])
    plans = plans.withColumn("promised_at", F.col("promised_at").cast("timestamp"))
    lanes = rows("lane_carrier string, lane_mode string, lane_late double", [("K", "Air Freight", 0.25)])
    hubs = rows("warehouse_id string, city string, latitude double, longitude double", [("W1", "Far", 11.0, 0.0), ("W2", "Near", 1.5, 0.0)])
    got = {r.entity_id: r for r in entities.entity_objects(frame, plans, lanes, hubs).collect()}
    assert {r.current_location.city for r in got.values()} == {"Near"}
    assert str(got["A"].eta) == "2026-01-02 00:00:00" and got["A"].delay_probability == 0.25
    assert str(got["B"].eta) == at and got["B"].delay_probability == 0.0
    # Ten degrees at 60 knots: 1110 km at 111.12 km/h.
    assert str(got["C"].eta) == "2026-01-01 09:59:21" and got["C"].risk_level == "LOW"
    assert got["D"].eta is None and got["D"].delay_probability == 0.0
