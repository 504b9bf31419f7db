"""Streams over tables that are folders of part files."""

from __future__ import annotations

import tempfile

import pytest

from tradewind.plans.registered_io import STREAMS, iot_records
from tradewind.sources.driver_tables import SCHEMAS, DriverTables
from tradewind.streaming import jobs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark):
    """The tables again, each a folder of three files."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for table in SCHEMAS:
        rows = spark.read.schema(SCHEMAS[table]).parquet(f"{FOLDER}/{table}.parquet")
        rows.repartition(3).write.parquet(f"{root}/{table}.parquet")
    return root


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_reads_all_of_a_folder(spark, parts, name):
    whole, divided = STREAMS[name](spark, FOLDER), STREAMS[name](spark, parts)
    assert whole.count() > 0
    assert whole.exceptAll(divided).isEmpty() and divided.exceptAll(whole).isEmpty()


def test_several_batches_give_the_same_rows(spark, parts):
    class OneByOne(DriverTables):
        def stream(self, table, files_per_batch=1):
            return super().stream(table, files_per_batch)

    def drained(tables):
        return jobs.drained(iot_records(tables).select("key"), "iot-batches")

    assert drained(OneByOne(spark, parts)).exceptAll(drained(DriverTables(spark, FOLDER))).isEmpty()


def test_nothing_is_moved_between_scan_and_parsing(spark, parts):
    plan = DriverTables(spark, parts)["events"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
