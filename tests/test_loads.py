"""Tables that grow by loads: keys that stay, first arrivals merged by folder."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tradewind.operators.dedup import FirstArrivals, dedup_keep_first
from tradewind.operators.ordinals import extended_keys
from tradewind.sources.shared import staged

FEED = "id string, arrived int, payload string"


def test_later_loads_keep_keys_and_leave_no_gaps(spark, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        known, before = rows("id string, k bigint", []), {}
        rnd = random.Random(2)
        for load in range(4):
            # A hot range: most new ids begin alike; ids repeat, and one is missing.
            ids = [f"{'hot' if rnd.random() < 0.8 else 'z'}{rnd.randrange(400)}" for _ in range(200)] + [None] * (load % 2 + load // 3)
            known = staged(extended_keys(known, staged(rows("id string", [(i,) for i in ids]), "load"), "id", "k"), "keys")
            found = [(r.id, r.k) for r in known.collect()]
            keys = dict(found)
            assert len(found) == len(keys) and sorted(keys.values()) == list(range(1, len(keys) + 1))
            assert before.items() <= keys.items() and set(ids) <= set(keys)
            fresh = sorted((i for i in keys if i not in before), key=lambda i: (i is None, i))
            assert [keys[i] for i in fresh] == list(range(len(before) + 1, len(keys) + 1))
            before = keys
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def store(spark, rows):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return FirstArrivals(spark, f"{path}/first", rows(FEED, []).schema, ["id"], ["arrived"], 16)


def load(rows, data):
    return staged(rows(FEED, data), "load")


def as_set(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_merged_loads_equal_all_at_once(rows, store):
    rnd = random.Random(5)
    data = [(rnd.choice(["hot", None, *(f"k{i}" for i in range(60))]), rnd.randrange(9), str(rnd.randrange(5))) for _ in range(400)]
    assert store.rows().collect() == []
    for start in (200, 0, 300, 100):
        store.merge(load(rows, data[start : start + 100]))
    assert as_set(store.rows()) == as_set(dedup_keep_first(rows(FEED, data), ["id"], ["arrived"]))
    # A load merged twice changes nothing.
    store.merge(load(rows, data[:100]))
    assert as_set(store.rows()) == as_set(dedup_keep_first(rows(FEED, data), ["id"], ["arrived"]))


def test_a_load_touches_its_own_folders_only(spark, rows, store):
    store.merge(load(rows, [(f"k{i}", 5, "old") for i in range(200)]))
    files = lambda: set(spark.read.parquet(store.path).inputFiles())
    before = files()
    late = load(rows, [("k3", 1, "earlier"), ("new", 9, "x")])
    read = store.touched(late)
    assert 1 <= read.select(F.input_file_name()).distinct().count() <= 2
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_folder" in plan or "PartitionFilters: [isnotnull(key_folder" in plan
    store.merge(late)
    assert len(before - files()) <= 2 and len(files() & before) >= 12
    got = dict((r.id, r.payload) for r in store.rows().collect())
    assert got["k3"] == "earlier" and got["new"] == "x" and len(got) == 201
