"""Deduplication, dense keys and ranks, also where one key holds most rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.operators.dedup import dedup_keep_first, latest_per_key, require_key
from tradewind.operators.ordinals import dense_rank_desc, numbered, surrogate_key

FEED = "id string, arrived int, payload string"


def test_first_arrival_wins_and_null_keys_are_one_key(rows):
    feed = rows(FEED, [("a", 2, "late"), ("a", 1, "early"), (None, 5, "x"), (None, 4, "y"), ("b", 1, "only")])
    got = dedup_keep_first(feed, ["id"], ["arrived"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 1, "early"), ("b", 1, "only"), (None, 4, "y")], key=str)


def test_ties_fall_the_same_way_however_rows_are_partitioned(rows):
    data = [("k", 1, str(i)) for i in range(500)] + [(str(i), 1, "x") for i in range(500)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        kept = dedup_keep_first(rows(FEED, data).repartition(seed + 2), ["id"], ["arrived"])
        results.add(tuple(sorted(map(tuple, kept.collect()))))
    assert len(results) == 1
    assert ("k", 1, "0") in results.pop()


def test_dedup_is_idempotent(rows):
    feed = rows(FEED, [("a", i % 3, str(i % 5)) for i in range(30)])
    once = dedup_keep_first(feed, ["id"], ["arrived"])
    assert dedup_keep_first(once, ["id"], ["arrived"]).collect() == once.collect()


def test_hot_key_is_cut_down_before_the_shuffle(rows):
    kept = dedup_keep_first(rows(FEED, [("a", 1, "x")]), ["id"], ["arrived"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_latest_per_key(rows):
    feed = rows(FEED, [("a", 1, "old"), ("a", 3, "new"), ("a", None, "undated"), ("b", 2, "x"), ("b", 2, "y")])
    assert sorted(map(tuple, latest_per_key(feed, ["id"], "arrived").collect())) == [("a", 3, "new"), ("b", 2, "y")]


def test_require_key(rows):
    assert require_key(rows(FEED, [(None, 1, "x"), ("a", None, None)]), "id").count() == 1


@pytest.fixture
def many_tasks(spark):
    """Keep small sorts on several tasks, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbering_spans_tasks(rows, many_tasks):
    frame = rows("n int", [(i,) for i in range(5000)]).repartition(5)
    placed = numbered(frame, F.col("n").desc(), position="at")
    assert len(placed.inputFiles()) == 4
    assert [(r["at"], r.n) for r in placed.orderBy("at").collect()] == [(i + 1, 4999 - i) for i in range(5000)]


def test_ranks_span_tasks(rows, many_tasks):
    data = [("hot", i % 700) for i in range(3000)] + [(f"g{i % 9}", i % 50) for i in range(900)]
    ranked = dense_rank_desc(rows("g string, v int", data).repartition(6), "g", "v", "r")
    assert sorted(((r.g, r.v, r.r) for r in ranked.collect()), key=str) == brute_rank(data)


def test_surrogate_keys_are_dense_in_id_order(rows):
    ids = [f"C-{i}" for i in range(2000)] + ["", "C", "Ä-1", None]
    random.Random(7).shuffle(ids)
    keyed = surrogate_key(rows("id string, n int", [(x, i) for i, x in enumerate(ids)]).repartition(7), "id", "k")
    got = [(r.k, r.id) for r in keyed.orderBy("k").collect()]
    present = sorted((i for i in ids if i is not None), key=lambda t: t.encode())
    assert got == list(enumerate([*present, None], start=1))


def test_surrogate_key_of_nothing(rows):
    assert surrogate_key(rows("id string", []), "id", "k").count() == 0


def brute_rank(data):
    groups = {}
    for g, v in data:
        groups.setdefault(g, set()).add(v)
    order = {g: sorted(vs, key=lambda v: (v is not None, -(v or 0))) for g, vs in groups.items()}
    return sorted(((g, v, order[g].index(v) + 1) for g, v in data), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=40
    )
)
def test_dense_rank_equals_brute_force(rows, data):
    ranked = dense_rank_desc(rows("g string, v int", data), "g", "v", "r")
    assert sorted(((r.g, r.v, r.r) for r in ranked.collect()), key=str) == brute_rank(data)


def test_dense_rank_with_one_hot_group_and_one_hot_value(rows):
    data = [("hot", 7)] * 3000 + [("hot", i) for i in range(3000)] + [(f"g{i % 50}", i) for i in range(3000)]
    ranked = dense_rank_desc(rows("g string, v int", data).repartition(6), "g", "v", "r")
    assert sorted(((r.g, r.v, r.r) for r in ranked.collect()), key=str) == brute_rank(data)
