"""Exact search against all products."""

import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tests.support import difference
from tradewind.llm import vector_search

VECTORS = "vec_id bigint, embedding array<float>, label int, pivot string, rank int"


def plain(rows, every, top):
    whole = {}
    for vec_id, vec in rows:
        if vec_id is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole[vec_id, tuple(math.floor(1024 * float(np.float32(x))) for x in vec)] = None
    out = []
    for query_id in sorted({i for i, _ in whole if i % every == 0}):
        scored = set()
        for q in [v for i, v in whole if i == query_id]:
            scored |= {(-sum(a * b for a, b in zip(q, v)), i) for i, v in whole if i != query_id}
        out += [(query_id, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return out


def found(frame, **options):
    return sorted(map(tuple, vector_search.top_k(frame, **options).collect()))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    assert difference(entry.queries()["op5_top_k"](spark, SMALL), con, entry.oracle_sql()["op5_top_k"]) is None


@pytest.mark.parametrize("block", [7, 1024])
def test_ties_copies_and_many_blocks(rows, monkeypatch, block):
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(300)]
    data += [(1000 + i, [0.5] * 6) for i in range(120)]  # one vector, many times
    frame = rows(VECTORS, [(i, v, 0, "x", 1) for i, v in data])
    assert found(frame, every=20) == plain(data, 20, 10)


def test_awkward_rows(rows):
    data = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 0.0]), (400, [float("inf"), 0.0]),
        (None, [1.0, 1.0]), (1, [1.0]), (2, []), (3, [-1.0, 0.5]), (500, [0.0, 0.0]), (4, [1e6, 1e6]),
    ]
    frame = rows(VECTORS, [(i, v, None, None, None) for i, v in data])
    assert found(frame) == plain(data, 100, 10)


def test_empty_table(rows):
    assert found(rows(VECTORS, [])) == []
