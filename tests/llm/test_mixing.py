"""The mix against its SQL and a plain water-filling."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.llm.conftest import SMALL
from tests.support import difference
from tradewind.llm import mixing


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    return con


def test_query_equals_sql(spark, duck):
    assert difference(entry.queries()["op3_mix"](spark, SMALL), duck, entry.oracle_sql()["op3_mix"]) is None


def test_awkward_rows_equal_sql(awkward, duck):
    duck.register("awkward_rows", awkward.toPandas())
    sql = entry.oracle_sql()["op3_mix"].replace("FROM documents)", "FROM awkward_rows)")
    assert difference(mixing.mix_sources(awkward), duck, sql) is None


def test_targets_and_caps(documents):
    rows = [(s * 1000 + i, " ".join(["w"] * (1 + i % 7)), "en", f"s{s}") for s, n in enumerate((400, 10, 300, 200)) for i in range(n)]
    mixed = mixing.mix_sources(documents(*rows)).collect()
    whole = sum(r.size for r in mixed)
    target = {r.source: r.target for r in mixed}
    size = {r.source: r.source_size for r in mixed}
    assert abs(sum(target.values()) - whole) < 1e-6 and all(target[s] <= 3 * size[s] + 1e-9 for s in size)
    assert target["s1"] == 3 * size["s1"]
    free = [target["s0"] / 5, target["s2"] / 1, target["s3"] / 5]
    assert max(free) - min(free) < 1e-9
    for source in size:
        taken = sum(r.taken for r in mixed if r.source == source)
        assert abs(taken - target[source]) <= 7
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in mixed)


def test_smaller_budgets_are_nested(documents):
    rows = [(i, "a b c", "en", f"s{i % 3}") for i in range(600)]
    small = {r.doc_id: r.taken for r in mixing.mix_sources(documents(*rows), budget=0.3).collect()}
    large = {r.doc_id: r.taken for r in mixing.mix_sources(documents(*rows), budget=0.7).collect()}
    assert all(small[i] <= large[i] for i in small) and sum(small.values()) < sum(large.values())


def test_copies_are_what_the_mix_takes(documents):
    rows = [(i, "a b c", "en", f"s{i % 3}") for i in range(90)]
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix_sources(documents(*rows)).collect()}
    copies = mixing.take_mix(documents(*rows)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {i: n for i, n in taken.items() if n}


def test_empty_table(nothing):
    assert mixing.mix_sources(nothing).collect() == []
    assert mixing.take_mix(nothing).collect() == []


@pytest.mark.parametrize("texts", [1, 40, 600])
def test_rows_without_ids_come_near_the_target(documents, duck, texts):
    """A source of 1,000 rows, 600 of them without an id, of one text, some, or a text each."""
    word = lambda i: " ".join(f"w{i % texts}x{k}" for k in range(20 + i % texts % 5))
    rows = [(None, word(i), "en", "hot") for i in range(600)] + [(i, "a b c d " * 6, "en", "hot") for i in range(400)]
    rows += [(5000 + i, "e f g " * 9, "en", "other") for i in range(500)]
    docs = documents(*rows).repartition(3)
    mixed = mixing.mix_sources(docs)
    for source in ("hot", "other"):
        own = [r for r in mixed.collect() if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
    duck.register("shared_rows", docs.toPandas().astype({"doc_id": "Int64"}))
    sql = entry.oracle_sql()["op3_mix"].replace("FROM documents)", "FROM shared_rows)")
    assert difference(mixed, duck, sql) is None
    copies = mixing.take_mix(docs)
    assert copies.count() == sum(r.taken // r.size for r in mixed.collect())


def test_clashing_columns_keep_their_values(documents):
    rows = [(i, "a b c", "en", f"s{i % 3}") for i in range(60)]
    names = ["_source", "_hash", "_mark", "size", "_row", "_copies", "_rest", "_cell", "_before", "_passes", "_upto", "col"]
    docs = documents(*rows).selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    copies = mixing.take_mix(docs)
    assert copies.columns == docs.columns and copies.exceptAll(docs).distinct().join(docs, docs.columns).count() == copies.exceptAll(docs).distinct().count()
    assert all(r[n] == f"{n}{r.doc_id}" for r in copies.collect() for n in names)
