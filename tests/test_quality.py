import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradewind.operators import quality
from tradewind.operators.quality import Rule
from tradewind.schemas import SILVER_CONTRACTS, Contract


@pytest.fixture
def tables(rows):
    children = [("c1", "p1", "5", 1), ("c2", "p1", "-1", 0), ("c3", "p9", "500", -2), ("c3", None, "x", None), (None, "p2", None, 3)]
    return {
        "parent": rows("id string", [("p1",), ("p2",), ("p2",), (None,)]),
        "child": rows("id string, parent_id string, reading string, quantity int", children),
        "empty": rows("id string", []),
    }


def run(spark, tables, *rules):
    return {r.test_name: (r.checked_rows, r.violations, r.status) for r in quality.run_rules(spark, tables, rules).collect()}


def test_rule_kinds(spark, tables):
    got = run(
        spark,
        tables,
        Rule("filled", "s", "child", "not_empty"),
        Rule("bare", "s", "empty", "not_empty"),
        Rule("many", "s", "child", "min_count", minimum=6),
        Rule("ids", "s", "child", "not_null", ("id", "parent_id")),
        Rule("pos", "s", "child", "positive", ("quantity",)),
        Rule("nonneg", "s", "child", "non_negative", ("quantity",)),
        Rule("range", "s", "child", "range", ("reading",), minimum=-50, maximum=100),
        Rule("unique", "s", "child", "unique", ("id",)),
        Rule("fk", "s", "child", "foreign_key", ("parent_id",), ref_entity="parent", ref_column="id"),
        Rule("ref", "s", "child", "reference", ("parent_id",), ref_entity="parent", ref_column="id"),
        Rule("none", "s", "empty", "unique", ("id",)),
        Rule("nofk", "s", "empty", "foreign_key", ("id",), ref_entity="parent", ref_column="id"),
    )
    assert got == {
        "filled": (5, 0, "PASSED"),
        "bare": (0, 1, "FAILED"),
        "many": (5, 1, "FAILED"),
        "ids": (5, 2, "FAILED"),
        "pos": (5, 2, "FAILED"),
        "nonneg": (5, 1, "FAILED"),
        "range": (5, 1, "FAILED"),
        "unique": (5, 1, "FAILED"),
        "fk": (5, 2, "FAILED"),
        "ref": (5, 1, "FAILED"),
        "none": (0, 0, "PASSED"),
        "nofk": (0, 0, "PASSED"),
    }


def test_rules_that_cannot_run_are_errors_and_count_as_failed(spark, tables):
    rules = [
        Rule("ok", "s", "child", "not_empty"),
        Rule("lost", "s", "nowhere", "not_empty"),
        Rule("column", "s", "child", "not_null", ("missing",)),
        Rule("kind", "s", "child", "prettiness", ("id",)),
    ]
    results = quality.dq_report(spark, tables, rules, F.lit(dt.datetime(2024, 1, 1)))
    errors = {r.test_name: r.error for r in results.collect() if r.status == "ERROR"}
    assert errors == {"lost": "no table nowhere", "column": "no column missing in child", "kind": "unknown rule type prettiness"}
    assert quality.dq_summary(results).collect()[0].asDict() == {"total_tests": 4, "passed": 1, "failed": 3, "score_pct": 25.0}
    assert set(r.executed_at for r in results.collect()) == {dt.datetime(2024, 1, 1)}


def test_summary_of_nothing_scores_zero(spark, tables):
    assert quality.dq_summary(quality.run_rules(spark, tables, [])).first().score_pct == 0.0


def test_gate(spark, rows):
    summary = rows("score_pct double", [(70.0,)])
    assert quality.dq_gate(summary) == 70.0
    with pytest.raises(quality.QualityGateError):
        quality.dq_gate(rows("score_pct double", [(69.99,)]))


def test_row_rules_share_one_pass_without_a_value_shuffle(spark, tables):
    rules = [Rule(f"r{i}", "s", "child", "not_null", (c,)) for i, c in enumerate(["id", "parent_id", "quantity"])]
    plan = quality.run_rules(spark, tables, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
    assert "hashpartitioning" not in plan


def test_null_rate(tables):
    got = {r.column_name: (r.null_rows, r.null_rate) for r in quality.dq_null_rate(tables["child"], "child").collect()}
    assert got == {"id": (1, 0.2), "parent_id": (1, 0.2), "reading": (1, 0.2), "quantity": (1, 0.2)}


def test_freshness(rows):
    feed = rows("at timestamp", [(dt.datetime(2024, 1, 1, 0),), (dt.datetime(2024, 1, 1, 6),)])
    as_of = F.lit(dt.datetime(2024, 1, 1, 12))
    assert quality.dq_freshness(feed, "f", "at", as_of, 6).first().status == "PASSED"
    assert quality.dq_freshness(feed, "f", "at", as_of, 5.9).first().status == "FAILED"
    assert quality.dq_freshness(feed.limit(0), "f", "at", as_of, 6).first().status == "FAILED"


def test_contract_rules():
    rules = quality.contract_rules({"t": Contract("id", not_null=("a",), unique=("a",), references={"p": ("q", "id")})})
    assert [r.name for r in rules] == ["t_id_not_null", "t_id_unique", "t_a_not_null", "t_a_unique", "t_p_reference"]
    assert len(quality.contract_rules(SILVER_CONTRACTS)) == 47


def test_standing_and_declared_rule_counts():
    assert len(quality.STANDING_CHECKS) == 10
    assert len(quality.DECLARED_RULES) == 13
