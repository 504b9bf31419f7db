"""Declarative data-quality rules.

Rules on one table are compiled into one aggregation: every per-row rule is a
count in a single pass without a shuffle.  Uniqueness and references need the
values themselves; both first count rows per value, which is combined on the
map side, so a value held by a third of the rows stays one row per task.

A rule yields its number of violations.  A rule naming a table or column that
does not exist yields an ``ERROR`` row and does not stop the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import fixed_values as fixed
from tradewind.schemas import Contract

PASSED, FAILED, ERROR = "PASSED", "FAILED", "ERROR"

RESULT = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("test_name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("rule_type", T.StringType()),
        T.StructField("checked_rows", T.LongType()),
        T.StructField("violations", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """One check on one table.

    ``kind`` is one of ``not_empty``, ``min_count``, ``not_null``, ``positive``,
    ``non_negative``, ``range``, ``unique``, ``foreign_key`` (a missing value
    violates it) and ``reference`` (a missing value is allowed).
    """

    name: str
    layer: str
    entity: str
    kind: str
    columns: tuple[str, ...] = ()
    description: str = ""
    minimum: float | None = None
    maximum: float | None = None
    ref_entity: str | None = None
    ref_column: str | None = None


# Per-row rules: the condition a violating row meets.

def _number(column: str) -> Column:
    return F.col(column).cast("string").try_cast("double")


def _violates(rule: Rule) -> Column:
    if rule.kind == "not_null":
        return reduce(Column.__or__, [F.col(c).isNull() for c in rule.columns])
    value = _number(rule.columns[0])
    if rule.kind == "positive":
        return value <= 0
    if rule.kind == "non_negative":
        return value < 0
    return ~value.between(rule.minimum, rule.maximum)


PER_ROW = ("not_null", "positive", "non_negative", "range")
ROW_COUNT = ("not_empty", "min_count")
REFERENCES = ("foreign_key", "reference")
PER_VALUE = ("unique", *REFERENCES)


def _measure(rule: Rule) -> Column:
    """Violations of a rule that needs no values, as an aggregate."""
    if rule.kind in ROW_COUNT:
        least = 1 if rule.kind == "not_empty" else int(rule.minimum)
        return F.greatest(F.lit(least) - F.count("*"), F.lit(0))
    return F.count_if(_violates(rule))


def _result_row(rule: Rule, checked: Column, violations: Column) -> Column:
    status = F.when(violations == 0, PASSED).otherwise(FAILED)
    values = [rule.layer, rule.name, rule.description, rule.entity, rule.kind]
    fields = [F.lit(v) for v in values] + [checked.cast("bigint"), violations.cast("bigint"), status, F.lit(None).cast("string")]
    return F.struct(*[v.alias(f.name) for v, f in zip(fields, RESULT.fields, strict=True)])


def _one_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    counts = df.agg(F.count("*").alias("n"), *[_measure(r).alias(f"v{i}") for i, r in enumerate(rules)])
    rows = F.array(*[_result_row(r, F.col("n"), F.col(f"v{i}")) for i, r in enumerate(rules)])
    return counts.select(F.inline(rows))


def _domain(rule: Rule) -> tuple[str, str]:
    """The key that a rule compares values of: the parent's for references, the own one for uniqueness."""
    return (rule.ref_entity, rule.ref_column) if rule.kind in REFERENCES else (rule.entity, rule.columns[0])


def _one_domain(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """All rules on values of one key by one shuffle: rows of parent and children tagged, counted by value and tag.

    Rows of a value are counted before they move, so a hot value sends a row a task, and parent and
    children meet without a join, whichever of them is large.
    """
    columns = list(dict.fromkeys(place for r in rules for place in (_domain(r), (r.entity, r.columns[0]))))
    tagged = [tables[entity].select(F.col(column).alias("value"), F.lit(tag).alias("tag")) for tag, (entity, column) in enumerate(columns)]
    rows = [F.count_if(F.col("tag") == tag).alias(f"rows{tag}") for tag in range(len(columns))]
    values = reduce(DataFrame.union, tagged).groupBy("value").agg(*rows)
    sums, present = [], F.col("value").isNotNull()
    for i, rule in enumerate(rules):
        own, known = (F.col(f"rows{columns.index(place)}") for place in ((rule.entity, rule.columns[0]), _domain(rule)))
        if rule.kind == "unique":
            bad = F.when(present, F.greatest(own - 1, F.lit(0)))
        elif rule.kind == "reference":
            bad = F.when(present & (known == 0), own)
        else:  # a missing value refers to nothing, even if the parent has one
            bad = F.when(~present | (known == 0), own)
        sums += [F.coalesce(F.sum(own), F.lit(0)).alias(f"n{i}"), F.coalesce(F.sum(bad), F.lit(0)).alias(f"v{i}")]
    results = F.array(*[_result_row(r, F.col(f"n{i}"), F.col(f"v{i}")) for i, r in enumerate(rules)])
    return values.agg(*sums).select(F.inline(results))


def _per_value(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def _unique(df: DataFrame, rule: Rule) -> DataFrame:
    values = _per_value(df, rule.columns[0])
    surplus = F.sum(F.when(F.col("value").isNotNull(), F.col("rows") - 1))
    counts = values.agg(F.sum("rows").alias("n"), F.coalesce(surplus, F.lit(0)).alias("v"))
    checked = F.coalesce(F.col("n"), F.lit(0))
    return counts.select(F.inline(F.array(_result_row(rule, checked, F.col("v")))))


def _foreign_key(df: DataFrame, rule: Rule, parent: DataFrame) -> DataFrame:
    """Rows whose value the parent lacks."""
    values = _per_value(df, rule.columns[0])
    known = parent.select(F.col(rule.ref_column).alias("value")).distinct().withColumn("known", F.lit(True))
    unknown = F.col("known").isNull()
    if rule.kind == "reference":
        unknown = unknown & F.col("value").isNotNull()
    orphan = F.sum(F.when(unknown, F.col("rows")))
    counts = values.join(known, "value", "left").agg(
        F.sum("rows").alias("n"), F.coalesce(orphan, F.lit(0)).alias("v")
    )
    checked = F.coalesce(F.col("n"), F.lit(0))
    return counts.select(F.inline(F.array(_result_row(rule, checked, F.col("v")))))


def _bucketed(df: DataFrame, column: str) -> bool:
    """Whether the table's files are divided by some key, so that rows of a value lie together already."""
    return "Bucketed: true" in df.groupBy(column).count()._jdf.queryExecution().executedPlan().toString()


def _by_value(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> list[DataFrame]:
    """Results of all rules on values of one key: by one shuffle, or none of the parent where that is bucketed."""
    entity, column = _domain(rules[0])
    if not _bucketed(tables[entity], column):
        return [_one_domain(tables, rules)]
    return [_unique(tables[entity], r) if r.kind == "unique" else _foreign_key(tables[r.entity], r, tables[entity]) for r in rules]


def _problem(rule: Rule, tables: Mapping[str, DataFrame]) -> str | None:
    if rule.kind not in PER_ROW + ROW_COUNT + PER_VALUE:
        return f"unknown rule type {rule.kind}"
    wanted = [(rule.entity, rule.columns)]
    if rule.kind in REFERENCES:
        wanted.append((rule.ref_entity, (rule.ref_column,)))
    for entity, columns in wanted:
        if entity not in tables:
            return f"no table {entity}"
        missing = [c for c in columns if c not in tables[entity].columns]
        if missing:
            return f"no column {', '.join(missing)} in {entity}"
    return None


def scans(rules: Sequence[Rule]) -> dict[str, list[set[str]]]:
    """Entities in the order the rules name them, and the columns of each scan that ``run_rules`` makes of them."""
    fused: dict[str, set[str]] = {}
    found: dict[str, list[set[str]]] = {}
    by_value: set[tuple] = set()
    for rule in rules:
        if rule.kind not in PER_VALUE:
            if rule.entity not in fused:
                fused[rule.entity] = set()
                found.setdefault(rule.entity, []).append(fused[rule.entity])
            fused[rule.entity].update(rule.columns)
            continue
        for entity, column in dict.fromkeys(((rule.entity, rule.columns[0]), _domain(rule))):
            if (_domain(rule), entity, column) not in by_value:
                by_value.add((_domain(rule), entity, column))
                found.setdefault(entity, []).append({column})
    return found


def run_rules(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule.  ``tables`` maps entity names to frames."""
    problems = {r.name: _problem(r, tables) for r in rules}
    sound = [r for r in rules if problems[r.name] is None]
    parts: list[DataFrame] = []
    fused = [r for r in sound if r.kind not in PER_VALUE]
    for entity in dict.fromkeys(r.entity for r in fused):
        parts.append(_one_pass(tables[entity], [r for r in fused if r.entity == entity]))
    by_value = [r for r in sound if r.kind in PER_VALUE]
    for domain in dict.fromkeys(map(_domain, by_value)):
        parts += _by_value(tables, [r for r in by_value if _domain(r) == domain])
    broken = [
        (r.layer, r.name, r.description, r.entity, r.kind, None, None, ERROR, problems[r.name])
        for r in rules
        if problems[r.name] is not None
    ]
    if broken or not parts:
        parts.append(spark.createDataFrame(broken, RESULT))
    return reduce(DataFrame.unionByName, parts)


def dq_report(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule], executed_at: Column | None = None) -> DataFrame:
    """Rule results, stamped with ``executed_at`` when one is given."""
    results = run_rules(spark, tables, rules)
    return results if executed_at is None else results.withColumn("executed_at", executed_at)


def dq_summary(results: DataFrame) -> DataFrame:
    """One row; a rule that could not run counts as failed."""
    counts = results.agg(
        F.count("*").alias("total_tests"), F.count_if(F.col("status") == PASSED).alias("passed")
    )
    total, passed = F.col("total_tests"), F.col("passed")
    score = F.coalesce(F.bround(passed / F.nullif(total, F.lit(0)) * 100.0, 2), F.lit(0.0))
    return counts.select(total, passed, (total - passed).alias("failed"), score.alias("score_pct"))


class QualityGateError(RuntimeError):
    """The share of passed checks is below the accepted minimum."""


def dq_gate(summary: DataFrame, minimum_pct: float = fixed.QUALITY_GATE_PCT) -> float:
    """The score of a one-row summary; raises when it is below ``minimum_pct``."""
    score = float(summary.select("score_pct").first()[0])
    if score < minimum_pct:
        raise QualityGateError(f"data quality score {score} is below {minimum_pct}")
    return score


def dq_null_rate(df: DataFrame, entity: str) -> DataFrame:
    """Missing values of every column, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(entity).alias("entity"),
                F.lit(c).alias("column_name"),
                F.col("n").alias("checked_rows"),
                (F.col("n") - F.col(f"c{i}")).alias("null_rows"),
                ((F.col("n") - F.col(f"c{i}")) / F.nullif(F.col("n"), F.lit(0))).alias("null_rate"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(rows))


def dq_freshness(df: DataFrame, entity: str, moment: str, as_of: Column, max_age_hours: float) -> DataFrame:
    """Age of the newest row at ``as_of``; an empty table is stale."""
    newest = df.agg(F.max(moment).alias("newest"))
    age = (F.unix_micros(as_of) - F.unix_micros("newest")) / F.lit(3.6e9)
    fresh = F.coalesce(age <= F.lit(max_age_hours), F.lit(False))
    return newest.select(
        F.lit(entity).alias("entity"), "newest", age.alias("age_hours"), F.when(fresh, PASSED).otherwise(FAILED).alias("status")
    )


def contract_rules(contracts: Mapping[str, Contract], layer: str = "silver") -> list[Rule]:
    """The rules a set of table contracts stands for."""
    rules: list[Rule] = []
    for entity, contract in contracts.items():
        def rule(kind: str, column: str, entity=entity, **extra) -> Rule:
            return Rule(f"{entity}_{column}_{kind}", layer, entity, kind, (column,), **extra)

        rules.append(rule("not_null", contract.primary_key))
        rules.append(rule("unique", contract.primary_key))
        rules += [rule("not_null", c) for c in contract.not_null]
        rules += [rule("unique", c) for c in contract.unique]
        rules += [rule("positive", c) for c in contract.positive]
        rules += [rule("non_negative", c) for c in contract.non_negative]
        rules += [
            rule("reference", c, ref_entity=parent, ref_column=column)
            for c, (parent, column) in contract.references.items()
        ]
    return rules


# The ten checks of the standing report, in its order.
STANDING_CHECKS = [
    Rule("bronze_suppliers_not_empty", "bronze", "raw_suppliers", "not_empty", (), "Bronze suppliers raw table must contain rows"),
    Rule("bronze_orders_not_empty", "bronze", "raw_orders", "not_empty", (), "Bronze orders raw table must contain rows"),
    Rule("silver_suppliers_no_null_id", "silver", "suppliers", "not_null", ("supplier_id",), "Silver suppliers supplier_id must not be null"),
    Rule("silver_products_unique_sku", "silver", "products", "unique", ("sku",), "Silver product SKUs must be unique"),
    Rule("silver_orders_positive_quantity", "silver", "orders", "positive", ("quantity",), "Silver order quantity must be greater than zero"),
    Rule("silver_orders_referential_customer", "silver", "orders", "foreign_key", ("customer_id",), "All Silver orders must link to a valid customer", ref_entity="customers", ref_column="customer_id"),
    Rule("silver_shipments_referential_order", "silver", "shipments", "foreign_key", ("order_id",), "All Silver shipments must link to a valid order", ref_entity="orders", ref_column="order_id"),
    Rule("silver_inventory_non_negative", "silver", "inventory", "non_negative", ("quantity_on_hand",), "Silver inventory quantity on hand must be non-negative"),
    Rule("gold_fact_orders_valid_keys", "gold", "fact_orders", "not_null", ("customer_key", "product_key", "supplier_key"), "Gold fact_orders dimension keys must not be null"),
    Rule("gold_dim_date_populated", "gold", "dim_date", "min_count", (), "Gold dim_date dimension must contain at least 1 year of dates", minimum=365),
]

# The thirteen declared rules.  Two of them name key columns the
# facts do not have; they are checked on the columns the facts do have.
DECLARED_RULES = [
    Rule("BR-01", "bronze", "raw_suppliers", "not_null", ("supplier_id", "name")),
    Rule("BR-02", "bronze", "raw_warehouses", "not_null", ("warehouse_id", "code")),
    Rule("BR-03", "bronze", "raw_orders", "not_null", ("order_id", "customer_id", "product_id")),
    Rule("BR-04", "bronze", "raw_iot_sensors", "range", ("temperature_c",), minimum=-50, maximum=100),
    Rule("SR-01", "silver", "suppliers", "unique", ("supplier_id",)),
    Rule("SR-02", "silver", "products", "unique", ("sku",)),
    Rule("SR-03", "silver", "orders", "positive", ("quantity",)),
    Rule("SR-04", "silver", "orders", "foreign_key", ("customer_id",), ref_entity="customers", ref_column="customer_id"),
    Rule("SR-05", "silver", "shipments", "foreign_key", ("order_id",), ref_entity="orders", ref_column="order_id"),
    Rule("SR-06", "silver", "inventory", "non_negative", ("quantity_on_hand",)),
    Rule("GR-01", "gold", "fact_orders", "not_null", ("order_id", "customer_key", "product_key", "supplier_key", "order_date_key")),
    Rule("GR-02", "gold", "fact_shipments", "not_null", ("shipment_id", "order_id", "origin_warehouse_key", "shipped_date_key")),
    Rule("GR-03", "gold", "dim_date", "min_count", (), minimum=365),
]
