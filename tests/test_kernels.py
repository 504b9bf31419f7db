import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradewind.functions import cleansing as c
from tradewind.functions import measures as m
from tradewind.functions import scoring


def values(rows, texts, expression):
    frame = rows("n int, t string", list(enumerate(texts)))
    return [r[0] for r in frame.orderBy("n").select(expression).collect()]


ODD_NUMBERS = ["12.7", " 5 ", "abc", "", None, "EUR 100", "NaN", "Infinity", "1d", "1e3", "-3"]


def test_coerce_number_gives_null_for_text_that_is_no_number(rows):
    got = values(rows, ODD_NUMBERS, c.coerce_number(F.col("t"), "decimal(10,2)"))
    assert got[:2] == [Decimal("12.70"), Decimal("5.00")]
    assert got[2:9] == [None] * 7
    assert got[9:] == [Decimal("1000.00"), Decimal("-3.00")]


def test_coerce_int_truncates_and_defaults(rows):
    assert values(rows, ODD_NUMBERS, c.coerce_int_default(F.col("t"), 50)) == [12, 5, 50, 50, 50, 50, 50, 50, 50, 1000, -3]


def test_coerce_int_keeps_large_numbers(rows):
    assert values(rows, ["3000000000", "99999999999", "1e25"], c.coerce_int_default(F.col("t"), 1)) == [3000000000, 99999999999, 1]


def test_number_default(rows):
    got = values(rows, ["4.85", "bad", None], c.coerce_number_default(F.col("t"), "4.0", "decimal(3,2)"))
    assert got == [Decimal("4.85"), Decimal("4.00"), Decimal("4.00")]


def test_currency_lenient_and_strict(rows):
    texts = ["$1,250.00", "$350.5", "EUR 100", None]
    assert values(rows, texts, c.parse_currency(F.col("t"), strict=False)) == [Decimal("1250.00"), Decimal("350.50"), None, None]
    with pytest.raises(PySparkException):
        values(rows, texts, c.parse_currency(F.col("t")))


def test_timestamp(rows):
    texts = ["2024-01-02T03:04:05.678901", "2024-01-02", "unknown", "", None]
    assert values(rows, texts, c.coerce_timestamp(F.col("t"))) == [
        dt.datetime(2024, 1, 2, 3, 4, 5, 678901),
        dt.datetime(2024, 1, 2),
        None,
        None,
        None,
    ]


def test_normalize_text(rows):
    assert values(rows, ["  aB "], c.normalize_text(F.col("t"), "upper")) == ["AB"]
    assert values(rows, ["  aB "], c.normalize_text(F.col("t"), "lower")) == ["ab"]
    assert values(rows, ["  aB "], c.normalize_text(F.col("t"))) == ["aB"]


@pytest.fixture
def late(rows):
    due = dt.datetime(2024, 1, 1, 12)
    minutes = [0, 40, 60, 61, 150, -30, None]
    data = [(i, due, None if x is None else due + dt.timedelta(minutes=x)) for i, x in enumerate(minutes)]
    return rows("n int, due timestamp, done timestamp", data).orderBy("n")


def test_whole_hours_late(late):
    got = late.select(m.whole_hours_late(F.col("done"), F.col("due"))).collect()
    assert [r[0] for r in got] == [0, 0, 1, 1, 2, 0, 0]


def test_fractional_hours_and_flag(late):
    got = late.select(m.hours_late(F.col("done"), F.col("due")), m.is_late(F.col("done"), F.col("due"))).collect()
    assert [round(r[0], 4) for r in got] == [0, 0.6667, 1, 1.0167, 2.5, 0, 0]
    assert [r[1] for r in got] == [False, True, True, True, True, False, False]


def test_date_key_default_and_null(late):
    row = late.select(m.date_key(F.col("done")), m.date_key(F.col("done"), None)).collect()
    assert (row[0][0], row[6][0], row[6][1]) == (20240101, 20260101, None)


def test_limit_is_exclusive_and_null_is_no_breach(rows):
    frame = rows("n int, t double", [(0, 8.0), (1, 8.01), (2, None)]).orderBy("n")
    assert [r[0] for r in frame.select(m.exceeds(F.col("t"), 8.0)).collect()] == [False, True, False]


def test_pct_rounds_half_away_from_zero_and_guards_zero(rows):
    frame = rows("n int, a bigint, b bigint", [(0, 1, 3), (1, 1, 800), (2, 5, 0), (3, 2, 3), (4, 10**12, 3 * 10**12)])
    got = [r[0] for r in frame.orderBy("n").select(m.pct(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("33.33"), Decimal("0.13"), None, Decimal("66.67"), Decimal("33.33")]


def test_pct_half_even(rows):
    frame = rows("n int, a bigint, b bigint", [(0, 1, 400), (1, 3, 400), (2, 5, 0)])
    assert [r[0] for r in frame.orderBy("n").select(m.pct_half_even(F.col("a"), F.col("b"))).collect()] == [0.2, 0.8, 0.0]


def test_risk_bands_are_exclusive(rows):
    frame = rows("n int, s double", [(0, 30.0), (1, 30.1), (2, 60.0), (3, 60.1), (4, 80.0), (5, 80.1)])
    got = [r[0] for r in frame.orderBy("n").select(scoring.risk_level(F.col("s"))).collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_composite_risk_defaults_and_given(rows):
    frame = rows("s double, t double, w double", [(65.0, 75.0, 80.0), (None, None, None)])
    scored = frame.withColumns(
        scoring.composite_risk({"supplier": F.col("s"), "transportation": F.col("t"), "weather": F.col("w")})
    ).collect()
    assert [(r.composite_risk_score, r.risk_level) for r in scored] == [(48.2, "MEDIUM"), (25.8, "LOW")]
    assert scored[1].dimension_breakdown.asDict() == {
        "supplier_risk": 25.0,
        "transportation_risk": 40.0,
        "weather_risk": 30.0,
        "inventory_risk": 20.0,
        "geopolitical_risk": 15.0,
        "demand_risk": 20.0,
    }


def test_composite_risk_refuses_unknown_dimension():
    with pytest.raises(ValueError):
        scoring.composite_risk({"lunar": F.lit(1)})


def test_carbon_and_mode_code(rows):
    frame = rows("n int, mode string", [(0, "Air Freight"), (1, "Sea Freight"), (2, "Road Truckload"), (3, "Rail Express"), (4, "Drone")])
    got = frame.orderBy("n").select(
        scoring.carbon_kg(F.lit(2000), F.lit(100), F.col("mode")), scoring.mode_code(F.col("mode"))
    ).collect()
    assert [r[0] if r[0] is None else round(r[0], 6) for r in got] == [100.0, 3.0, 21.0, 5.6, None]
    assert [r[1] for r in got] == [0, 2, 1, 3, 2]
