"""Risk and emission scores as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions.measures import banded


def risk_level(score: Column) -> Column:
    return banded(score, fixed.RISK_BANDS, fixed.RISK_OTHERWISE)


def composite_risk(dimensions: dict[str, Column] | None = None) -> dict[str, Column]:
    """Weighted score of the six dimensions, its level, and the inputs as a struct.

    Dimensions left out, and NULL inputs, take the fixed default.  Use as
    ``df.withColumns(composite_risk({...}))``.
    """
    given = dimensions or {}
    unknown = set(given) - set(fixed.RISK_WEIGHTS)
    if unknown:
        raise ValueError(f"unknown risk dimensions: {sorted(unknown)}")
    inputs = {
        name: F.coalesce(given[name].cast("double"), F.lit(default)) if name in given else F.lit(default)
        for name, default in fixed.RISK_DEFAULTS.items()
    }
    weighted = reduce(Column.__add__, [inputs[n] * F.lit(w) for n, w in fixed.RISK_WEIGHTS.items()])
    score = F.bround(weighted, 1)
    return {
        "composite_risk_score": score,
        "risk_level": risk_level(score),
        "dimension_breakdown": F.struct(*[v.alias(f"{n}_risk") for n, v in inputs.items()]),
    }


def _first_word(mode: Column) -> Column:
    return F.split_part(F.trim(mode), F.lit(" "), F.lit(1))


def _lookup(key: Column, table: dict) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def carbon_kg(weight_kg: Column, distance_km: Column, mode: Column) -> Column:
    """Tonnes x kilometres x the factor of the mode; NULL for a mode without one."""
    tonnes = weight_kg.cast("double") / F.lit(1000.0)
    return tonnes * distance_km.cast("double") * _lookup(_first_word(mode), fixed.EMISSION_FACTORS)


def mode_code(mode: Column) -> Column:
    return F.coalesce(_lookup(_first_word(mode), fixed.MODE_CODES), F.lit(fixed.UNKNOWN_MODE_CODE))
