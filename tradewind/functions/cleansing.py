"""Column kernels that turn raw text into typed values.

Lenient kernels give NULL for text that does not parse; strict ones let the
ANSI cast raise.  Numbers go through DECIMAL, not DOUBLE: a decimal cast
refuses ``NaN``, ``Infinity`` and suffixed literals such as ``1d``, all of
which a double cast would let through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(28,8)"
# Two digits after the point and all that _WIDE has before it: no readable number is lost.
CENTS = "decimal(22,2)"


def coerce_number(text: Column, dtype: str = _WIDE) -> Column:
    return text.try_cast(dtype)


def coerce_number_default(text: Column, default, dtype: str) -> Column:
    return default_value(coerce_number(text, dtype), F.lit(default).cast(dtype))


def coerce_int_default(text: Column, default: int) -> Column:
    """Whole part of the number as 64 bits, ``default`` where there is none."""
    return F.coalesce(text.try_cast(_WIDE).try_cast("bigint"), F.lit(default).cast("bigint"))


def parse_currency(text: Column, dtype: str = "decimal(12,2)", strict: bool = True) -> Column:
    """Drop ``$`` and ``,`` and read the rest as money; no exchange rate is applied."""
    bare = F.translate(text, "$,", "")
    return bare.cast(dtype) if strict else bare.try_cast(dtype)


def coerce_timestamp(text: Column, *formats: str) -> Column:
    """ISO text, or the first of ``formats`` (Spark's patterns) that reads it; NULL if none does."""
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats]) if formats else F.try_to_timestamp(text)


def default_value(value: Column, default) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def normalize_text(text: Column, case: str | None = None) -> Column:
    """Strip blanks; ``case`` is ``"upper"``, ``"lower"`` or None."""
    bare = F.trim(text)
    if case == "upper":
        return F.upper(bare)
    if case == "lower":
        return F.lower(bare)
    return bare
