"""Turning message text into key numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LIMITS = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1)}


def key_number(text: Column, key_type: str = "int", coercion: str = "strict") -> Column:
    """Number in ``text`` with its fraction cut off (towards zero).

    ``strict`` gives NULL for text, NaN and values outside ``key_type``: a wrapped or
    saturated key would name some other row. ``clamp`` reproduces a JVM narrowing
    conversion: NaN becomes 0 and values outside the range become its nearest end.
    """
    low, high = _LIMITS[key_type]
    number = text.try_cast("double")
    if coercion == "clamp":
        number = F.nanvl(number, F.lit(0.0))
        return (
            F.when(number >= F.lit(float(high)), F.lit(high))
            .when(number <= F.lit(float(low)), F.lit(low))
            .otherwise(number.try_cast(key_type))
            .cast(key_type)
        )
    if coercion != "strict":
        raise ValueError(f"unknown coercion {coercion!r}")
    if key_type == "bigint":
        # Whole numbers beyond 2**53 would lose digits on the way through double.
        return F.coalesce(text.try_cast("bigint"), number.try_cast("bigint"))
    return number.try_cast(key_type)


def zero_if_null(column: Column) -> Column:
    """0 for NULL, as a database driver's primitive getters give."""
    return F.coalesce(column, F.lit(0))
