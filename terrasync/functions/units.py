"""Exact conversion of areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .temporal import ContractError

#: Square metres of each unit.
SQUARE_METRES = {"m²": "1", "m2": "1", "km²": "1000000", "km2": "1000000", "ha": "10000", "ft²": "0.09290304", "ft2": "0.09290304"}
SCALE = 3


def unit_factor(unit: str | None) -> str:
    name = (unit or "").strip() or "m²"
    if name not in SQUARE_METRES:
        raise ContractError(f"unknown unit of area {unit!r}; known are {', '.join(SQUARE_METRES)}")
    return SQUARE_METRES[name]


def as_decimal(c: Column) -> Column:
    """A double as the decimal of its shortest text, not of its binary value; null as 0."""
    return F.coalesce(c.cast("string").cast("decimal(38,12)"), F.lit(0).cast("decimal(38,12)"))


def area_in(square_metres: Column, unit: str | None) -> Column:
    """decimal(18,3), rounded once, half up; null as 0. Up to a million times the Earth's surface."""
    factor = unit_factor(unit)
    d = as_decimal(square_metres).cast("decimal(30,12)")
    if factor == "1":
        out = d
    elif "." in factor:
        out = d / F.lit(factor).cast("decimal(9,8)")
    else:  # by the exact reciprocal, so no digit is lost before the rounding
        digits = len(factor) - 1
        out = d * F.lit("0." + "0" * (digits - 1) + "1").cast(f"decimal({digits + 1},{digits})")
    return F.round(out, SCALE).cast("decimal(18,3)")
