"""Identifiers and names."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .temporal import ContractError


def normal_id(c: Column, kind: T.DataType) -> Column:
    """Ids as text, so that numbers and texts compare: numbers as whole numbers, texts trimmed, null as null."""
    if isinstance(kind, T.NumericType):
        return c.cast("bigint").cast("string")
    return F.trim(c.cast("string"))


def normal(df, name: str) -> Column:
    return normal_id(F.col(name), df.schema[name].dataType)


@dataclass(frozen=True)
class TableName:
    schema: str
    table: str

    @classmethod
    def parse(cls, text: str) -> TableName:
        parts = [p.strip() for p in (text or "").strip().split(".")]
        if len(parts) != 2 or not all(parts):
            raise ContractError(f"a table name is schema.table, not {text!r}")
        return cls(*parts)

    def __str__(self) -> str:
        return f"{self.schema}.{self.table}"


def safe_name(text: str) -> str:
    """A name for an index: everything but letters, digits and _ becomes _."""
    return re.sub(r"[^a-zA-Z0-9_]", "_", text)


def all_whole_numbers(c: Column) -> Column:
    """Aggregate: whether all non-null values are written as whole numbers; false if there are none."""
    return F.coalesce(F.bool_and(F.trim(c.cast("string")).rlike("^-?[0-9]+$")), F.lit(False))


def box_text(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.format_string("%.6f,%.6f,%.6f,%.6f", x0, y0, x1, y1)
