"""Declarative output schema: columns, types, defaults, primary key, not-null, ranges.

An ``OutputSchema`` is declared once per job and drives the standard output
tail (project → clean → default → cast) and the output checks (key,
not-null, range). Types are optional, as for flat-file exports.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

from pyspark.sql import types as T


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType | None = None
    default: Any = None
    primary_key: bool = False
    nullable: bool = True
    min_value: Any = None
    max_value: Any = None
    max_length: int | None = None

    @property
    def required(self) -> bool:
        """Key columns never take nulls, whatever ``nullable`` says."""
        return self.primary_key or not self.nullable

    @property
    def has_range(self) -> bool:
        return (self.min_value is not None or self.max_value is not None
                or self.max_length is not None)


@dataclass
class OutputSchema:
    name: str
    columns: list[ColumnSpec] = field(default_factory=list)

    def __init__(self, name: str, *columns: ColumnSpec):
        self.name = name
        wrong = [type(c).__name__ for c in columns if not isinstance(c, ColumnSpec)]
        if wrong:
            raise TypeError(f"schema {name}: columns are declared as ColumnSpec, not {', '.join(wrong)}")
        self.columns = list(columns)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def defaults(self) -> dict[str, Any]:
        return {c.name: c.default for c in self.columns if c.default is not None}

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.primary_key]

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def ranged(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.has_range]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def struct_type(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, c.dtype or T.StringType(), not c.required) for c in self.columns
        ])


# Declared database types → Spark type + implied range (rule Q13).
def unsigned_int(name: str, **kw) -> ColumnSpec:
    return ColumnSpec(name, T.LongType(), min_value=0, max_value=4294967295, **kw)


def unsigned_smallint(name: str, **kw) -> ColumnSpec:
    return ColumnSpec(name, T.IntegerType(), min_value=0, max_value=65535, **kw)


def unsigned_tinyint(name: str, **kw) -> ColumnSpec:
    return ColumnSpec(name, T.ShortType(), min_value=0, max_value=255, **kw)


def unsigned_decimal(name: str, precision: int, scale: int, **kw) -> ColumnSpec:
    return ColumnSpec(name, T.DecimalType(precision, scale), min_value=Decimal(0), **kw)


def varchar(name: str, length: int = 255, **kw) -> ColumnSpec:
    return ColumnSpec(name, T.StringType(), max_length=length, **kw)
