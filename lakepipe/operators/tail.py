"""Standard output tail (X8): project → clean strings → fill defaults → cast.

All steps are column expressions on one ``select``; nothing runs until the
caller writes or validates the frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CheckFailed
from ..functions.text import clean_string
from ..schema import OutputSchema


def require_columns(df: DataFrame, columns) -> None:
    """Q3: raise for the first required column the frame lacks (no job runs)."""
    present = set(df.columns)
    for c in columns:
        if c not in present:
            raise CheckFailed("column", c)


def project(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """Keep the schema's columns in schema order; extra columns are dropped."""
    require_columns(df, schema.names)
    return df.select(*[F.col(f"`{n}`") for n in schema.names])


def clean_strings(df: DataFrame, exclude=()) -> DataFrame:
    """T1 over every ``StringType`` column; other types (arrays, numbers,
    dates) pass through untouched."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and f.name not in exclude:
            c = clean_string(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def fill_defaults(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """P10: per-column default for nulls. ``coalesce`` works whatever the
    column type (unlike ``na.fill``, which skips mismatching types)."""
    defaults = schema.defaults
    if not defaults:
        return df
    cols = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in defaults:
            c = F.coalesce(c, F.lit(defaults[name])).alias(name)
        cols.append(c)
    return df.select(*cols)


def cast_to_schema(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """Cast typed columns to their declared type (ANSI: out-of-range raises)."""
    cols = []
    for name in df.columns:
        spec = schema.column(name)
        c = F.col(f"`{name}`")
        if spec.dtype is not None and df.schema[name].dataType != spec.dtype:
            c = c.cast(spec.dtype).alias(name)
        cols.append(c)
    return df.select(*cols)


def _tail_columns(df: DataFrame, schema: OutputSchema, cast: bool) -> list:
    require_columns(df, schema.names)
    types = {f.name: f.dataType for f in df.schema.fields}
    defaults = schema.defaults
    cols = []
    for spec in schema.columns:
        c = F.col(f"`{spec.name}`")
        if isinstance(types[spec.name], T.StringType):
            c = clean_string(c)
        if spec.name in defaults:
            c = F.coalesce(c, F.lit(defaults[spec.name]))
        if cast and spec.dtype is not None and types[spec.name] != spec.dtype:
            c = c.cast(spec.dtype)
        cols.append(c.alias(spec.name))
    return cols


def prepare_output(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """Project, clean and default in one projection (no cast): the frame the
    output checks read."""
    return df.select(*_tail_columns(df, schema, cast=False))


def output_tail(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """Project, clean, default and cast in one projection."""
    return df.select(*_tail_columns(df, schema, cast=True))
