"""Data-quality checks (Q1–Q15).

Each check returns a *violations DataFrame* (lazy, distributed) so it can be
inspected, joined or written; ``enforce_*`` helpers turn a non-empty result
into the matching domain error. Column-wise checks are folded into a single
aggregate pass; key checks are one grouped aggregate with map-side combine.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CheckFailed
from ..schema import ColumnSpec, OutputSchema
from .tail import require_columns


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# ---------------------------------------------------------------- Q1 keys
def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups that occur more than once (null keys compare equal)."""
    return (df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


# ------------------------------------------------- Q2, Q7, Q13 column pass
def _stack(df_one_row: DataFrame, names: list[str], value_cols: dict[str, list[str]]) -> DataFrame:
    """Turn one aggregate row with columns ``<metric>__<i>`` into one row per column."""
    rows = []
    for i, n in enumerate(names):
        rows.append(F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("position"),
                             *[F.col(f"{m}__{i}").alias(m) for m in value_cols]))
    return df_one_row.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One pass: per column its null count and non-null count (Q2, Q7)."""
    columns = columns if columns is not None else df.columns
    require_columns(df, columns)
    aggs = []
    for i, c in enumerate(columns):
        aggs.append(F.count_if(_c(c).isNull()).alias(f"null_count__{i}"))
        aggs.append(F.count(_c(c)).alias(f"non_null__{i}"))
    return _stack(df.agg(*aggs), columns, {"null_count": [], "non_null": []})


def null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2: not-null columns that contain nulls, in column order."""
    return null_counts(df, columns).where(F.col("null_count") > 0).drop("non_null")


def all_null_columns(df: DataFrame) -> DataFrame:
    """Q7: columns that hold no value at all."""
    return null_counts(df).where(F.col("non_null") == 0).select("column_name", "position")


def _decimal_bound(dt: T.DecimalType) -> Decimal:
    return Decimal(10) ** (dt.precision - dt.scale) - Decimal(10) ** (-dt.scale)


def _range_condition(spec: ColumnSpec) -> Column | None:
    c = _c(spec.name)
    conds = []
    lo, hi = spec.min_value, spec.max_value
    if isinstance(spec.dtype, T.DecimalType):
        bound = _decimal_bound(spec.dtype)
        hi = bound if hi is None else min(hi, bound)
        lo = -bound if lo is None else max(lo, -bound)
    if lo is not None:
        conds.append(c < F.lit(lo))
    if hi is not None:
        conds.append(c > F.lit(hi))
    if spec.max_length is not None:
        conds.append(F.char_length(c.cast("string")) > spec.max_length)
    if not conds:
        return None
    out = conds[0]
    for x in conds[1:]:
        out = out | x
    return out


def range_violations(df: DataFrame, schema: OutputSchema) -> DataFrame:
    """Q13: per column, values outside the declared range/precision/length."""
    specs = [s for s in schema.columns
             if s.has_range or isinstance(s.dtype, T.DecimalType)]
    specs = [s for s in specs if _range_condition(s) is not None]
    if not specs:
        return df.sparkSession.createDataFrame(
            [], "column_name string, position int, out_of_range bigint")
    names = [s.name for s in specs]
    aggs = [F.count_if(F.coalesce(_range_condition(s), F.lit(False))).alias(f"out_of_range__{i}")
            for i, s in enumerate(specs)]
    return (_stack(df.agg(*aggs), names, {"out_of_range": []})
            .where(F.col("out_of_range") > 0))


def output_metrics(schema: OutputSchema) -> dict[str, Column]:
    """All column checks of an output as aggregates of one pass, to be observed while it is written:
    ``rows``, values per column (``v<i>``), nulls in not-null columns (``n<i>``), values out of range (``r<i>``)."""
    out = {"rows": F.count(F.lit(1))}
    for i, s in enumerate(schema.columns):
        out[f"v{i}"] = F.count(_c(s.name))
        if s.name in schema.not_null:
            out[f"n{i}"] = F.count_if(_c(s.name).isNull())
        cond = _range_condition(s) if (s.has_range or isinstance(s.dtype, T.DecimalType)) else None
        if cond is not None:
            out[f"r{i}"] = F.count_if(F.coalesce(cond, F.lit(False)))
    return out


def enforce_keys(df: DataFrame, schema: OutputSchema) -> None:
    """Fail the check ``key`` with one of the repeated keys."""
    if schema.primary_key:
        for dup in pk_violations(df, schema.primary_key).limit(1).collect():
            raise CheckFailed("key", schema.primary_key, example=tuple(dup)[:-1])


def enforce_metrics(metrics: dict[str, int], schema: OutputSchema) -> None:
    """Fail the first violation in ``output_metrics``: not-null in column order, then range."""
    place = {s.name: i for i, s in enumerate(schema.columns)}
    for check, kind, names in (("not_null", "n", schema.not_null), ("range", "r", schema.names)):
        for name in names:
            if rows := metrics.get(f"{kind}{place[name]}"):
                raise CheckFailed(check, name, rows=rows)


def enforce_output(df: DataFrame, schema: OutputSchema) -> None:
    """Raise the first violation: key first, then not-null (column order), then range."""
    enforce_keys(df, schema)
    enforce_metrics(df.agg(*[c.alias(k) for k, c in output_metrics(schema).items()]).first().asDict(), schema)


# ------------------------------------------------------------ Q3, Q4, Q5
def missing_columns(df: DataFrame, required) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def _type_ok(c: Column, dtype: T.DataType, source: T.DataType) -> Column:
    """True when a non-null value conforms to ``dtype``.

    String input (raw JSON/CSV text) must parse as the type; typed input
    conforms when the types are compatible. Booleans count as integers, as
    Python's ``isinstance(True, int)`` does.
    """
    if isinstance(source, T.StringType):
        if isinstance(dtype, T.StringType):
            return F.lit(True)
        return c.try_cast(dtype).isNotNull()
    if type(source) is type(dtype):
        return F.lit(True)
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(dtype, integral) and isinstance(source, (*integral, T.BooleanType)):
        return F.lit(True)
    if isinstance(dtype, (T.DoubleType, T.FloatType)) and isinstance(source, (T.DoubleType, T.FloatType)):
        return F.lit(True)
    return F.lit(False)


# Python types accepted in a validation schema, as the Spark type they stand for.
PYTHON_TYPES = {int: T.LongType(), float: T.DoubleType(), str: T.StringType(),
                bool: T.BooleanType()}


def as_spark_type(t):
    if t is None or isinstance(t, T.DataType):
        return t
    if t in PYTHON_TYPES:
        return PYTHON_TYPES[t]
    raise TypeError(f"unsupported expected type: {t!r}")


def type_mismatches(df: DataFrame, expected: dict) -> DataFrame:
    """Q3 + Q4: per expected column, how many non-null values do not conform.

    ``expected`` maps a column to a Spark type or a Python type (``int``,
    ``float``, ``str``, ``bool``), or to ``None`` for a presence check only.
    A missing column fails the check ``column``.
    """
    require_columns(df, list(expected))
    expected = {c: as_spark_type(t) for c, t in expected.items()}
    typed = [(c, t) for c, t in expected.items() if t is not None]
    if not typed:
        return df.sparkSession.createDataFrame([], "column_name string, position int, mismatches bigint")
    aggs = []
    for i, (c, t) in enumerate(typed):
        ok = _type_ok(_c(c), t, df.schema[c].dataType)
        aggs.append(F.count_if(_c(c).isNotNull() & ~ok).alias(f"mismatches__{i}"))
    return _stack(df.agg(*aggs), [c for c, _ in typed], {"mismatches": []})


def enforce_types(df: DataFrame, expected: dict) -> None:
    """Fail the check ``type`` for the first column (in order) with a mismatch."""
    for row in type_mismatches(df, expected).where("mismatches > 0").orderBy("position").limit(1).collect():
        raise CheckFailed("type", row["column_name"], declared=expected[row["column_name"]],
                          rows=row["mismatches"])


# ---------------------------------------------------------- Q9 completeness
def daily_completeness(df: DataFrame, ts_col: str, calendar: DataFrame,
                       calendar_col: str = "date") -> DataFrame:
    """Q9: calendar days with no row in ``df`` (left anti join on the day).

    The table side is reduced to its distinct days first (map-side partial
    aggregation), so the join input is bounded by the number of days.
    """
    days = df.select(F.to_date(_c(ts_col)).alias("_day")).distinct()
    return (calendar.select(F.col(calendar_col).alias("missing_date"))
            .join(days, F.col("missing_date") == F.col("_day"), "left_anti"))


def enforce_daily_completeness(df, ts_col, calendar, table_name: str) -> None:
    for row in daily_completeness(df, ts_col, calendar).orderBy("missing_date").limit(1).collect():
        raise CheckFailed("daily_rows", table_name, day=row["missing_date"])


# --------------------------------------------------------- Q10 empty table
def enforce_not_empty(df: DataFrame, table_name: str, reason: str | None = None) -> None:
    if df.isEmpty():
        raise CheckFailed("rows", table_name, **({"reason": reason} if reason else {}))


# --------------------------------------------------------- Q11 zero sums
def zero_sum_days(df: DataFrame, ts_col: str, value_cols: list[str]) -> DataFrame:
    """Q11: per day, the value columns whose sum is 0 (days with none are dropped)."""
    sums = df.groupBy(F.to_date(_c(ts_col)).alias("date")).agg(
        *[F.sum(_c(c)).alias(f"_s{i}") for i, c in enumerate(value_cols)])
    flagged = F.array_compact(F.array(*[
        F.when(F.col(f"_s{i}") == 0, F.lit(c)) for i, c in enumerate(value_cols)]))
    return (sums.select("date", flagged.alias("zero_sum_columns"))
            .where(F.size("zero_sum_columns") > 0))


def enforce_no_zero_sums(df, ts_col, value_cols) -> None:
    for row in zero_sum_days(df, ts_col, value_cols).orderBy("date").limit(1).collect():
        raise CheckFailed("zero_sum", row["date"], columns=list(row["zero_sum_columns"]))


# ------------------------------------------------------- Q12 allowed values
def invalid_options(df: DataFrame, col: str, options: list) -> DataFrame:
    """Q12: values outside ``options`` with their row counts (nulls are not checked)."""
    return (df.where(_c(col).isNotNull() & ~_c(col).isin(options))
            .groupBy(_c(col).alias("value")).agg(F.count(F.lit(1)).alias("n")))


def check_parameter(name: str, value, options: list) -> None:
    """Q12 for a job argument (driver side, no job)."""
    if value not in options:
        raise CheckFailed("option", name, value=value, options=options)


# ---------------------------------------------------- Q14 size, Q15 names
def enforce_size(actual_bytes: int, limit_bytes: int) -> None:
    if actual_bytes > limit_bytes:
        raise CheckFailed("size", "export", bytes=actual_bytes, limit=limit_bytes)


# Fixed value: the characters of a table name.
_TABLE_NAME = re.compile(r"^[a-zA-Z0-9_]+$")


def validate_table_name(name: str) -> str:
    if not _TABLE_NAME.match(name or ""):
        raise CheckFailed("table_name", repr(name))
    return name


__all__ = [
    "all_null_columns", "check_parameter", "daily_completeness",
    "enforce_daily_completeness", "enforce_no_zero_sums", "enforce_not_empty",
    "enforce_keys", "enforce_metrics", "enforce_output", "enforce_size", "enforce_types", "invalid_options", "missing_columns",
    "null_counts", "null_violations", "output_metrics", "pk_violations", "range_violations", "type_mismatches",
    "validate_table_name", "zero_sum_days",
]
