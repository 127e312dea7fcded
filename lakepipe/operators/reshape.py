"""Reshape operators: unpivot (R1), explode (R3), strict zip (R4), flatten.

All are single-pass, per-row generators or projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CheckFailed


def unpivot(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
            var_name: str = "variable", value_name: str = "value",
            value_type: str | T.DataType | None = None) -> DataFrame:
    """Wide → long. Every non-id column becomes (``var_name``, ``value_name``)
    rows. Value columns must share a type; pass ``value_type`` to cast them."""
    value_cols = value_cols or [c for c in df.columns if c not in id_cols]
    src = df
    if value_type is not None:
        src = df.select(*[F.col(f"`{c}`") for c in id_cols],
                        *[F.col(f"`{c}`").cast(value_type).alias(c) for c in value_cols])
    return src.unpivot([F.col(f"`{c}`") for c in id_cols],
                       [F.col(f"`{c}`") for c in value_cols], var_name, value_name)


def explode_list(df: DataFrame, col: str) -> DataFrame:
    """One row per element, other columns repeated; an empty list gives no row."""
    return df.withColumn(col, F.explode(F.col(f"`{col}`")))


def strict_length(arrays: list[Column], names: list[str]) -> Column:
    """Common length of the non-null arrays. If they differ the query fails on the executor,
    in the words of ``CheckFailed`` and with the length of every list (Q5)."""
    sizes = [F.when(a.isNotNull(), F.size(a)) for a in arrays]
    lo = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    hi = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    each = F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), s.cast("string")) for n, s in zip(names, sizes, strict=True)])
    msg = F.concat(F.lit(f"lists: {CheckFailed.CHECKS['lists']} ("), each, F.lit(")"))
    return F.when(lo.isNotNull() & (lo != hi), F.raise_error(msg).cast("int")).otherwise(lo)


def zip_lists(df: DataFrame, cols: list[str]) -> DataFrame:
    """Positional zip of the list columns present (non-null) in each row.

    Rows with no list keep one row (lists null); lists of unequal length raise;
    equal lengths give one row per position (length 0 → no row).
    """
    arrays = [F.col(f"`{c}`") for c in cols]
    n = strict_length(arrays, cols)
    idx = F.when(n.isNull(), F.array(F.lit(-1))) \
           .when(n == 0, F.array().cast("array<int>")) \
           .otherwise(F.sequence(F.lit(0), n - 1))
    staged = df.select("*", idx.alias("_idx"))
    staged = staged.select(*[F.col(f"`{c}`") for c in df.columns],
                           F.explode_outer("_idx").alias("_pos")).where(F.col("_pos").isNotNull())
    pos = F.col("_pos")
    return staged.select(*[
        F.when(pos >= 0, F.get(F.col(f"`{c}`"), pos)).alias(c) if c in cols else F.col(f"`{c}`")
        for c in df.columns])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs → top-level columns named ``a.b.c``; arrays are kept
    as they are (the walk stops at them), as are scalars. Two fields that get one name are an error."""
    out: list[Column] = []
    names: list[str] = []

    def walk(prefix: list[str], dtype: T.DataType, ref: Column):
        if isinstance(dtype, T.StructType) and len(dtype.fields) > 0:
            for f in dtype.fields:
                walk(prefix + [f.name], f.dataType, ref.getField(f.name))
        else:
            names.append(sep.join(prefix))
            out.append(ref.alias(names[-1]))

    for f in df.schema.fields:
        walk([f.name], f.dataType, F.col(f"`{f.name}`"))
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise CheckFailed("name", twice)
    return df.select(*out)
