"""Rounding and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import to_col


def round_decimal(col, scale: int = 2, precision: int | None = None) -> Column:
    """M1: HALF_UP rounding on a DECIMAL value. Doubles are first cast to a
    decimal of the given precision so ties round the same in every engine."""
    c = to_col(col)
    if precision is not None:
        c = c.cast(f"decimal({precision},{max(scale, 6)})")
    return F.round(c, scale)


def safe_ratio(numerator, denominator, scale: int = 2, fill=0) -> Column:
    """Numerator / denominator rounded; a zero denominator gives ``fill``.

    The quotient of two decimals carries at least 6 decimals, but only 6 when
    the operand types are wide (e.g. a sum's decimal(38,s) over a bigint); a
    value just below a tie can then round up twice. Cast the operands to the
    precision they need first so the quotient keeps more digits.
    """
    q = F.try_divide(to_col(numerator), to_col(denominator))
    return F.coalesce(F.round(q, scale), F.lit(fill))


def nonzero_or_null(value, result) -> Column:
    """``result`` when ``value`` is non-zero, else NULL."""
    return F.when(to_col(value) != 0, to_col(result))


def when_all_positive(cols: list, result) -> Column:
    """``result`` only when every column in ``cols`` is > 0, else NULL."""
    cond = None
    for c in cols:
        x = to_col(c) > 0
        cond = x if cond is None else (cond & x)
    return F.when(cond, to_col(result))
