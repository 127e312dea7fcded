"""Generated calendar source (S5): every day from start to end inclusive.

Days are generated with ``spark.range`` split over partitions and turned into
dates with ``date_add``, so the rows never pass through one task or the driver.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS_PER_PARTITION = 50_000


def _as_date(v) -> date:
    if isinstance(v, datetime):
        return v.date()
    if isinstance(v, date):
        return v
    return date.fromisoformat(str(v)[:10])


def date_range(spark: SparkSession, start, end, col: str = "date") -> DataFrame:
    s, e = _as_date(start), _as_date(end)
    n = max((e - s).days + 1, 0)
    parts = max(1, -(-n // DAYS_PER_PARTITION))
    return spark.range(0, n, 1, parts).select(
        F.date_add(F.lit(s.isoformat()).cast("date"), F.col("id").cast("int")).alias(col))


def data_date_bounds(frames: list[tuple[DataFrame, str]]) -> tuple[date, date]:
    """Earliest and latest day over timestamp/date columns of several frames.

    One small aggregate per frame (parquet min/max); only two values per frame
    reach the driver.
    """
    lo, hi = None, None
    for df, c in frames:
        row = df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")).first()
        if row["lo"] is not None:
            lo = row["lo"] if lo is None else min(lo, row["lo"])
            hi = row["hi"] if hi is None else max(hi, row["hi"])
    if lo is None:
        raise ValueError("no dates found in the given columns")
    return lo, hi


def date_range_of(spark: SparkSession, frames: list[tuple[DataFrame, str]],
                  col: str = "date") -> DataFrame:
    """Calendar covering every day between the first and last date in the data."""
    lo, hi = data_date_bounds(frames)
    return date_range(spark, lo, hi, col)
