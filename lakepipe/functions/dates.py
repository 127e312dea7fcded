"""Calendar attributes and relative-time helpers (D1–D11), native expressions only.

Every function here is independent of the session time zone: dates are
handled as ``DATE``/``unix_date`` and naive timestamps as ``TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import to_col


def ntz_literal(value: datetime | date | str) -> Column:
    """A ``TIMESTAMP_NTZ`` literal (job time is injected, never ``now()``)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def date_literal(value: date | datetime | str) -> Column:
    if isinstance(value, datetime):
        value = value.date()
    if isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def day_of(col) -> Column:
    """The calendar date of a timestamp."""
    return F.to_date(to_col(col))


def date_key(col) -> Column:
    """``YYYYMMDD`` as an int."""
    d = to_col(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(col) -> Column:
    """1 = Monday … 7 = Sunday (Spark's ``dayofweek`` is Sunday-based)."""
    return (F.weekday(to_col(col)) + 1).cast("int")


def is_month_start(col) -> Column:
    return (F.dayofmonth(to_col(col)) == 1).cast("int")


def is_month_end(col) -> Column:
    d = to_col(col)
    return (d == F.last_day(d)).cast("int")


def day_start_unix(col) -> Column:
    """UTC epoch second of the day's start."""
    return F.unix_date(to_col(col)).cast("long") * F.lit(86400)


def day_end_unix(col) -> Column:
    return day_start_unix(col) + F.lit(86399)


def date_attributes(col) -> dict[str, Column]:
    """D2–D8 for a DATE column, keyed by the date-dimension column names."""
    d = to_col(col)
    return {
        "id": date_key(d),
        "date": d,
        "day_num": F.dayofmonth(d),
        "week_day_name": F.date_format(d, "EEEE"),
        "week_day_num": iso_weekday(d),
        "month_num": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "is_month_start": is_month_start(d),
        "is_month_end": is_month_end(d),
        "quarter_num": F.quarter(d),
        "year": F.year(d),
        "week_num": F.weekofyear(d),
        "start_unix": day_start_unix(d),
        "end_unix": day_end_unix(d),
    }


def minutes_before(ts, minutes: int) -> Column:
    """``ts - INTERVAL n MINUTES``."""
    return F.timestamp_add("MINUTE", F.lit(-int(minutes)), to_col(ts))


def start_of_day_before(as_of: datetime, days: int = 1) -> Column:
    """Start of the day ``days`` before ``as_of`` (``CURDATE() - INTERVAL 24 HOUR``)."""
    return ntz_literal((as_of.date() - timedelta(days=days)))


def seconds_to_hms(col) -> Column:
    """Seconds → ``HH:MM:SS`` (hours may exceed 24; negative gets a '-')."""
    s = to_col(col).cast("long")
    a = F.abs(s)
    body = F.format_string("%02d:%02d:%02d", (a / 3600).cast("long"),
                           ((a % 3600) / 60).cast("long"), a % 60)
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(s < 0, F.concat(F.lit("-"), body)).otherwise(body))


def default_window(as_of: date | datetime, days: int = 7) -> tuple[str, str]:
    """(as_of - days, as_of) as ISO dates, evaluated when the job starts."""
    d = as_of.date() if isinstance(as_of, datetime) else as_of
    return (d - timedelta(days=days)).isoformat(), d.isoformat()
