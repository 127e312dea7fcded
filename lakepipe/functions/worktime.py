"""Working minutes between two timestamps (T5) as pure column arithmetic.

Semantics, per pair (start, end) interpreted in time zone ``tz``:

* either side null → null; start after end → 0;
* same local day → elapsed minutes if that day is a working day, else 0;
* otherwise: the rest of the first day (real elapsed time to the next local
  midnight) if it is a working day, plus the elapsed part of the last day if
  it is a working day, plus 1,440 for every working day strictly between;
* the total is truncated to whole minutes.

A working day is a weekday index (Monday = 0) below ``working_days``. Whole
working days are counted in closed form, ``W*floor(n/7) + min(n mod 7, W)``
for ``n`` = days since a Monday, so no per-row loop or calendar table is needed.

Naive input is local wall time. A repeated wall time (clock set back) takes
the first occurrence; a wall time inside a gap (clock set forward) maps to the
first instant after the gap, assuming transitions begin on a whole local hour.
A local midnight that does not exist (zones that change clocks at midnight)
is the transition instant, so the count stays the real elapsed working time;
the data-frame algorithm this mirrors raises an error in that case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import to_col

_UTC = {"UTC", "Etc/UTC", "GMT", "Z"}
_US_PER_MIN = 60_000_000


def local_to_utc(local: Column, tz: str) -> Column:
    """Naive wall time in ``tz`` → naive UTC wall time of the same instant."""
    if tz in _UTC:
        return local
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
    back = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    # Inside a gap the conversion pushes the time later by the gap length;
    # move it back to the transition instant (gap start = whole local hour).
    into_hour = F.timestamp_diff("MICROSECOND", F.date_trunc("hour", local).cast("timestamp_ntz"),
                                 local)
    return F.when(back != local, F.timestamp_add("MICROSECOND", -into_hour, utc)).otherwise(utc)


def _to_local(ts: Column, tz: str, aware: bool) -> Column:
    if not aware:
        return ts.cast("timestamp_ntz")
    # An instant: render its wall time in tz, independent of the session zone.
    return F.convert_timezone(F.current_timezone(), F.lit(tz), ts.cast("timestamp_ntz"))


def _weekdays_before(d: Column, working_days: int) -> Column:
    """Working days from the Monday 1970-01-05 up to (excluding) date d."""
    n = F.unix_date(d).cast("long") - F.lit(4)
    r = F.pmod(n, F.lit(7))
    weeks = ((n - r) / 7).cast("long")
    return weeks * working_days + F.least(r, F.lit(working_days))


def working_minutes(start, end, tz: str = "UTC", working_days: int = 5,
                    aware: bool = False) -> Column:
    ls = _to_local(to_col(start), tz, aware)
    le = _to_local(to_col(end), tz, aware)
    us = local_to_utc(ls, tz)
    ue = local_to_utc(le, tz)
    ds, de = F.to_date(ls), F.to_date(le)
    start_work = F.weekday(ds) < working_days
    end_work = F.weekday(de) < working_days

    elapsed = F.timestamp_diff("MICROSECOND", us, ue)
    next_midnight = local_to_utc(F.date_add(ds, 1).cast("timestamp_ntz"), tz)
    end_midnight = local_to_utc(de.cast("timestamp_ntz"), tz)
    first_part = F.when(start_work, F.timestamp_diff("MICROSECOND", us, next_midnight)).otherwise(0)
    last_part = F.when(end_work, F.timestamp_diff("MICROSECOND", end_midnight, ue)).otherwise(0)
    whole_days = (_weekdays_before(de, working_days) - _weekdays_before(ds, working_days)
                  - F.when(start_work, 1).otherwise(0))
    multi_day = (F.floor((first_part + last_part) / _US_PER_MIN)
                 + F.greatest(whole_days, F.lit(0)) * 1440)
    same_day = F.when(start_work, F.floor(elapsed / _US_PER_MIN)).otherwise(0)

    return (F.when(to_col(start).isNull() | to_col(end).isNull(), F.lit(None))
            .when(us > ue, F.lit(0))
            .when(ds == de, same_day)
            .otherwise(multi_day)).cast("long")
