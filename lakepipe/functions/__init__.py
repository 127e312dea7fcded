"""Native column functions (no Python UDFs): text, postal codes, dates,
working time and rounding."""

from .dates import (date_attributes, date_key, date_literal, day_end_unix, day_of,
                    day_start_unix, default_window, is_month_end, is_month_start,
                    iso_weekday, minutes_before, ntz_literal, seconds_to_hms,
                    start_of_day_before)
from .numeric import nonzero_or_null, round_decimal, safe_ratio, when_all_positive
from .postal import POSTAL_CODE_PATTERNS, clean_postal_code, normalize_postal_code
from .text import (MISSING_SENTINELS, abbreviate, clean_string, clean_titlecase,
                   last_segment, merge_abbreviations, py_strip)
from .worktime import local_to_utc, working_minutes

__all__ = [
    "MISSING_SENTINELS", "POSTAL_CODE_PATTERNS", "abbreviate", "clean_postal_code",
    "clean_string", "clean_titlecase", "date_attributes", "date_key", "date_literal",
    "day_end_unix", "day_of", "day_start_unix", "default_window", "is_month_end",
    "is_month_start", "iso_weekday", "last_segment", "local_to_utc", "merge_abbreviations",
    "minutes_before", "nonzero_or_null", "normalize_postal_code", "ntz_literal",
    "py_strip", "round_decimal", "safe_ratio", "seconds_to_hms", "start_of_day_before",
    "when_all_positive", "working_minutes",
]
