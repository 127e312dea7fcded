"""Postal-code cleaning and validation (T4) as one native CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import to_col

# Country code → pattern the cleaned (alphanumeric, upper-case)
# postal code must match; codes of listed countries that do not match become
# null, codes of other countries are kept as cleaned.
POSTAL_CODE_PATTERNS = {
    "CA": r"^[A-Z]\d[A-Z]\d[A-Z]\d$",
    "GB": r"^(GIR0AA|[A-Z]{1,2}\d{1,2}[A-Z]?\d[A-Z]{2})$",
    "US": r"^\d{5}(\d{4})?$",
    "FR": r"^\d{5}$",
    "DE": r"^\d{5}$",
    "ES": r"^\d{5}$",
    "FI": r"^\d{5}$",
    "EE": r"^\d{5}$",
    "SE": r"^\d{5}$",
    "CZ": r"^\d{5}$",
    "PL": r"^\d{5}$",
    "NL": r"^\d{4}[A-Z]{2}$",
    "DK": r"^\d{4}$",
    "AT": r"^\d{4}$",
    "BE": r"^\d{4}$",
    "CH": r"^\d{4}$",
    "NO": r"^\d{4}$",
    "LU": r"^\d{4}$",
    "HU": r"^\d{4}$",
    "IE": r"^[A-Z0-9]{7}$",
    "IT": r"^\d{5}$",
    "MX": r"^\d{5}$",
    "ZA": r"^\d{5}$",
    "MY": r"^\d{5}$",
    "TH": r"^\d{5}$",
    "PT": r"^\d{7}$",
    "AU": r"^\d{4}$",
    "NZ": r"^\d{4}$",
    "PH": r"^\d{4}$",
    "JP": r"^\d{7}$",
    "KR": r"^\d{5}$",
    "SG": r"^\d{6}$",
    "GG": r"^GY\d{1,2}[A-Z]{2}$",
    "JE": r"^JE\d{1,2}[A-Z]{2}$",
    "IM": r"^IM\d{1,2}[A-Z]{2}$",
    "IS": r"^\d{3}$",
}


def countries_by_pattern(patterns: dict[str, str] | None = None) -> dict[str, list[str]]:
    """Group countries sharing a pattern so each regex is evaluated once per row."""
    grouped: dict[str, list[str]] = {}
    for country, pattern in (patterns or POSTAL_CODE_PATTERNS).items():
        grouped.setdefault(pattern, []).append(country)
    return grouped


def normalize_postal_code(code) -> Column:
    """Keep only ASCII letters and digits, upper-cased. Null stays null."""
    return F.upper(F.regexp_replace(to_col(code), "[^0-9A-Za-z]", ""))


def clean_postal_code(code, country, patterns: dict[str, str] | None = None) -> Column:
    cleaned = normalize_postal_code(code)
    ctry = to_col(country)
    invalid = None
    for pattern, countries in countries_by_pattern(patterns).items():
        cond = ctry.isin(countries) & ~F.coalesce(cleaned.rlike(pattern), F.lit(False))
        invalid = cond if invalid is None else (invalid | cond)
    return F.when(invalid, F.lit(None).cast("string")).otherwise(cleaned)
