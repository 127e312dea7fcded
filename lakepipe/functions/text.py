"""Text column functions, all native Spark expressions (stay in codegen, no UDF).

* ``py_strip``      – strip every whitespace character Python's ``str.strip`` strips
* ``clean_string``  – strip, then null the fixed "missing" sentinels (T1)
* ``abbreviate``    – whole-word, single-pass dictionary replacement (T2)
* ``clean_titlecase`` – character whitelist + per-hyphen-part title case (T3)
* ``last_segment``  – text after the last separator (T6)
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import to_col

# Strings that mean "missing" after stripping, in this order.
MISSING_SENTINELS = ["None", "NONE", "nan", "NaN", "<NA>", "null", "NULL", ""]

# The characters Python's str.strip() removes, derived by rule (all of them
# lie below U+3001): Unicode White_Space plus the separators \x1c-\x1f.
PY_WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Fixed value: characters kept by the title-case cleaner (Latin-1 letters,
# digits, hyphen, apostrophe, dot, slash, space); everything else is removed.
TITLECASE_KEEP_CLASS = "a-zA-ZÀ-ÖØ-öø-ÿ0-9\\-\\'\\./ "

# Fixed value: the one kept letter whose title case is two letters ("ß" → "Ss");
# every other kept letter title-cases to its upper case.
TITLECASE_SPECIAL = {"ß": "Ss"}


def py_strip(col) -> Column:
    """Remove leading/trailing whitespace exactly like Python ``str.strip()``
    (a character-set trim, no regular expression)."""
    return F.btrim(to_col(col), F.lit(PY_WHITESPACE))


def clean_string(col) -> Column:
    """Strip, then turn the missing-value sentinels into SQL NULL (case-sensitive)."""
    s = py_strip(col)
    return F.when(s.isin(MISSING_SENTINELS), F.lit(None).cast("string")).otherwise(s)


def _quote(key: str) -> str:
    # \Q..\E quoting; a literal \E inside the key must be split out of the quote.
    return "\\Q" + key.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def merge_abbreviations(dicts: Iterable[Mapping[str, str]]) -> dict[str, str]:
    merged: dict[str, str] = {}
    for d in dicts:
        merged.update(d)
    return merged


def abbreviate(col, abbreviation_dicts: Iterable[Mapping[str, str]]) -> Column:
    """Replace whole words by their abbreviation in one pass.

    Dictionaries are merged (later wins, first insertion position kept); the
    alternation tries keys in that order at each position, so the first listed
    key wins; replaced text is never re-scanned. Null → "" and the result is
    stripped. Implemented as split-by-pattern + extract-all-matches + map
    lookup, interleaved back together, so it stays a native expression.
    """
    merged = merge_abbreviations(abbreviation_dicts)
    s = F.coalesce(to_col(col), F.lit(""))
    if not merged:
        return py_strip(s)
    pattern = "(?U)\\b(" + "|".join(_quote(k) for k in merged) + ")\\b"
    lookup = F.create_map(*[x for k, v in merged.items() for x in (F.lit(k), F.lit(v))])
    pieces = F.split(s, pattern, -1)
    found = F.regexp_extract_all(s, F.lit(pattern), 1)
    repl = F.transform(found, lambda m: F.element_at(lookup, m))
    repl = F.concat(repl, F.array(F.lit("")))
    joined = F.array_join(F.zip_with(pieces, repl, lambda p, r: F.concat(p, r)), "")
    return py_strip(joined)


def clean_titlecase(col) -> Column:
    """Null → "", strip, drop characters outside the whitelist, split on spaces;
    per hyphen part keep an all-caps part longer than one character, else
    capitalise it (title-case first character, rest lower); re-join with single
    spaces.

    Words are cut at the spaces once, and only those with a hyphen into parts. No kept letter but "ß" changes its
    length in upper case, so only texts with it look for special first letters.
    """
    s = py_strip(F.coalesce(to_col(col), F.lit("")))
    s = F.regexp_replace(s, f"[^{TITLECASE_KEEP_CLASS}]+", "")
    s = F.btrim(F.regexp_replace(s, " {2,}", " "), F.lit(" "))

    def plain(p: Column) -> Column:
        return F.upper(F.substring(p, 1, 1))

    def special(p: Column) -> Column:
        title = plain(p)
        for k, v in TITLECASE_SPECIAL.items():
            title = F.when(F.startswith(p, F.lit(k)), F.lit(v)).otherwise(title)
        return title

    def fixed(text: Column, first) -> Column:
        def part(p: Column) -> Column:
            return F.when(F.upper(p) == p, p).otherwise(F.concat(first(p), F.lower(F.substring(p, 2, 2147483647))))

        def word(w: Column) -> Column:
            return F.when(F.contains(w, F.lit("-")), F.array_join(F.transform(F.split(w, "-"), part), "-")).otherwise(part(w))

        return F.array_join(F.transform(F.split(text, " "), word), " ")

    def of_text(text: Column) -> Column:
        odd = F.lit(False)
        for k in TITLECASE_SPECIAL:
            odd = odd | F.contains(text, F.lit(k))
        return F.when(odd, fixed(text, special)).otherwise(fixed(text, plain))

    # inside the lambda the cleaned text is computed once
    return F.element_at(F.transform(F.array(s), of_text), 1)


def last_segment(col, sep: str = ".") -> Column:
    """Text after the last ``sep`` (whole string when absent)."""
    return F.substring_index(to_col(col), sep, -1)
