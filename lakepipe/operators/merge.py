"""Null-safe merge of two frames on key columns.

Matches the data-frame ``merge`` semantics the jobs rely on: null keys match
each other, key columns are returned once (coalesced for outer joins), and
non-key columns present on both sides get suffixes. The join condition is an
AND of ``<=>`` predicates, which Spark still plans as an equi-join (hash or
sort-merge), so it partitions on the keys like any other join.

Keys must be (close to) unique on at least one side for the output to stay
proportional to the input; a key repeated on both sides multiplies rows.
Callers aggregate to one row per key first (see the KPI job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HOW = {"inner": "inner", "left": "left", "right": "right", "outer": "full", "full": "full"}


def merge(left: DataFrame, right: DataFrame, on: list[str], how: str = "outer",
          suffixes: tuple[str, str] = ("_x", "_y"), null_safe: bool = True) -> DataFrame:
    """``null_safe=False`` is for keys known to be non-null: plain equality keeps
    the join keys identical to the inputs' own partitioning (e.g. a preceding
    aggregation on the same keys), so no extra shuffle is planned."""
    if how not in _HOW:
        raise ValueError(f"how must be one of {sorted(_HOW)}")
    lt, rt = left.alias("_l"), right.alias("_r")
    cond = None
    for k in on:
        lk, rk = F.col(f"_l.`{k}`"), F.col(f"_r.`{k}`")
        c = lk.eqNullSafe(rk) if null_safe else (lk == rk)
        cond = c if cond is None else (cond & c)
    joined = lt.join(rt, cond, _HOW[how])

    overlap = (set(left.columns) & set(right.columns)) - set(on)
    out = []
    for c in left.columns:
        if c in on:
            lk, rk = F.col(f"_l.`{c}`"), F.col(f"_r.`{c}`")
            key = {"inner": lk, "left": lk, "right": rk}.get(how, F.coalesce(lk, rk))
            out.append(key.alias(c))
        else:
            out.append(F.col(f"_l.`{c}`").alias(c + suffixes[0] if c in overlap else c))
    for c in right.columns:
        if c in on:
            continue
        out.append(F.col(f"_r.`{c}`").alias(c + suffixes[1] if c in overlap else c))
    return joined.select(*out)
