"""Exact dedup against groups of equal texts."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakepipe.llm import exact_dedup as E

from ..conftest import SF_ORACLE
from .cases import AWKWARD, SCHEMA, frame, rows


def brute(docs):
    """Sorted (doc_id, keep_id, group_size, kept, text_sha256) of (doc_id, text)."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    out = []
    for i, t in docs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(E.exact_dedup(docs)) == want and any(not r[3] for r in want)


@pytest.mark.parametrize("size", [1, 3, 8, 32768])
def test_blocks_of_any_size(spark, size):
    rnd = random.Random(size)
    texts = ["".join(rnd.choice("aé漢") for _ in range(rnd.randrange(9))) for _ in range(150)]
    # equal blocks in another order, a prefix of another text, and texts that end at a block's end
    texts += ["abcabd", "abdabc", "abc", "abcabc", "abcabcabc", "abcabcab", "", None, "\x00", "\x00\x00", "a ", "a"] * 2
    df = frame(spark, rows(*texts))
    assert got(E.exact_dedup(df, size)) == brute(list(enumerate(texts, 1)))


def test_awkward_rows_and_empty_table(spark):
    assert got(E.exact_dedup(frame(spark, AWKWARD))) == brute([(r[0], r[1]) for r in AWKWARD])
    assert E.exact_dedup(frame(spark, [])).collect() == []
    assert E.without_copies(frame(spark, [])).collect() == []


def test_hashes_that_collide_are_replaced(spark):
    def weak_first(block, seed):
        one = F.lit(7).cast("long")
        return F.struct(one.alias("a"), one.alias("b")) if seed < 2 else E.hashes(block, seed)

    texts = ["one", "two", "one", "three " * 30000, "three " * 30000, "three " * 29999 + "four"]
    df = frame(spark, rows(*texts))
    assert E.block_names(df, hashed=weak_first)[1] == 2
    assert got(E.exact_dedup(df, hashed=weak_first)) == brute(list(enumerate(texts, 1)))


def test_a_hot_text_and_rows_that_stay(spark):
    texts = ["hot text " * 700] * 60 + [f"text {k} " * 600 for k in range(60)] + ["hot text " * 699]
    df = frame(spark, rows(*texts))
    assert got(E.exact_dedup(df)) == brute(list(enumerate(texts, 1)))
    kept = E.without_copies(df)
    assert kept.schema.names == SCHEMA.names
    assert sorted(r.doc_id for r in kept.collect()) == [60, *range(61, 122)]


def test_columns_with_own_names_come_back(spark):
    extra = ["row", "name", "round", "left", "at", "a", "b", "id", "digest", "whole", "hashes", "keep_id", "h.a"]
    df = frame(spark, rows("x", "x", "y")).select("*", *[F.lit(c).alias(c) for c in extra])
    out = E.without_copies(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["h.a"]) for r in out.collect()) == [(2, "h.a"), (3, "h.a")]


def test_no_python_on_the_main_path(spark):
    plan = E.exact_dedup(frame(spark, rows("a", "a")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Cartesian" not in plan
