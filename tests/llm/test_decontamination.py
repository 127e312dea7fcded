"""Benchmark decontamination against a search of every window, and each of its parts."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from lakepipe.llm import decontamination as D
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .cases import AWKWARD, SCHEMA, frame, rows


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def grams(w, k):
    return collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, items):
    """{(doc, item): best similarity} over all windows of the item's size."""
    out = {}
    for i, item in items:
        w = words(item)
        if not w:
            continue
        k = min(5, len(w))
        want = grams(w, k)
        for d, text in docs:
            t = words(text)
            if not any(tuple(t[j:j + k]) in want for j in range(len(t) - k + 1)):
                continue
            for s in range(max(1, len(t) - len(w) + 1)):
                have = grams(t[s:s + len(w)], k)
                shared, union = sum((want & have).values()), sum((want | have).values())
                if shared and 100 * shared >= 80 * union:
                    out[d, i] = max(out.get((d, i), 0), shared / union)
    return out


def bench(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def pairs(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_query_matches_brute_force(spark):  # at sf0.01: test_sql
    sf = SF_SMALL
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert pairs(QUERIES["op10_decontamination"](spark, sf)) == brute(docs, items)


def edited(rng, w):
    w = list(w)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(w)) if w else 0
        w[at:at + rng.randint(0, 1)] = ["new"] * rng.randint(0, 1)
    return w


def test_edited_passages(spark):
    """Substituted, inserted and dropped words, passages at the ends and side by side, repeated shingles."""
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.choice([3, 5, 12, 40, 90, 200]))) for _ in range(14)]
    items += ["a b " * 20, "one word " * 2, "x"]
    texts = []
    for _ in range(120):
        parts = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            parts += edited(rng, items[rng.randrange(len(items))].split())
            parts += [rng.choice(vocab) for _ in range(rng.randint(0, 3))]
        texts.append(" ".join(parts).upper() if rng.random() < 0.2 else " ".join(parts))
    got = pairs(D.leaks(frame(spark, rows(*texts)), bench(spark, *items)))
    want = brute([(i + 1, t) for i, t in enumerate(texts)], list(enumerate(items)))
    assert got == pytest.approx(want) and len(want) > 40


def test_large_benchmark_is_joined_without_broadcast(spark, monkeypatch):
    rng = random.Random(8)
    items = [" ".join(f"v{rng.randrange(300)}" for _ in range(30)) for _ in range(10)]
    texts = [f"head {x} tail" for x in items] + ["nothing here to find at all"]
    want = pairs(D.leaks(frame(spark, rows(*texts)), bench(spark, *items)))
    monkeypatch.setattr(D, "BROADCAST_SHINGLES", 0)
    assert pairs(D.leaks(frame(spark, rows(*texts)), bench(spark, *items))) == want and len(want) == 10


def test_simhash_and_blocks(spark):
    rng = random.Random(1)
    for n, most in ((1, 5), (30, 127), (200, 200), (7, 40000)):
        h = [rng.randrange(-2**63, 2**63) for _ in range(n)]
        want = sum((sum(x >> b & 1 for x in h) > n / 2) << b for b in range(64))
        want -= (1 << 64) if want >> 63 else 0
        df = spark.createDataFrame([(h,)], "h array<long>").select(D.simhash(F.col("h"), most).alias("p"))
        row = df.select("p", D.blocks(F.col("p")).alias("b")).collect()[0]
        assert row.p == want
        edges = [64 * i // 21 for i in range(22)]
        assert row.b == [(want % 2**64) >> a & ((1 << (b - a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def test_awkward_rows(spark):
    docs = frame(spark, AWKWARD + rows("the quick brown fox jumps over the lazy dog", start=60))
    items = bench(spark, None, "", "word", "the quick brown fox jumps over the lazy dog", "the quick brown fox jumps over the lazy dog")
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs, items).collect()}
    assert got == {(4, 2), (60, 3), (60, 4)}
    kept = D.without_leaks(docs, items)
    assert kept.schema.names == SCHEMA.names
    left = [r.doc_id for r in kept.collect()]
    assert sorted(left, key=repr) == sorted([1, 2, 3, 5, 6, 7, 7, None], key=repr)
    assert D.leaks(frame(spark, []), items).collect() == []
    assert D.leaks(docs, items.filter("false")).collect() == []
    assert D.without_leaks(docs, items.filter("false")).count() == len(AWKWARD) + 1


def test_main_path_is_native(spark):
    plan = QUERIES["op10_decontamination"](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
