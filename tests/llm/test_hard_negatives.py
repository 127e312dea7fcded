"""Hard negatives against all scores of each anchor."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.llm import hard_negatives as H

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
                       T.StructField("embedding", T.ArrayType(T.DoubleType()))])
LONG = (1 << 63) - 1


def brute(rows, every=10):
    """Sorted result rows of (vec_id, label, vector), with anchors at ids divisible by ``every``."""
    fits = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    clip = lambda n: max(-LONG, min(LONG, n))
    floor = lambda x: clip(math.floor(256 * x)) if math.isfinite(256 * x) else int(math.copysign(LONG, x))
    used = {(i, y, tuple(floor(x) for x in v)) for i, y, v in rows if i is not None and y is not None and fits(v)}
    out = []
    for a, y, v in {r for r in used if r[0] % every == 0}:
        scored = {(clip(sum(p * q for p, q in zip(v, w, strict=False))), i, z) for i, z, w in used if i != a}
        best = sorted({(s, i) for s, i, z in scored if z == y}, key=lambda e: (-e[0], e[1]))[:5]
        other = sorted({(s, i) for s, i, z in scored if z != y}, key=lambda e: (-e[0], e[1]))
        for p, i in best:
            inside = [e for e in other if 30 * p <= 100 * e[0] <= 90 * p][:10]
            out += [(a, i, k, j, p, s) for k, (s, j) in enumerate(inside, 1)]
    return sorted(out)


def mined(df, every=10):
    out = H.hard_negatives(df, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("id") % every == 0)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect())


def vectors(n, dims, labels, seed, spread=0.2):
    rnd = random.Random(seed)
    return [(i, rnd.randrange(labels), [rnd.gauss(0.1, spread) for _ in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vectors(spark, seed, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)  # several anchor groups
    rows = vectors(600, 6, 3, seed)
    want = brute(rows)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5)) == want and len(want) > 500


def test_ties_hot_label_and_common_vector(spark):
    rows = [(i, 0 if i % 3 else i % 5, [0.25, 0.5] if i % 2 else [0.5, 0.125 * (i % 4)]) for i in range(400)]
    want = brute(rows)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == want and want


def test_awkward_rows(spark):
    rows = [(0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (0, 2, [0.5, 1.0]), (None, 1, [1.0, 1.0]), (1, None, [1.0, 1.0]), (2, 1, None),
            (3, 1, [1.0, None]), (4, 1, [1.0, math.nan]), (5, 2, [1.0, -math.inf]), (6, 1, []), (7, 2, []), (8, 1, [0.9]),
            (9, 2, [0.5, 0.2, 7.0]), (10, 3, [-1.0, -1.0]), (11, 1, [1.0, 0.5]), (11, 1, [1.0, 0.5]), (12, 2, [0.7, 0.5]),
            (12, 3, [0.7, 0.5]), (12, 1, [0.6, 0.5]), (-10, 1, [0.3, 0.3])]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([r for r in rows if r[0] and r[0] > 10], SCHEMA)) == []


def test_scores_beyond_doubles_are_exact_or_cut(spark):
    rows = [(0, 1, [1e6, 3.0]), (1, 1, [1e6 + 1, 3.0]), (2, 2, [5e5 + 3, 0.125]), (3, 2, [5e5 + 3, 0.25]), (4, 1, [1.0, 1e300]),
            (10, 1, [1e308, 1e308]), (11, 2, [1e4, 1.0]), (12, 1, [2e10, 1.0]), (13, 2, [1e10, 7.0])]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows) != []


def test_slots_answer_every_window():
    rnd = random.Random(3)
    for _ in range(200):
        positives = sorted((rnd.randrange(-20, 300) for _ in range(rnd.randrange(1, 6))), reverse=True)
        uppers, slots, lowest = H.limits(positives)
        scores = np.array([rnd.randrange(-30, 320) for _ in range(300)])
        ids = np.arange(300)
        kept = H.Kept(len(uppers), H.TOP)
        if uppers:
            for k in range(0, 300, 50):
                H.add_negatives(kept, np.array(uppers), lowest, scores[k:k + 50], scores[k:k + 50] % 2 == 0, ids[k:k + 50])
        merged = H.merge_upwards([list(zip(s.tolist(), i.tolist(), strict=True)) for s, i in kept.lists])
        for p, slot in zip(positives, slots, strict=True):
            want = sorted(((s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True)
                           if s % 2 == 0 and 30 * p <= 100 * s <= 90 * p), key=lambda e: (-e[0], e[1]))[:H.TOP]
            got = [e for e in merged[slot] if 100 * e[0] >= 30 * p] if slot >= 0 else []
            assert got == want


def test_clashing_columns(spark):
    rows = vectors(120, 4, 2, 5)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in (
        "id", "vector", "anchor", "met", "positives", "slot", "score", "anchor_id")])
    assert mined(df) == brute(rows) != []
