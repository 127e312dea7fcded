"""The quality classifier against a plain Kneser-Ney model, its two ways of scoring, and labels."""

from __future__ import annotations

import collections
import math

import numpy as np
import pytest

from lakepipe.llm import quality_model as Q
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_ORACLE
from .cases import AWKWARD, frame, rows

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "ein Hund und eine Katze", "él está aquí", "the the the"]


def plain_model(texts):
    """probability(context, byte) of interpolated modified Kneser-Ney, from its definition."""
    n = Q.ORDER
    grams = collections.Counter()
    for t in texts:
        b = b"\0" * (n - 1) + t.encode()
        grams.update(b[i - n + 1:i + 1] for i in range(n - 1, len(b)))
    counts = {n: grams}
    for k in range(n - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    discounts = {}
    for k, c in counts.items():
        m = collections.Counter(c.values())
        y = m[1] / (m[1] + 2 * m[2]) if m[1] + m[2] else 0.5
        d = [j - (j + 1) * y * m[j + 1] / m[j] if m[j] else j * 0.5 for j in (1, 2, 3)]
        discounts[k] = [min(max(x, 0.01), j - 0.01) for j, x in zip((1, 2, 3), d, strict=True)]

    def p(context, byte):
        k = len(context) + 1
        below = p(context[1:], byte) if context else 1 / 256
        after = {g: c for g, c in counts[k].items() if g[:-1] == context}
        if not after:
            return below
        total = sum(after.values())
        gamma = sum(discounts[k][min(c, 3) - 1] for c in after.values()) / total
        c = after.get(context + bytes([byte]), 0)
        return (c - discounts[k][min(c, 3) - 1] if c else 0) / total + gamma * below

    return p


def fitted(spark, texts):
    return Q.fit(Q.gram_counts(frame(spark, rows(*texts))))


def test_probabilities_match_definition(spark):
    p = plain_model(TEXTS)
    grams, contexts = fitted(spark, TEXTS)
    model = Q.Model(grams.toArrow(), contexts.toArrow())
    new = ["the cat", "xyzzy", "Katze und Maus", "ñandú \x00 🙂", "t", ""]
    loss, n = model.losses(new)
    for t, got, length in zip(new, loss, n, strict=True):
        b = b"\0" * (Q.ORDER - 1) + t.encode()
        want = -sum(math.log(p(b[i - Q.ORDER + 1:i], b[i])) for i in range(Q.ORDER - 1, len(b)))
        assert length == len(t.encode()) and got == pytest.approx(want, rel=1e-4, abs=1e-6)
    for context in (b"the ", b"zzzz", b"\0\0\0\0"):
        assert sum(p(context, x) for x in range(256)) == pytest.approx(1)


def test_joined_scores_equal_broadcast_scores(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").filter("n_chars < 3000")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    a, b = ({r.doc_id: r for r in Q.quality_scores(docs, labels, n).collect()} for n in (None, 0))
    assert set(a) == set(b)
    for i in a:
        assert a[i].perplexity == pytest.approx(b[i].perplexity, rel=1e-3) and a[i].kept == b[i].kept


@pytest.mark.parametrize("limit", [None, 0])
def test_every_trusted_text_is_counted_and_judged(spark, monkeypatch, limit):
    """Each in the model that does not judge it; copies of a text, trusted or not, are judged by the same model."""
    texts = [f"{a} of {b} and {c}" for a in ("cats", "dogs", "birds") for b in ("iron", "wood") for c in ("salt", "rain", "sand")]
    texts += texts[:3] + ["qqqq zzzz", "iron iron iron", None, ""]
    docs = frame(spark, rows(*texts))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 20)] + [(22, 0, 0), (24, 1, 0)], "doc_id long, quality int, toxic int")
    seen = {}

    def fit(counts, of=Q.fit):
        seen["bytes"] = counts.agg({"n": "sum"}).collect()[0][0]
        return of(counts)

    def limits(judged, of=Q._limits):
        seen["judged"] = judged.count()
        return of(judged)

    monkeypatch.setattr(Q, "fit", fit)
    monkeypatch.setattr(Q, "_limits", limits)
    if limit == 0:
        monkeypatch.setattr(Q, "BROADCAST_IDS", 0)
    got = {r.doc_id: r for r in Q.quality_scores(docs, labels, limit).collect()}
    assert seen == {"bytes": sum(len(t) for t in texts[:19]), "judged": 19}
    judge = {r.doc_id: r.m for r in docs.select("doc_id", Q.judge(docs["text"]).alias("m")).collect()}
    models = [plain_model([texts[i - 1] for i in range(1, 20) if judge[i] != m]) for m in (0, 1)]
    for i, t in enumerate(texts, 1):
        if t:
            b = b"\0" * (Q.ORDER - 1) + t.encode()
            loss = -sum(math.log(models[judge[i]](b[k - Q.ORDER + 1:k], b[k])) for k in range(Q.ORDER - 1, len(b)))
            assert got[i].perplexity == pytest.approx(math.exp(loss / len(t)), rel=1e-3)
    assert [judge[i] for i in (19, 20, 21)] == [judge[i] for i in (1, 2, 3)] and {judge[i] for i in range(1, 20)} == {0, 1}


def test_table_holds_any_keys():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**40, 5000, dtype=np.uint64))
    t = Q.Table(keys, np.arange(len(keys), dtype=np.float32))
    probe = np.concatenate([keys[::3], rng.integers(0, 2**40, 3000, dtype=np.uint64)])
    v, found = t.get(probe)
    where = {int(k): i for i, k in enumerate(keys)}
    assert [int(x) if f else None for x, f in zip(v, found, strict=True)] == [where.get(int(k)) for k in probe]
    assert not Q.Table(keys[:0], np.zeros(0, np.float32)).get(keys[:5])[1].any()


def test_query_keeps_clean_and_drops_junk(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op3_quality_model"](spark, sf).collect()
    assert len(got) == 10000
    clean = [r.kept for r in got if r.doc_id in labels and labels[r.doc_id].quality == 1 and not labels[r.doc_id].toxic]
    junk = [r.kept for r in got if r.doc_id in labels and labels[r.doc_id].quality == 0]
    assert np.mean(clean) > 0.995 and np.mean(junk) < 0.1


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 1, 0), (None, 1, 0), (7, None, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_scores(frame(spark, AWKWARD), labels).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[1].perplexity is None and not by[1].kept and not by[2].kept and by[4].kept
    none = Q.quality_scores(frame(spark, rows("some text", None)), labels.limit(0)).collect()
    assert sorted((r.doc_id, r.kept) for r in none) == [(1, True), (2, False)]
    assert Q.quality_scores(frame(spark, []), labels).collect() == []
