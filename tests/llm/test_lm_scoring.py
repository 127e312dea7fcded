"""LM scoring: counts and base score against brute force, the network against finite differences and sums to one."""

from __future__ import annotations

import collections
import math
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import _gru as G
from lakepipe.llm import lm_scoring as L
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_ORACLE, SF_SMALL
from .cases import AWKWARD, frame, rows


def counts_of(docs):
    c = collections.Counter()
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(L.tokens(t))
    return c


@pytest.mark.parametrize(("lookup", "sf"), [(1 << 18, SF_ORACLE), (300, SF_SMALL)])
def test_query_base_and_gain(spark, monkeypatch, lookup, sf):
    """With most counts joined (small lookup) the results are the same."""
    monkeypatch.setattr(L, "LOOKUP", lookup)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_lm_scoring"](spark, sf).collect()
    assert len(got) == len(docs)
    c = counts_of(docs.items())
    n, v = sum(c.values()), len(c)
    for r in got:
        words = L.tokens(docs[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert r.score < 0
    held = [r for r in got if r.held_out]
    if sf == SF_ORACLE:  # a few dozen spans teach nothing yet
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def tiny():
    layout = G.make_layout(np.array([9.0, 7, 5, 4, 3, 2, 2, 1, 1]), np.array([3.0, 1.5]), 3)
    rng = np.random.default_rng(0)
    p = G.new_parameters(layout, 5)
    for k in ("wc", "ww"):
        p[k] = rng.standard_normal(p[k].shape).astype(np.float32)
    return layout, p


def test_probabilities_sum_to_one():
    layout, p = tiny()
    for prefix in ([], [3], [10, 2, 8]):
        each = [G.score(p, layout, [np.array([*prefix, s], np.int32)])[0] for s in range(11)]
        before = G.score(p, layout, [np.array(prefix, np.int32)])[0] if prefix else 0.0
        assert sum(10 ** (x - before) for x in each) == pytest.approx(1, abs=1e-4)


def test_state_is_carried_across_windows_and_lanes():
    layout, p = tiny()
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 11, n).astype(np.int32) for n in (70, 3, 1, 33, 16, 17)]
    want = [G.score(p, layout, [d], lanes=1, window=1000)[0] for d in docs]
    for lanes, window in ((1, 4), (2, 16), (8, 7)):
        assert np.allclose(G.score(p, layout, docs, lanes, window), want, rtol=1e-4)


def test_gradients_match_finite_differences():
    layout, p = tiny()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    docs = [np.array([1, 9, 4, 0, 10, 2], np.int32)]
    loss = lambda q: -G.score(q, layout, docs, window=16)[0] * G.LN10
    start = {k: v.copy() for k, v in p.items()}
    # a first AdaGrad step is rate * g / sqrt(1 + g^2): the gradient comes back from it
    after = {k: v.copy() for k, v in p.items()}
    G.train(after, layout, docs, lanes=1, window=16, rate=1.0)
    for name in p:
        step = start[name] - after[name]
        g = step / np.sqrt(np.maximum(1e-12, 1 - step ** 2)) * np.sqrt(6)
        for at in np.ndindex(*p[name].shape):
            if abs(step[at]) > 0.9 or (name == "x" and at[0] not in docs[0]):
                continue
            up, down = ({k: v.copy() for k, v in start.items()} for _ in range(2))
            up[name][at] += 1e-3
            down[name][at] -= 1e-3
            assert g[at] == pytest.approx((loss(up) - loss(down)) / 2e-3, rel=0.05, abs=0.01), (name, at)


def test_training_learns_a_pattern():
    layout, p = tiny()
    docs = [np.array([0, 1, 2, 3] * 12, np.int32)] * 20
    before = G.score(p, layout, docs[:1])[0]
    for _ in range(20):
        G.train(p, layout, docs, lanes=4)
    assert G.score(p, layout, docs[:1])[0] > before / 3


def test_awkward_rows(spark):
    data = AWKWARD + rows("UPPER upper Upper", start=60)
    got = L.lm_scores(frame(spark, data), F.lit(False)).collect()
    assert len(got) == len(data)
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1
    assert by[60].n_tokens == by[60].n_known == 4 and by[5].n_tokens == 100001
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert L.lm_scores(frame(spark, []), F.lit(False)).collect() == []
    none = L.lm_scores(frame(spark, rows("a b")), F.lit(True)).collect()[0]
    assert (none.n_known, none.train_tokens, none.base_score) == (0, 0, 0.0) and none.score < 0


def test_every_training_document_is_trained_once(spark, monkeypatch, tmp_path):
    folder = str(tmp_path)

    def note(vocab, parameters, rate, schema, batches):
        for b in batches:
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("".join(f"{t}\n" for t in b.column(0).to_pylist()))
        yield from ()

    monkeypatch.setattr(L, "_train", note)
    texts = [f"text {i} of its own" for i in range(200)]
    L.fit(frame(spark, rows(*texts)), None, tiny()[0])
    assert sorted(t for f in tmp_path.iterdir() for t in f.read_text().splitlines()) == sorted(texts)


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_every_token_of_a_text_is_trained(monkeypatch, held):
    """Gradients come from all tokens of a task's texts, also when they are read in several parts."""
    monkeypatch.setattr(L, "HELD", held)
    texts = [" ".join(f"w{(i * k) % 11}" for k in range(5 + 37 * i)) for i in range(9)] + [None, ""]
    words = collections.Counter(w for t in texts for w in L.tokens(t))
    order = sorted(words, key=lambda w: (-words[w], w))
    counts = np.array([words[w] for w in order], float)
    sizes = np.full(L.TAILS, 0.5)
    v = L.Vocabulary(order, counts, sum(words.values()), len(words), 1, {}, sizes, G.make_layout(counts, sizes, 3))
    shared = lambda x: types.SimpleNamespace(value=x)
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[k:k + 4], pa.string())}) for k in range(0, len(texts), 4)]
    out = L._train(shared(v), shared(G.new_parameters(v.layout, L.HIDDEN)), 0.1, L.arrow_schema(L.BLOCKS), iter(batches))
    used = {(r["name"], r["block"]): np.frombuffer(r["weight"], np.float32) for b in out for r in b.to_pylist()}
    assert set(used["u", 0]) == {float(v.total)}
    assert list(used["x", 0][:len(order)]) == list(counts)


def test_training_lanes_hold_whole_documents():
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 11, n).astype(np.int32) for n in (300, 1, 64, 65, 7, 129, 16, 2)]
    symbols, starts = G.lanes_of(docs, 3)
    got = [tuple(d) for s, f in zip(symbols, starts, strict=True) for d in np.split(s, np.flatnonzero(f)[1:])]
    assert all(f[0] for f in starts) and sorted(got) == sorted(map(tuple, docs))
    windows = list(G.lane_windows(symbols, starts, 16))
    for lane, s in enumerate(symbols):
        joined = np.concatenate([ids[:, lane] for ids, _ in windows if lane < ids.shape[1]])
        assert list(joined[:len(s)]) == list(s) and (joined[len(s):] == -1).all()


def test_tokens_of_a_column_are_those_of_each_text():
    texts = [None, "", " ", "  a", "a  ", "\x0b\x0c\x1cA\u0085\u00c9 b\r\n\tC\x00 ", "\u0130 \u00df x", " \n ", "Z"]
    for part in (texts, texts[3:5], texts[:1], texts[2:3], []):
        words, first = L.all_tokens(pa.array(part, pa.string()))
        words = words.to_pylist()
        assert [words[a:b] for a, b in zip(first, first[1:], strict=False)] == [L.tokens(t) for t in part]
    words, first = L.all_tokens(pa.array(texts, pa.string())[3:6])
    assert words.to_pylist() == [w for t in texts[3:6] for w in L.tokens(t)] and len(first) == 4


def test_scoring_fills_its_lanes(monkeypatch):
    """Short documents follow one another in a lane, so no window runs for a few of them alone."""
    layout, p = tiny()
    docs = [np.full(n, n % 11, np.int32) for n in [5] * 600 + [400] * 8]
    want = [G.score(p, layout, [d])[0] for d in (docs[0], docs[-1])]
    run, windows = G.run_window, []
    monkeypatch.setattr(G, "run_window", lambda *a, **k: windows.append(1) or run(*a, **k))
    got = G.score(p, layout, docs, lanes=8, window=16)
    assert np.allclose(got, [want[0]] * 600 + [want[1]] * 8, rtol=1e-4)
    assert len(windows) <= 50


def test_probabilities_of_large_weights_sum_to_one():
    layout, p = tiny()
    h = G.run_window(G.gate_weights(p), np.zeros((5, 1), np.float32), np.array([[3], [0]], np.int32), np.zeros((2, 1), bool))[0][1, :, 0]
    p["wc"][0], p["ww"][0] = 900 * np.sign(h), 900 * np.sign(h)
    each = [G.score(p, layout, [np.array([3, s], np.int32)])[0] - G.score(p, layout, [np.array([3], np.int32)])[0] for s in range(11)]
    assert sum(10 ** x for x in each) == pytest.approx(1, abs=1e-4)
    G.train(p, layout, [np.array([3, 0, 4], np.int32)])
    assert all(np.isfinite(v).all() for v in p.values())


def test_scores_do_not_depend_on_how_much_is_held(spark, monkeypatch):
    texts = [" ".join(f"w{(i * k) % 11}" for k in range(5 + 37 * i)) for i in range(9)] + [None, "", " w1 never seen"]
    words = collections.Counter(w for t in texts[:-1] for w in L.tokens(t))
    order = sorted(words, key=lambda w: (-words[w], w))
    counts, sizes = np.array([words[w] for w in order], float), np.full(L.TAILS, 7.5)
    v = L.Vocabulary(order, counts, sum(words.values()), len(words), 1, {b"en": 2}, sizes, G.make_layout(counts, sizes, 3))
    shared = lambda x: types.SimpleNamespace(value=x)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    scored = lambda: [r for b in L._score(shared(v), shared(G.new_parameters(v.layout, L.HIDDEN)), L.arrow_schema(L.SCORED),
                                          iter([batch])) for r in b.to_pylist()]
    want = scored()
    assert [r["doc_id"] for r in want] == list(range(len(texts)))
    assert want[-1]["rare"] == [b"never", b"seen"] and want[-1]["n_tokens"] == 4
    monkeypatch.setattr(L, "HELD", 50)
    monkeypatch.setattr(L, "READ", 100)
    for got, r in zip(scored(), want, strict=True):
        assert got.pop("rare") == r.pop("rare") and got.pop("rare_n") == r.pop("rare_n")
        assert got == pytest.approx(r)
