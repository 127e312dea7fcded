"""Near-dedup against all pairs, and its parts."""

from __future__ import annotations

import random

import numpy as np

from lakepipe.llm import _minhash as M
from lakepipe.llm import near_dedup as N
from lakepipe.llm._components import components
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_SMALL
from .cases import AWKWARD, SCHEMA, frame, rows


def shingles(text, k=4):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(docs, k=4):
    """{id: (set size, component)} over all pairs that share a shingle."""
    sets = {i: shingles(t, k) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders, seen = {}, set()
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    by_set = {}
    for i, s in sets.items():
        if s:
            by_set.setdefault(s, []).append(i)
    for same in by_set.values():
        for i in same:
            parent[max(find(i), find(same[0]))] = min(find(i), find(same[0]))
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                pair = (ids[a], ids[b])
                if pair not in seen and find(pair[0]) != find(pair[1]):
                    seen.add(pair)
                    x, y = sets[pair[0]], sets[pair[1]]
                    if 100 * len(x & y) >= 80 * len(x | y):
                        parent[max(find(pair[0]), find(pair[1]))] = min(find(pair[0]), find(pair[1]))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}
    return out


def test_query_matches_all_pairs(spark):  # at sf0.01: test_sql
    sf = SF_SMALL
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op9_near_dedup"](spark, sf).collect()
    want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(docs)
    assert len({c for _, c in want.values()}) < len(docs)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Hundreds of copies with many edits: some are linked with one another only through third ones."""
    monkeypatch.setattr(N, "BLOCK", 16)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = []
    for _ in range(260):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    got = result(N.near_dedup(frame(spark, rows(*texts)), 4))
    assert got == brute(list(enumerate(texts, 1)))


def test_chains_and_threshold(spark):
    """Links exactly at the threshold hold; chains join their ends."""
    word = lambda a, b: " ".join(f"t{i}" for i in range(a, b))
    texts = [word(0, 93), word(10, 103), word(20, 113), word(30, 123), word(200, 290), word(200, 293) + " q1 q2 q3"]
    got = result(N.near_dedup(frame(spark, rows(*texts)), 4))
    assert got == brute(list(enumerate(texts, 1)))
    assert got[4][1] == 1  # 80 of 100 shingles are shared by neighbours


def test_signature_is_the_element_wise_one():
    """Rank by rank gives the signature that visiting every element with all its ranks gives."""
    rng = np.random.default_rng(3)
    size = 24
    for n in (1, 2, 7, 60, 300):
        x = M.mix(rng.integers(0, 2**63, n, dtype=np.uint64))
        want = np.full(size, 0xFFFFFFFF, np.uint64)
        for e in x:
            places = list(range(size))
            for rank in range(size):
                r = int(M.mix(np.array([(int(e) + (rank + 1) * int(M._MULTIPLIER)) % 2**64], np.uint64))[0])
                k = rank + (r >> 40) % (size - rank)
                places[rank], places[k] = places[k], places[rank]
                want[places[rank]] = min(int(want[places[rank]]), rank << 22 | r & (1 << 22) - 1)
        assert (M.super_minhash(x, size) == want.astype(np.uint32)).all()


def test_word_hashes():
    rng = random.Random(1)
    texts = ["", "  ", "a", " a b ", "x" * 300 + " y " + "x" * 300, "é ü é\t\x0bü\r\n",
             " ".join(f"w{rng.randrange(900)}" for _ in range(3000)), "ab ba " + "a" * 64 + "b " + "a" * 128 + "b"]
    seen = {}
    for t in texts:
        words, hashes = t.encode().split(), M.word_hashes(t.encode())
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes, strict=True):
            assert seen.setdefault(w, int(h)) == int(h)
    assert len(set(seen.values())) == len(seen)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    errors = []
    for n in (10, 100, 1000):
        for _ in range(60):
            x = M.mix(rng.integers(0, 2**63, n, dtype=np.uint64))
            a, b = x[:int(n * 0.9)], x[int(n * 0.1):]
            errors.append((M.super_minhash(a, 192) == M.super_minhash(b, 192)).mean() - 0.8)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < np.sqrt(0.8 * 0.2 / 192)  # less than independent minima


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 80)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(5000, 5000), (1, 2)]
    parent = {}
    find = lambda i: i if parent.setdefault(i, i) == i else find(parent[i])
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: find(i) for i in {x for e in edges if e[0] != e[1] for x in e}}
    assert components(df.limit(0)).collect() == []


def test_awkward_rows(spark):
    data = AWKWARD + rows("a b", "A  b", "a b c", None, start=100) + [(None, "a b", *[None] * 7)]
    got = N.near_dedup(frame(spark, data), 4).collect()
    assert len(got) == len(data)
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert by[1] == (0, 1, True) and by[3] == (0, 3, True) and by[7] == (1, 7, True)
    assert by[100] == (1, 100, True) and by[101] == (1, 100, False) and by[102] == (1, 102, True) and by[103] == (0, 103, True)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    kept = N.one_of_each(frame(spark, data))
    assert kept.schema.names == SCHEMA.names
    assert len(kept.collect()) == len(data) - 1
    assert N.near_dedup(frame(spark, []), 4).collect() == []
