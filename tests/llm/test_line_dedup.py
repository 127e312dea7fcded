"""Line dedup against an in-memory version over all chunks, and its parts."""

from __future__ import annotations

import random
import re

from lakepipe.llm import line_dedup as L
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_ORACLE, SF_SMALL
from .cases import AWKWARD, SCHEMA, frame, rows


WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(docs):
    """{id: (lines, removed, text)} of documents with distinct ids, from runs of two raw lines and long lines."""
    cut = {i: (t or "").split("\n") for i, t in docs}
    seen, out = set(), {}
    for i in sorted(cut):
        at = [k for k, x in enumerate(cut[i]) if WORD.search(x)]
        long = {a for a in at if len(cut[i][a].split()) >= 20}
        runs = [((cut[i][a], cut[i][b]), range(a, b + 1)) for a, b in zip(at, at[1:]) if not long >= {a, b}]
        runs += [((cut[i][a],), [a]) for a in long]
        gone = set()
        for run, lines in sorted(runs, key=lambda r: r[1][0]):
            gone.update(lines if run in seen else ())
            seen.add(run)
        out[i] = gone
    return {i: (0 if t is None else len(cut[i]), len(out[i]),
                None if t is None else "\n".join(x for n, x in enumerate(cut[i]) if n not in out[i])) for i, t in docs}


def result(df):
    return {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in df.collect()}


def test_query_matches_brute_force(spark):
    for sf in (SF_SMALL, SF_ORACLE):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        got, want = result(QUERIES["op4_line_dedup"](spark, sf)), brute(docs)
        assert got == want
        assert sum(n for _, n, _ in want.values()) > 0


def test_passages_at_any_offset(spark):
    """Shared passages (several lines, or one of over 50 words) go from all documents but the first."""
    rng = random.Random(3)
    line = lambda n=9: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = ["\n".join(line() for _ in range(12)) for _ in range(4)] + [line(60) for _ in range(4)]
    texts = []
    for n in range(60):
        own = [line() for _ in range(rng.randint(3, 20))]
        own.insert(rng.randint(0, len(own)), passages[n % 8])
        texts.append("\n".join(own))
    got = result(L.line_dedup(frame(spark, rows(*texts))))
    assert got == brute(list(enumerate(texts, 1)))
    for n, p in enumerate(passages):
        holders = [i for i, t in enumerate(texts, 1) if p in t]
        words = set(re.findall(r"w\d+", p))
        left = [len(words & set(got[i][2].split())) / len(words) for i in holders]
        assert left[0] == 1.0, n
        # a passage's first line may end a chunk of lines before it, which then stays
        assert max(left[1:]) <= (1 / 12 if n < 4 else 0.0), (n, left)
    for i, t in enumerate(texts, 1):
        own = [x for x in t.split("\n") if not any(x in p for p in passages)]
        assert all(x in got[i][2] for x in own)


def test_an_inserted_line_shifts_nothing_else():
    rng = random.Random(4)
    lines = [f"line {rng.randrange(10**9)}" for _ in range(300)]
    hashes = lambda x: {h for _, h, *_ in L.rolled("\n".join(x))[0]}
    before, after = hashes(lines), hashes(lines[:100] + ["", "a new one"] + lines[100:])
    assert len(before - after) == 1 and len(after - before) == 2


def test_a_passage_whose_lines_occur_apart_elsewhere(spark):
    rng = random.Random(6)
    line = lambda n=17: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = [line() for _ in range(3)]
    texts = ["\n".join([line(9), x, line(9)]) for x in passage] + ["\n".join([line(9), *passage, line(9)]) for _ in range(2)]
    got = result(L.line_dedup(frame(spark, rows(*texts))))
    assert [got[i][1] for i in range(1, 6)] == [0, 0, 0, 0, 3]
    assert got == brute(list(enumerate(texts, 1)))


def test_short_shared_lines_stay(spark):
    texts = [f"All rights reserved.\nbody {i} of its own\nand {i * 7} more of it" for i in range(40)]
    assert all(r.n_removed == 0 for r in L.line_dedup(frame(spark, rows(*texts))).collect())


def test_awkward_rows(spark):
    block = "\n".join(f"shared line {i} of the block" for i in range(9))
    data = AWKWARD + rows(block, block, "\n" * 50, "\n" * 50, block + "\n" + block, start=70)
    data += [(None, block, None, None, None, None, None, None, None)] * 2 + [(70, "other text, same id", *[None] * 7)]
    got = [(r.doc_id, r.n_removed, r.text) for r in L.line_dedup(frame(spark, data)).collect()]
    assert len(got) == len(data)
    by = {}
    for i, n, t in got:
        by.setdefault(i, []).append((n, t))
    assert by[1] == [(0, None)] and by[2] == [(0, "")]
    assert (0, block) in by[None]  # a null id comes first: it keeps the block, in both equal rows
    assert by[None].count((0, block)) == 2 and by[71] == [(9, "")]
    assert by[72] == [(0, "\n" * 50)] and by[74][0][0] == 18
    kept = L.dedup_lines(frame(spark, data))
    assert kept.schema.names == SCHEMA.names
    assert {71, 74} & {r.doc_id for r in kept.collect()} == set()
    assert L.line_dedup(frame(spark, [])).collect() == []


def test_short_passages_are_found(spark):
    """Every repeated run of 2 to 8 short lines goes from all documents but the first, against raw line runs."""
    rng = random.Random(8)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(19 if n == 2 else 52 // n + 1) for _ in range(n)] for n in range(2, 9) for _ in range(30)]
    texts = []
    for copy in range(3):
        for p in rng.sample(passages, len(passages)):
            own = [line(9) for _ in range(rng.randint(2, 6))]
            at = rng.randint(0, len(own))
            blank = [""] * rng.choice((0, 0, 1, 2))
            texts.append("\n".join([*own[:at], *([] if copy == 0 else blank), p[0], "", *p[1:], *own[at:]]))
    got = result(L.line_dedup(frame(spark, rows(*texts))))
    seen, shared = set(), set()
    for i, t in enumerate(texts, 1):
        lines = [x for x in t.split("\n") if x]
        runs = set(zip(lines, lines[1:]))
        gone = {x for run in runs & seen for x in run}
        seen |= runs
        shared |= gone
        assert [x for x in got[i][2].split("\n") if x] == [x for x in lines if x not in gone], i
    assert shared == {x for p in passages for x in p}
