"""Quality rules against brute force over words and numpy estimates."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np

from lakepipe.llm import quality_rules as Q
from lakepipe.llm.queries import QUERIES

from ..conftest import SF_ORACLE
from .cases import AWKWARD, SCHEMA, frame, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    n = len(words)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    found = collections.Counter(tuple(words[i:i + 5]) for i in range(n - 4))
    repeated = {k for i in range(n - 4) if found[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(repeated), len(lines))


def failed(s):
    return s[0] < 10 or 100 * s[4] > 20 * s[0]


def vector(s):
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / b)))
    return [math.log((s[1] + 250) / (s[0] + 50)), share(s[2], s[1] + 100), share(s[3], s[5] + 10), share(s[4], s[0] + 50)]


def quantile(v, q):
    steps = np.sort(np.clip(np.floor(np.asarray(v) / 0.01), -5000, 5000))
    upto = np.arange(1, len(steps) + 1)
    return (steps[np.argmax(upto >= q * len(steps) - 1e-9)] + 1) * 0.01


def distances(x, centre, cov):
    d = x - centre
    return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)


def floored(cov):
    """Deviations of at least 0.02 (log word length), 0.02 (symbols), 0.10 (repeated lines), 0.08 (repeated words)."""
    cov = cov.copy()
    for i, least in enumerate((0.02, 0.02, 0.10, 0.08)):
        cov[i, i] = max(cov[i, i], least * least)
    return cov


def estimate(x):
    mid = np.array([quantile(c, 0.5) for c in x.T])
    mad = np.array([quantile(np.abs(c - m), 0.5) for c, m in zip(x.T, mid, strict=True)])
    found = []
    for centre, cov in ((mid, np.diag((1.4826 * mad) ** 2)), (x.mean(0), np.cov(x.T, bias=True)), (mid, np.zeros((4, 4)))):
        cov, best = floored(cov), math.inf
        while True:
            d = np.sqrt(distances(x, centre, cov))
            core = x[d <= quantile(d, 0.75)]
            new = floored(np.cov(core.T, bias=True) * 1.486)
            if np.linalg.det(new) >= best * (1 - 1e-6):
                break
            centre, cov, best = core.mean(0), new, np.linalg.det(new)
        found.append((best, len(found), centre, cov))
    _, _, centre, cov = min(found, key=lambda f: f[:2])
    near = x[distances(x, centre, cov) <= 11.14]
    return near.mean(0), floored(np.cov(near.T, bias=True))


def verdicts(data):
    """{id: (statistics, failed, kept)} from (id, text, lang, source)."""
    stats = {i: brute(t) for i, t, _, _ in data}
    groups = collections.defaultdict(list)
    for i, _, lang, source in data:
        if not failed(stats[i]):
            groups[lang, source].append(i)
    rest, few = collections.defaultdict(list), {}
    for (lang, source), ids in list(groups.items()):
        if len(ids) < 40:
            rest[lang] += groups.pop((lang, source))
    last = []
    for lang, ids in rest.items():
        if len(ids) < 40:
            last += ids
        else:
            few[lang] = ids
    kept = {i: not failed(s) for i, s in stats.items()}
    for ids in [*groups.values(), *few.values(), last]:
        if len(ids) >= 40:
            x = np.array([vector(stats[i]) for i in ids])
            for i, d in zip(ids, distances(x, *estimate(x)), strict=True):
                kept[i] = bool(d <= 23.51)
    return {i: (s, failed(s), kept[i]) for i, s in stats.items()}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source)
            for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    want = verdicts(docs)
    got = QUERIES["op8_quality_rules"](spark, SF_ORACLE).collect()
    assert len(got) == len(want)
    for r in got:
        s, bad, keep = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == s[:5]
        assert (r.base_failed, r.kept) == (bad, keep)


def test_large_groups_and_labels(spark):
    """Own group per language and source; clean texts stay and texts full of symbols go."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    got = Q.quality_rules(docs).collect()
    want = verdicts([(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()])
    assert all(r.kept == want[r.doc_id][2] for r in got)
    clean = [r.kept for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert np.mean(clean) > 0.995 and np.mean(junk) < 0.05


def plain(rng, n=300, extra=()):
    """A text of ``n`` words in lines of ten, with some lines in between."""
    words = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.choice((2, 3, 4, 5, 5, 6, 7, 8)))) for _ in range(n)]
    lines = [" ".join(words[k:k + 10]) for k in range(0, n, 10)]
    for k, line in enumerate(extra):
        lines.insert(2 * k + 1, line)
    return "\n".join(lines)


def test_outliers_of_each_statistic_are_rejected(spark):
    rng = random.Random(11)
    clean = [plain(rng, rng.randrange(150, 500)) for _ in range(300)]
    lines = plain(rng, 10 * 100).split("\n")
    planted = {
        "long words": " ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(300)),
        "short words": " ".join(rng.choice("abcdefgh") + rng.choice("ijklmnop") for _ in range(300)),
        "symbols": plain(rng, 300, ["# $ % | <"] * 8),
        "repeated lines": plain(rng, 400, ["only this"] * 38),
        # ten of a hundred lines come again, in an order that repeats no line's neighbours
        "repeated words": " ".join(x + (" " + lines[(7 * k + 5) % 100] if k % 10 == 0 else "") for k, x in enumerate(lines)),
    }
    got = {r.doc_id: r for r in Q.quality_rules(frame(spark, rows(*clean, *planted.values()))).collect()}
    assert np.mean([got[i].kept for i in range(1, 301)]) > 0.99
    for i, name in enumerate(planted, 301):
        assert not got[i].base_failed and not got[i].kept, (name, got[i])


def test_repeated_windows(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    texts += ["  lead " + "x y z " * 30, "a\n\na\n \nb\na", "#*$%&|<>" * 3]
    got = Q.quality_rules(frame(spark, rows(*texts))).collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id - 1])[:5]


def test_awkward_rows(spark):
    got = {r.doc_id: r for r in Q.quality_rules(frame(spark, AWKWARD)).collect()}
    assert len(got) == len(AWKWARD) - 1
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert Q.quality_rules(frame(spark, [])).collect() == []
    kept = Q.keep_good(frame(spark, AWKWARD + rows("a plain text of more than ten words that nothing is wrong with", start=50)))
    assert kept.schema.names == SCHEMA.names
    assert [r.doc_id for r in kept.collect()] == [50]


def test_main_path_is_native(spark):
    out = Q.quality_rules(frame(spark, rows("one two three")))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
