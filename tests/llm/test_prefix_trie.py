"""The conversation trie against prefixes in a dict."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.llm import prefix_trie as P
from lakepipe.llm.queries import op12_prefix_trie, rebuilt

from ..conftest import SF_ORACLE

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def ordered(rows):
    """{conv_id: [(role, text)]}; ties of role and turn are not ordered here."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0, role or ""), (role or "", text or "")))
    return {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in convs.items()}


def rebuild(convs):
    out = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + ts[h:]
    return out


def brute(convs):
    """Sorted result rows of {conv_id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ids in members.items():
        own = (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += own
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node], leaves[node],
                    saved[node], digest(ends[node])) for node, ids in members.items()), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*P.COLUMNS).collect()), key=str)


def rows_of(df):
    return [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF_ORACLE}/conversations.parquet")
    want = brute(rebuild(ordered(rows_of(table))))
    assert got(op12_prefix_trie(spark, SF_ORACLE)) == want and len(want) > 200


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_random_conversations_in_shards(spark, shards, monkeypatch):
    monkeypatch.setattr(P, "PIECE", 4)
    rnd = random.Random(shards)
    rows = []
    for c in range(-30, 170):
        n = rnd.randrange(1, 7) if c else 60
        rows += [(c, t, rnd.choice(["user", "bot"]), rnd.choice(["a", "bé", "ccc " * 5])) for t in range(n)]
    # a third of all are one conversation, another third have its first turn
    rows += [(c, t, "user", f"hot {t}") for c in range(1000, 1200) for t in range(3)]
    rows += [(c, t, "user", f"hot {t}" if t == 0 else f"{c} {t}") for c in range(2000, 2100) for t in range(3)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        assert got(P.prefix_trie(P.sequences(df))) == brute(ordered(rows))
        assert got(P.prefix_trie(rebuilt(P.sequences(df)))) == brute(rebuild(ordered(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_awkward_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 5, "", ""), (1, 5, "user", "x" * 200000), (2, 0, "user", None),
            (None, 0, "user", "nobody"), (5, 0, "us", "ertext"), (5, 1, "user", "text"), (6, 0, "user", "text"),
            (7, 1, "a", "b"), (7, 1, "a", "b"), (-3, 0, "a", "b"), (-5, 0, "z", "é"), (10 ** 17, 3, "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(P.prefix_trie(P.sequences(df))) == brute(ordered(rows))
    assert got(P.prefix_trie(rebuilt(P.sequences(df)))) == brute(rebuild(ordered(rows)))
    assert got(P.prefix_trie(rebuilt(P.sequences(spark.createDataFrame([], SCHEMA))))) == []
    nobody = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert got(P.prefix_trie(P.sequences(nobody))) == []


def test_long_conversations_and_clashing_columns(spark):
    rows = [(c, t, "user", f"turn {t % 7}" if t < 100 else f"{c} {t}") for c in range(5) for t in range(100 + 20 * c)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in (
        "path", "sizes", "ids", "key", "parent_key", "depth", "n_convs", "t", "ts", "base")])
    sequences = P.sequences(df)
    assert got(P.prefix_trie(sequences)) == brute(ordered(rows))


def test_equal_turns_come_in_one_order(spark):
    rows = [(c, 1, "user", t) for c in (1, 2) for t in ("a", "b", "c")]
    one = [tuple(r.path) for r in P.sequences(spark.createDataFrame(rows, SCHEMA)).collect()]
    two = [tuple(r.path) for r in P.sequences(spark.createDataFrame(rows[::-1], SCHEMA)).collect()]
    assert len({*one, *two}) == 1


def test_find_close():
    rnd = random.Random(4)
    for n in (1, 2, 5, 31, 32, 33, 64, 65, 500, 3000):
        bits, depth, left = [1], 1, n - 1
        while depth:
            if left and rnd.random() < 0.55 or depth == 1 and left:
                bits.append(1)
                depth, left = depth + 1, left - 1
            else:
                bits.append(0)
                depth -= 1
        want, stack = {}, []
        for k, b in enumerate(bits):
            if b:
                stack.append(k)
            else:
                want[stack.pop()] = k
        found = P.find_close(np.array(bits, np.uint8), np.flatnonzero(bits))
        assert found.tolist() == [want[k] for k in sorted(want)]
