"""Conversation prefix trie (operator 12): balanced parentheses per shard, shared spines merged.

A conversation is its turns (role, text) in order; each distinct sequence of first turns is a node of one trie, from the
root without turns. ``prefix_trie`` returns a row per node with the conversations that begin with it (members), its
children, the leaves below it and the tokens saved if every member but one reuses the node's last text, summed over its subtree.

Turns are known by 128 bits of the SHA-256 of role and text, so texts are read once and not shuffled. Equal sequences are
combined into one row first, with the ids that end there in pieces of ``PIECE`` consecutive numbers; so copies of one
conversation, however many, are no hot key. The distinct sequences are range-partitioned and sorted: a shard is an interval
of the trie in depth-first order.

A shard writes its part of the trie as parentheses, one pair per node, while it reads. The excess (open minus closed) falls
below a node's value first where the node closes; ``find_close`` skips blocks of ``SKIP`` parentheses whose least excess is
not low enough, by a tree of the least excess of blocks (as the excess changes by one, minima are all it needs). Between a node and its close lie its
subtree's nodes, so sums over subtrees are differences of cumulative arrays: members, leaf pairs "()" by rank, and
savings. All of it is numpy over the shard's arrays; no step walks the trie node by node but the reading one.

Only nodes on the first and the last sequence of a shard can have members in other shards. These spines are given out with what
the shard knows of them, added up by node in one grouped aggregate, and their own savings and leaf marks are then handed up from the
deepest to the root by one task, which reads two sequences per shard at most, whatever the number of conversations. All other nodes are complete where they
were found.

Null role or text counts as empty; a null turn comes first; turns of equal number are ordered by role, then digest, and all are
kept. Rows without a conv_id are no conversation and take no part. A sequence without turns ends at the root. Without any
conversation the result is empty. The texts of one turn may be very long; the turns of one conversation (about 40 bytes each)
must fit a task. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import arrow_schema, batch_of, drop_written, written

PIECE = 1024
SKIP = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()

PARTS = ("key binary, parent_key binary, depth long, size long, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
TOTALS = "key binary, below_leaves long, below_saved long"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): the digests and UTF-8 bytes of each conversation's turns, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(" "), role, text), 256)), 1, 16)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("t"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("conv_id", F.col("ts.digest").alias("path"), F.col("ts.size").alias("sizes"))


def find_close(bits: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Positions where the parentheses opened at ``opens`` close; ``bits`` has 1 for open and 0 for close."""
    n = len(bits)
    blocks = 1
    while blocks * SKIP < n:
        blocks *= 2
    excess = np.full(blocks * SKIP, n + 1, np.int64)
    excess[:n] = np.cumsum(2 * bits.astype(np.int64) - 1)
    need = excess[opens] - 1
    # least excess of blocks; node 1 is the root, 2k and 2k + 1 the halves of k
    least = np.empty(2 * blocks, np.int64)
    least[blocks:] = excess.reshape(blocks, SKIP).min(axis=1)
    for k in range(blocks.bit_length() - 2, -1, -1):
        low = 1 << k
        least[low:2 * low] = least[2 * low:4 * low].reshape(low, 2).min(axis=1)
    out = np.full(len(opens), -1, np.int64)

    def scan(which: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Look for the close from ``start`` to the end of its block; those that don't close there are returned."""
        at = start.copy()
        while len(which):
            inside = at % SKIP != 0
            found = inside & (excess[np.minimum(at, len(excess) - 1)] == need[which])
            out[which[found]] = at[found]
            if not (inside & ~found).any():
                return which[~found & ~inside]
            ended.append(which[~inside])
            which, at = which[inside & ~found], at[inside & ~found] + 1
        return which

    ended: list[np.ndarray] = []
    rest = scan(np.arange(len(opens)), opens + 1)
    rest = np.concatenate([*ended, rest])
    node = opens[rest] // SKIP + blocks
    climbing = np.ones(len(rest), bool)
    while climbing.any():  # up to the first right neighbour that goes low enough
        here = node[climbing]
        hit = (here % 2 == 0) & (least[here + 1] <= need[rest[climbing]])
        node[climbing] = np.where(hit, here + 1, here // 2)
        still = climbing.copy()
        still[climbing] = ~hit
        climbing = still
    while len(node) and node[0] < blocks or (node < blocks).any():  # down to its first block that does
        inner = node < blocks
        left = 2 * node[inner]
        node[inner] = np.where(least[left] <= need[rest[inner]], left, left + 1)
    first = (node - blocks) * SKIP
    at_first = excess[first] == need[rest]
    out[rest[at_first]] = first[at_first]
    scan(rest[~at_first], first[~at_first] + 1)
    return out


class Shard:
    """The trie of an interval of sorted sequences, as parentheses and arrays in the order of their opening."""

    def __init__(self):
        self.bits = bytearray()
        self.sizes, self.counts, self.least, self.parents = (array("q") for _ in range(4))
        self.ends: dict[int, str] = {}
        self.path: list[bytes] = []
        self.first: list[bytes] | None = None
        self.open: list[int] = []
        self.first_nodes: list[int] = []
        self.digest = None

    def _enter(self, size: int) -> None:
        self.parents.append(self.open[-1] if self.open else -1)
        self.open.append(len(self.sizes))
        self.bits.append(1)
        self.sizes.append(size)
        self.counts.append(0)
        self.least.append((1 << 63) - 1)

    def _leave(self) -> None:
        self.bits.append(0)
        self.open.pop()

    def add(self, path: list[bytes], sizes: list[int], ids: list[int]) -> None:
        """A piece of the ascending ids that end at ``path``; paths come in order, the pieces of one in order of ids."""
        if self.first is None or path != self.path:
            self._digested()
            if self.first is None:
                self._enter(0)
            same = 0
            for a, b in zip(path, self.path):  # noqa: B905
                if a != b:
                    break
                same += 1
            while len(self.open) > same + 1:
                self._leave()
            for size in sizes[same:]:
                self._enter(size)
            if self.first is None:
                self.first, self.first_nodes = path, list(self.open)
            self.path, self.digest = path, hashlib.sha256()
            self.least[self.open[-1]] = ids[0]
        else:
            self.digest.update(b",")
        self.digest.update(",".join(map(str, ids)).encode())
        self.counts[self.open[-1]] += len(ids)

    def _digested(self) -> None:
        if self.digest is not None:
            self.ends[self.open[-1]] = self.digest.hexdigest()

    def nodes(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.first is None:
            return
        self._digested()
        spine = dict(zip(self.first_nodes, _keys(self.first), strict=True)) | dict(zip(self.open, _keys(self.path), strict=True))
        while self.open:
            self._leave()
        bits = np.frombuffer(self.bits, np.uint8)
        sizes, counts, least, parents = (np.array(x, np.int64) for x in (self.sizes, self.counts, self.least, self.parents))
        opens, n = np.flatnonzero(bits), len(sizes)
        close = find_close(bits, opens)
        start, end = np.arange(n), np.arange(n) + (close - opens + 1) // 2
        depth = np.cumsum(2 * bits.astype(np.int64) - 1)[opens] - 1
        shared = np.zeros(n, bool)
        shared[list(spine)] = True

        def below(values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])
            return upto[end] - upto[start]

        members = below(counts)
        saved = below(np.where(shared, 0, (members - 1) * sizes))
        pair = np.zeros(len(bits) + 1, np.int64)
        pair[1:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
        pair[opens[shared] + 1] = 0  # leaf or not is known after the merge
        rank = np.cumsum(pair)
        leaves = rank[close] - rank[opens]
        children = np.bincount(parents[~shared], minlength=n) if n > 1 else np.zeros(n, np.int64)
        by_depth = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[by_depth], np.arange(depth.max() + 2))
        for d in range(depth.max(), 0, -1):
            level = by_depth[bounds[d]:bounds[d + 1]]
            np.minimum.at(least, parents[level], least[level])
        for k in range(0, n, 10_000):
            part = range(k, min(n, k + 10_000))
            columns = [[spine.get(i) for i in part],
                       [spine.get(p) for p in parents[k:k + 10_000].tolist()],
                       depth[k:k + 10_000], sizes[k:k + 10_000], least[k:k + 10_000],
                       [None if p in spine or p < 0 else int(least[p]) for p in parents[k:k + 10_000].tolist()],
                       members[k:k + 10_000], children[k:k + 10_000], leaves[k:k + 10_000], saved[k:k + 10_000],
                       [self.ends.get(i) for i in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _keys(path: list[bytes]) -> list[bytes]:
    """A digest of each prefix of a sequence, the empty one first."""
    out = [b""]
    for turn in path:
        out.append(hashlib.sha256(out[-1] + turn).digest()[:16])
    return out


def _shards(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = Shard()
    for b in batches:
        for path, sizes, ids in zip(*(b.column(c).to_pylist() for c in ("path", "sizes", "ids")), strict=True):
            shard.add(path, sizes, ids)
    yield from shard.nodes(schema)


def _handed_up(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of leaf marks and savings over the spine nodes at and below each, from rows in descending depth."""
    leaves: dict[bytes, int] = defaultdict(int)
    saved: dict[bytes, int] = defaultdict(int)
    for b in batches:
        out = []
        for r in b.to_pylist():
            own = (r["key"], leaves.pop(r["key"], 0) + r["leaf"], saved.pop(r["key"], 0) + r["own"])
            out.append(own)
            if r["parent_key"] is not None:
                leaves[r["parent_key"]] += own[1]
                saved[r["parent_key"]] += own[2]
        yield batch_of(out, schema)


def prefix_trie(paths: DataFrame) -> DataFrame:
    """COLUMNS of every node of the trie of (conv_id, path, sizes), one row per conversation."""
    spark = paths.sparkSession
    pieces = (paths.groupBy("path", F.shiftright("conv_id", PIECE.bit_length() - 1).alias("piece"))
              .agg(F.first("sizes").alias("sizes"), F.sort_array(F.collect_list("conv_id")).alias("ids")))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartitionByRange(shards, "path").sortWithinPartitions("path", "piece").select("path", "sizes", "ids")
    parts = written(dealt.mapInArrow(partial(_shards, arrow_schema(PARTS)), PARTS), "trie-parts")
    merged = (parts.filter("key IS NOT NULL").groupBy("key")
              .agg(*[F.max(c).alias(c) for c in ("parent_key", "depth", "size", "ends_sha256")], F.min("conv_id").alias("conv_id"),
                   *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]))
    merged = written(merged, "trie-spines")
    under = merged.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    full = merged.join(under, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    marks = full.select("key", "parent_key", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("size")).alias("own"))
    totals = (marks.repartition(1).sortWithinPartitions(F.desc("depth"))
              .mapInArrow(partial(_handed_up, arrow_schema(TOTALS)), TOTALS))
    spines = (full.join(totals, "key").withColumn("n_leaves", F.col("n_leaves") + F.col("below_leaves"))
              .withColumn("saved_tokens", F.col("saved_tokens") + F.col("below_saved")))
    spines = written(spines.select("key", "parent_key", *[c for c in COLUMNS if c != "parent_conv_id"]), "trie-spines")
    own = [F.col(c) for c in COLUMNS if c != "parent_conv_id"]
    parent = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    inner = parts.filter("key IS NULL")
    rows = (inner.filter("parent_key IS NULL").select(*own, "parent_conv_id")
            .unionByName(inner.filter("parent_key IS NOT NULL").select(*own, "parent_key").join(parent, "parent_key")
                         .select(*own, "parent_conv_id"))
            .unionByName(spines.join(parent, "parent_key", "left").select(*own, "parent_conv_id")))
    out = written(rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))).select(*COLUMNS), "trie")
    for used in (parts, merged, spines):
        drop_written(used)
    return out
