"""MinHash near-dedup (operator 9): SuperMinHash signatures, banding, verification, grouping.

A document's set holds its distinct shingles of ``words`` words (A-Z lower-cased; with fewer words the whole
sequence). Documents are linked if 100 * intersection >= 80 * union of their full sets, and grouped over links.

1. Documents with equal sets become one node, named after their least id, so copies cost nothing further.
2. A signature of ``PLACES`` places (``_minhash.super_minhash``) is cut into ``BANDS`` bands; nodes that agree on a band share a
   bucket. Two nodes of similarity 0.8 share none with a probability of 6 in 100,000, at 0.85 of 2 in 10 million.
3. ``ROUNDS`` times, each bucket takes a node of its largest group so far as its hub, and every node outside that group is
   compared in full with one of its hubs, the one that it shares most buckets with; if they are linked it joins the
   hub's group. A bucket of thousands of near copies needs a comparison per node, not per pair.
4. Connected components of all links so far, then what is left: pairs of one bucket in different components. A bucket's
   nodes are held against those outside its largest component in blocks of ``BLOCK`` nodes by signature; pairs whose
   signatures agree in ``NEAR`` places or more are compared in full. Nothing is capped: a pair of a
   bucket is left out only if its documents are in one component already or their signatures are further apart, which
   befalls 2 in 100,000 of the pairs at exactly 0.8 that no hub joined, besides the 6 in 100,000 that share no bucket.

Links are confirmed on full sets from the texts. Documents without words are linked with nothing. Rows of one
id are one document: they are grouped together through that id, and equal rows give equal results. Rows without an
id are linked with nothing: component null, kept. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import Cache, arrow_schema, batch_of, bitmap_of, drop_written, in_bitmap, unpacked, whole_rows, written
from ._components import components
from ._minhash import band_keys, shared, shingle_set, super_minhash

PLACES = 192
BANDS = 32
PERCENT = 80
NEAR = 130
ROUNDS = 2
BLOCK = 256

SIGNED = "doc_id long, n_shingles long, digest binary, low binary, bands array<long>"


def _sign(words: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, 2000):
            rows = []
            for i, text in zip(*(c.to_pylist() for c in b.slice(k, 2000).columns), strict=True):
                s = shingle_set(text, words)
                if len(s):
                    sig = super_minhash(s, PLACES)
                    rows.append((i, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                 sig.astype(np.uint8).tobytes(), band_keys(sig, BANDS).tolist()))
                else:
                    rows.append((i, 0, None, None, None))
            yield batch_of(rows, schema)


def _pick(bitmap, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = bitmap.value
    for b in batches:
        rows = [(i, t) for i, t in zip(*(c.to_pylist() for c in b.columns), strict=True)
                if i is not None and in_bitmap(known, i)]
        yield batch_of(rows, schema)


def _confirm(words: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (u, v, top, u_text, v_text), those whose full sets are similar enough."""
    recent = Cache(lambda text: shingle_set(text, words), 64, 1 << 20)  # rows of one v come one after the other
    for b in batches:
        for k in range(0, b.num_rows, 500):
            rows = []
            for u, v, top, a, c in zip(*(c.to_pylist() for c in b.slice(k, 500).columns), strict=True):
                x, y = shingle_set(a, words), recent[c]
                both = shared(x, y)
                if 100 * both >= PERCENT * (len(x) + len(y) - both):
                    rows.append((u, v, top))
            yield batch_of(rows, schema)


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each unit (first column), from batches sorted by unit."""
    unit, rows = None, []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if r[0] != unit and rows:
                yield rows
                rows = []
            unit = r[0]
            rows.append(r)
    if rows:
        yield rows


def _near_pairs(rows: list[tuple]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Each left row of a unit and the right rows of other components with a near signature."""
    left, right = [r for r in rows if r[1]], [r for r in rows if not r[1]]
    if left and right:
        c = np.frombuffer(b"".join(r[4] for r in right), np.uint8).reshape(len(right), -1)
        groups = np.array([r[3] for r in right])
        for r in left:
            same = (c == np.frombuffer(r[4], np.uint8)).sum(1)
            found = np.flatnonzero((same >= NEAR) & (groups != r[3]))
            if len(found):
                yield r, [right[j] for j in found]


def _in_near_pairs(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (unit, left, node, component, low), those in any near pair of their unit."""
    for rows in _by_unit(batches):
        found = {}
        for r, others in _near_pairs(rows):
            found[r[1], r[2]] = r
            found.update(((o[1], o[2]), o) for o in others)
        if found:
            yield batch_of(list(found.values()), schema)


def _links_of_units(words: int, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) between components among rows (unit, left, node, component, low, text).

    Within a unit a node that is linked with a component needs no second link to it.
    """
    recent = Cache(lambda text: shingle_set(text, words), 2 * BLOCK, 1 << 20)
    for rows in _by_unit(batches):
        out, joined = [], {}

        def find(c: int, joined: dict = joined) -> int:
            while c in joined:
                c = joined[c]
            return c

        for r, others in _near_pairs(rows):
            for o in others:
                a, c = find(r[3]), find(o[3])
                if a != c:
                    x, y = recent[r[5]], recent[o[5]]
                    both = shared(x, y)
                    if 100 * both >= PERCENT * (len(x) + len(y) - both):
                        out.append((r[2], o[2]))
                        joined[max(a, c)] = min(a, c)
        if out:
            yield batch_of(out, schema)


LINKS = "u long, v long, top long"


def _verified(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Links among pairs (u, v, top). ``texts`` has one text per node, so a hot v only repeats v's own text."""
    u = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("u_text"))
    v = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("v_text"))
    rows = pairs.join(u, "u").join(v, "v").select("u", "v", "top", "u_text", "v_text")
    return rows.mapInArrow(partial(_confirm, words, arrow_schema(LINKS)), LINKS)


def _largest(members: DataFrame) -> DataFrame:
    """(key, top, hub): the largest group of each bucket and its member of the least hash."""
    groups = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.min("mixed").alias("mixed"))
    best = F.max(F.struct("n", (-F.col("component")).alias("c"), "mixed"))
    # the mixing of ids is a bijection on the struct (hash, id): the id comes with the least hash
    return groups.groupBy("key").agg(best.alias("b"), F.count(F.lit(1)).alias("groups")).filter("groups > 1").select(
        "key", (-F.col("b.c")).alias("top"), F.col("b.mixed.node").alias("hub"))


def _star_pairs(members: DataFrame) -> DataFrame:
    """One pair (u, v) for every node outside the largest group of a bucket: its most frequent hub, of group top."""
    of_hub = (members.join(_largest(members), "key").filter(F.col("component") != F.col("top"))
              .groupBy("node", "hub", "top").agg(F.count(F.lit(1)).alias("n")))
    best = of_hub.groupBy("node").agg(F.max(F.struct("n", "hub", "top")).alias("b"))
    return best.select(F.col("node").alias("u"), F.col("b.hub").alias("v"), F.col("b.top").alias("top"))


def _cross_links(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Links (u, v) between nodes of one bucket in different components."""
    marked = members.join(_largest(members).select("key", "top"), "key")
    sizes = marked.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_right"),
        F.ceil(F.sum((F.col("component") != F.col("top")).cast("int")) / BLOCK).cast("int").alias("n_left"))
    rows = marked.join(sizes.withColumnRenamed("key", "k"), F.col("key") == F.col("k"))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    unit = lambda left, right: F.xxhash64("key", left, right).alias("unit")
    take = lambda side: ["unit", F.lit(side).alias("left"), "node", "component", "low"]
    left = (rows.filter(F.col("component") != F.col("top"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("n_right") - 1)).alias("r"))
            .select("*", unit(part("n_left"), F.col("r"))).select(*take(True)))
    right = (rows.select("*", F.explode(F.sequence(F.lit(0), F.col("n_left") - 1)).alias("l"))
             .select("*", unit(F.col("l"), part("n_right"))).select(*take(False)))
    # a unit has 2 * BLOCK rows or so; only nodes in a near pair get their text
    schema = "unit long, left boolean, node long, component long, low binary"
    near = (left.unionByName(right).repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(partial(_in_near_pairs, arrow_schema(schema)), schema))
    with_text = near.join(texts.select(F.col("doc_id").alias("n"), "text"), F.col("node") == F.col("n")).drop("n")
    schema = "u long, v long"
    return (with_text.repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(partial(_links_of_units, words, arrow_schema(schema)), schema).distinct())


def _groups(nodes: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(node, component) of the nodes that are linked with another."""
    exploded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    shared_keys = written(exploded.join(buckets, "key"), "buckets")
    near = shared_keys.sparkSession.sparkContext.broadcast(bitmap_of(shared_keys, "node"))
    schema = "doc_id long, text string"
    # the texts of nodes that share a bucket, written once: each comparison joins these only
    wanted = written(texts.mapInArrow(partial(_pick, near, arrow_schema(schema)), schema).dropDuplicates(["doc_id"]), "node-texts")

    def members(groups: DataFrame | None, salt: int) -> DataFrame:
        rows = shared_keys.withColumn("component", F.col("node")) if groups is None else (
            shared_keys.join(groups.withColumnRenamed("component", "c"), "node", "left")
            .withColumn("component", F.coalesce("c", "node")))
        return rows.select("key", "node", "component", F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node").alias("mixed"))

    # a node's group is that of the last hub it is linked with: part of its component, known without following links
    links = groups = None
    for k in range(ROUNDS):
        new = _verified(_star_pairs(members(groups, k)), wanted, words).withColumn("round", F.lit(k))
        links = written(new if links is None else links.unionByName(new), "links")
        groups = links.groupBy(F.col("u").alias("node")).agg(F.max(F.struct("round", "top")).alias("m")).select(
            "node", F.col("m.top").alias("component"))
    found = written(components(links.select("u", "v")), "components")
    last = written(_cross_links(members(found, ROUNDS).join(nodes.select("node", "low"), "node"), wanted, words), "links")
    if last.take(1):  # stars of the components found and the links between them
        found = written(components(last.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v")))),
                        "components")
    drop_written(shared_keys)
    drop_written(wanted)
    return found


def near_dedup(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    texts = docs.select("doc_id", "text")
    signed = written(texts.mapInArrow(partial(_sign, words, arrow_schema(SIGNED)), SIGNED), "signatures")
    nodes = written(signed.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
                    .agg(F.min("doc_id").alias("node"), F.first("low").alias("low"), F.first("bands").alias("bands")), "nodes")
    groups = _groups(nodes, texts, words)
    names = nodes.select(F.col("digest").alias("d"), "node").join(groups, "node", "left").select(
        "d", F.coalesce("component", "node").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "digest").join(names, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, words: int = 5) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group, with their columns as they were."""
    gone = near_dedup(docs, words).filter(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return unpacked(whole_rows(docs).join(gone, F.col("whole.doc_id") == F.col("gone"), "left_anti"), docs.columns)
