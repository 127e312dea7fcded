"""Hard-negative mining (operator 11): slot-decomposed selection.

Rows are vectors with an id and a label; a chosen part of them are anchors. A row's score is its integer inner product
with the anchor, after each component x became floor(256 * x). An anchor's positives are its ``POSITIVES`` best other rows of
its label. The negatives of a positive are rows of other labels whose score lies in a window relative to the positive's:
from ``LEAST`` to ``MOST`` percent of it. Of each window the best ``TOP`` are returned. Higher scores come first, ties by id.

The windows of one anchor overlap, so they are not searched one by one. Their upper limits, in descending order, split
all scores into disjoint slots: a score belongs to the slot of the least upper limit that is not below it. Each task
keeps the best ``TOP`` of every slot of every anchor and drops the rest while it reads; what tasks kept is cut to the
best ``TOP`` a slot once more, before and after the shuffle. Then one pass per anchor from the lowest slot upwards merges
each slot's list into the list of all lower ones: the best ``TOP`` of all scores up to a positive's upper limit. Those not
below the lower limit are the answer, as the list is in descending order.

Rows are dealt to ``GROUPS`` row groups in turn and anchors to groups of about ``BLOCK``; a row group and an anchor group meet in one
task, which holds the anchors and reads the rows in Arrow batches, one matrix product each. So a task's memory is that of one anchor
group and does not grow with the data. Labels never decide where a row goes: one that a third of all rows have is no
hot key. Nothing passes through the driver but the number of anchors.

Rows whose id, label or vector is null, or with a null or non-finite component, take no part. Rows equal in id, label and
vector count once; rows of one id that differ in the rest are rows of their own (as anchors too; none is another's positive
or negative). A missing component of a shorter vector counts as 0, an empty vector scores 0. Scores are exact; components and
scores outside the range of long are set to its ends. An anchor without positives, or a positive without a row in its window
(any with a negative score), has no result. Empty tables give an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._base import arrow_schema, batch_of, drop_written, written

POSITIVES = 5
TOP = 10
#: A negative's score in percent of the positive's.
LEAST, MOST = 30, 90
GROUPS, BLOCK = 64, 8192
#: Rows of one matrix product.
TILE = 2048
LONG = (1 << 63) - 1

FOUND = "anchor long, slot int, score long, id long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = rows.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))
    if out.schema["vector"].dataType.elementType != T.FloatType():
        out = out.withColumn("vector", F.col("vector").cast("array<double>"))
    return out.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).filter(finite)


def whole_numbers(flat: np.ndarray) -> np.ndarray:
    """floor(256 * x), within the range of long."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * 256)
    most = np.abs(scaled).max(initial=0)
    if most < 1 << 62:
        return scaled.astype(np.int64)
    whole = [LONG if x >= LONG else -LONG if x <= -LONG else int(x) for x in scaled.ravel()]
    return np.array(whole, np.int64).reshape(scaled.shape)


class Vectors:
    """Ids, labels and vectors (a matrix of whole numbers, padded with zeros) of some rows."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
        vectors = batch.column("vector")
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat, dims = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64), sizes.max(initial=0)
        if (sizes == dims).all():
            table = flat.reshape(len(sizes), dims)
        else:
            table = np.zeros((len(sizes), dims))
            table[np.arange(dims) < sizes[:, None]] = flat
        self.whole = whole_numbers(table)
        self.most = float(np.abs(self.whole.astype(np.float64)).max(initial=0))
        self.doubles = self.whole.astype(np.float64)

    def scores(self, rows: Vectors, first: int, end: int) -> np.ndarray:
        """Scores of ``rows`` first to end (columns) for these vectors, as longs."""
        m = min(self.whole.shape[1], rows.whole.shape[1])
        if self.most * rows.most * m < 1 << 53:  # every partial sum is a whole number that a double holds
            return (self.doubles[:, :m] @ rows.doubles[first:end, :m].T).astype(np.int64)
        exact = self.whole[:, :m].astype(object) @ rows.whole[first:end, :m].astype(object).T
        return np.clip(exact, -LONG, LONG).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` distinct pairs: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores))
    s, i = scores[order], ids[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])
    return s[new][:n], i[new][:n]


class Kept:
    """The best ``n`` entries of each slot of one anchor; ``least`` of a full slot lets others pass by unread."""

    def __init__(self, slots: int, n: int):
        self.n = n
        self.lists = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(slots)]
        self.least = [-LONG - 1] * slots

    def add(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        s, i = self.lists[slot]
        s, i = self.lists[slot] = best(np.concatenate([s, scores]), np.concatenate([i, ids]), self.n)
        if len(s) == self.n:
            self.least[slot] = int(s[-1])


def add_positives(kept: Kept, scores: np.ndarray, same: np.ndarray, ids: np.ndarray) -> None:
    at = np.flatnonzero(same & (scores >= kept.least[0]))
    if len(at):
        kept.add(0, scores[at], ids[at])


def limits(positives: list[int]) -> tuple[list[int], list[int], int]:
    """Upper limits of the slots in ascending order, each positive's slot (-1: empty window), and the least lower limit."""
    ends = [(-(-LEAST * p // 100), MOST * p // 100) for p in positives]
    uppers = sorted({u for low, u in ends if low <= u})
    slots = [uppers.index(u) if low <= u else -1 for low, u in ends]
    return uppers, slots, min((low for low, u in ends if low <= u), default=0)


def add_negatives(kept: Kept, uppers: np.ndarray, lowest: int, scores: np.ndarray, other: np.ndarray, ids: np.ndarray) -> None:
    at = np.flatnonzero(other & (scores <= uppers[-1]) & (scores >= max(lowest, min(kept.least))))
    slot = np.searchsorted(uppers, scores[at])
    for j in range(len(uppers)):
        mine = at[(slot == j) & (scores[at] >= kept.least[j])]
        if len(mine):
            kept.add(j, scores[mine], ids[mine])


def merge_upwards(slots: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """For each slot the best ``TOP`` (score, id) of it and all lower ones, from the lowest slot upwards."""
    out, below = [], []
    for entries in slots:
        below = sorted({*entries, *below}, key=lambda e: (-e[0], e[1]))[:TOP]
        out.append(below)
    return out


class Group:
    """The anchors of one group and their lists: positives, or slots of negatives where the anchors bring their positives."""

    def __init__(self, windows: bool):
        self.windows, self.parts = windows, []

    def add_anchors(self, batch: pa.RecordBatch) -> None:
        lists = []
        for positives in batch.column("positives").to_pylist():
            if self.windows:
                uppers, _, lowest = limits(positives)
                lists.append((Kept(len(uppers), TOP), np.array(uppers, np.int64), lowest))
            else:
                lists.append((Kept(1, POSITIVES),))
        for k in range(0, batch.num_rows, 512):
            part = batch.slice(k, 512)
            self.parts.append((Vectors(part), part.column("anchor").to_pylist(), lists[k:k + 512]))

    def add_rows(self, batch: pa.RecordBatch) -> None:
        rows = Vectors(batch)
        for first in range(0, batch.num_rows, TILE):
            ids, labels = rows.ids[first:first + TILE], rows.labels[first:first + TILE]
            for anchors, _, lists in self.parts:
                scores = anchors.scores(rows, first, first + TILE)
                for k, kept in enumerate(lists):
                    same, others = labels == anchors.labels[k], ids != anchors.ids[k]
                    if not self.windows:
                        add_positives(*kept, scores[k], same & others, ids)
                    elif len(kept[1]):
                        add_negatives(*kept, scores[k], ~same & others, ids)

    def found(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for _, numbers, lists in self.parts:
            yield batch_of([(number, j, s, i) for number, kept in zip(numbers, lists, strict=True)
                            for j, (scores, ids) in enumerate(kept[0].lists)
                            for s, i in zip(scores.tolist(), ids.tolist(), strict=True)], schema)


def _tiles(windows: bool, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by pair of groups, anchors before rows: the lists of each pair."""
    current, group = None, Group(windows)
    for b in batches:
        keys = b.column("met").to_numpy()
        kinds = b.column("anchor").is_valid().to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])) + 1).tolist(), b.num_rows]
        for first, end in zip(cuts[:-1], cuts[1:], strict=True):
            if first == end:
                continue
            if keys[first] != current:
                yield from group.found(schema)
                current, group = keys[first], Group(windows)
            part = b.slice(first, end - first)
            group.add_anchors(part) if kinds[first] else group.add_rows(part)
    yield from group.found(schema)


def _searched(rows: DataFrame, anchors: DataFrame, groups: int, n: int) -> DataFrame:
    """FOUND: the best ``n`` entries of each slot of each anchor over all rows; anchors may bring ``positives``."""
    windows = "positives" in anchors.columns
    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none = F.lit(None).cast("array<long>")
    dealt = rows.select("id", "label", "vector", F.lit(None).cast("long").alias("anchor"), none.alias("positives"),
                        (F.monotonically_increasing_id() % GROUPS).cast("int").alias("r"), each(groups).alias("g"))
    held = anchors.select("id", "label", "vector", "anchor", "positives" if windows else none.alias("positives"),
                          each(GROUPS).alias("r"), F.pmod(F.xxhash64("anchor"), F.lit(groups)).cast("int").alias("g"))
    met = (dealt.unionByName(held).withColumn("met", F.col("g") * GROUPS + F.col("r")).drop("g", "r")
           .repartition(groups * GROUPS, "met").sortWithinPartitions("met", F.col("anchor").isNull()))
    found = met.mapInArrow(partial(_tiles, windows, arrow_schema(FOUND)), FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    distinct = found.dropDuplicates(["anchor", "slot", "score", "id"])
    return distinct.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n).drop("n")


def _answers(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of an anchor from its positives and slots."""
    for b in batches:
        out = []
        for row in b.to_pylist():
            positives = sorted(((p["score"], p["id"]) for p in row["positives"]), key=lambda e: (-e[0], e[1]))
            uppers, slots, _ = limits([s for s, _ in positives])
            found: list[list[tuple[int, int]]] = [[] for _ in uppers]
            for e in row["negatives"]:
                found[e["slot"]].append((e["score"], e["id"]))
            merged = merge_upwards(found)
            for (score, positive), slot in zip(positives, slots, strict=True):
                inside = [e for e in merged[slot] if 100 * e[0] >= LEAST * score] if slot >= 0 else []
                out += [(row["anchor_id"], positive, k, e[1], score, e[0]) for k, e in enumerate(inside, 1)]
        yield batch_of(out, schema)


def hard_negatives(rows: DataFrame, vec_id: Column, label: Column, vector: Column, is_anchor: Column) -> DataFrame:
    """RESULT: the best negatives of each positive of each anchor (``is_anchor`` is over the columns id and label)."""
    whole = usable(rows, vec_id, label, vector)
    # equal anchors are one, with a number of its own
    anchors = written(whole.filter(is_anchor).distinct().withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    groups = 1 + anchors.count() // BLOCK
    positives = written(_searched(whole, anchors, groups, POSITIVES).groupBy("anchor")
                        .agg(F.collect_list(F.struct("score", "id")).alias("positives")), "positives")
    limited = anchors.join(positives.select("anchor", F.col("positives.score").alias("positives")), "anchor")
    negatives = (_searched(whole, limited, groups, TOP).groupBy("anchor")
                 .agg(F.collect_list(F.struct("slot", "score", "id")).alias("negatives")))
    lists = (positives.join(negatives, "anchor").join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor")
             .select("anchor_id", "positives", "negatives"))
    out = written(lists.mapInArrow(partial(_answers, arrow_schema(RESULT)), RESULT), "hard-negatives")
    drop_written(anchors)
    drop_written(positives)
    return out
