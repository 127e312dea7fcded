"""Quality classifier (operator 3): interpolated modified Kneser-Ney n-grams of trusted text, judged by perplexity.

The model predicts the next byte of a text from the ``ORDER - 1`` bytes before it (a text starts after zero bytes). Grams are
packed into longs, so keys are exact. There are two models: every trusted document is counted in one and judged by the other.
Texts are dealt to the models by hash, copies of a text alike, so no model judges a text that it has seen. Counts of the
highest order come from all trusted documents; lower orders count the different bytes before a gram.
Three discounts per model and order follow from its counts of counts. Each order's probabilities are joins of sharded count
tables: grams with the totals of their contexts and with the probabilities of their endings.

Every whole text gets its cross-entropy per byte and perplexity. If the models have at most ``BROADCAST_GRAMS`` grams they are
broadcast and looked up in numpy; above that the texts' distinct grams are joined with the sharded tables, order by order.
A text's cross-entropy, drawn to its language's median as if ``PRIOR`` more bytes had that, must not be over the language's
threshold: ``MARGIN`` above the ``QUANTILE`` of all trusted documents (of all languages where a language has fewer than
``MIN_TRUSTED`` of them). If a model has no trusted text to learn from, nothing is judged and every text that has bytes is kept.

Null and empty texts have no perplexity and are not kept. Null languages are a language of their own. Repeated rows repeat;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import arrow_schema, batch_of, histogram_quantile, map_batches, written

ORDER = 5
SYMBOLS = 256
BROADCAST_GRAMS = 4_000_000
BROADCAST_IDS = 2_000_000
PRIOR = 200
QUANTILE = 0.99
MARGIN = 0.05
MIN_TRUSTED = 50

#: Bytes of texts that are packed at once to count them.
PACKED = 4 << 20

GRAMS = "model int, gram long, n long"


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(grams of ORDER bytes ending at each byte, number of the text) over all texts."""
    pad = b"\0" * (ORDER - 1)
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(x for r in raw for x in (pad, r)), np.uint8).astype(np.uint64)
    lengths = np.array([len(r) for r in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), lengths)
    # the position of a byte: its place among all bytes, plus the padding of its text and those before
    at = np.arange(lengths.sum()) + (owner + 1) * (ORDER - 1)
    key = np.zeros(len(at), np.uint64)
    for j in range(ORDER - 1, -1, -1):
        key = (key << np.uint64(8)) | data[at - j]
    return key, owner


def judge(text: Column) -> Column:
    """The model, 0 or 1, that judges a text; the other one learns from it if it is trusted."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit("")), F.lit("trusted")), F.lit(2)).cast("int")


def _count(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(model: int, texts: list[str]) -> pa.RecordBatch:
        grams, n = np.unique(packed(texts)[0], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), model), pa.int32()), pa.array(grams.astype(np.int64)),
                                           pa.array(n.astype(np.int64))], schema=schema)

    held: dict[int, list[str]] = {0: [], 1: []}
    size = {0: 0, 1: 0}
    for b in batches:
        for text, model in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if text:
                held[model].append(text)
                size[model] += len(text)
                if size[model] >= PACKED:
                    yield counted(model, held[model])
                    held[model], size[model] = [], 0
    for model, texts in held.items():
        if texts:
            yield counted(model, texts)


def gram_counts(trusted: DataFrame, model: Column | None = None) -> DataFrame:
    """(model, gram, n) of the highest order over all texts of ``trusted``, each counted in its ``model`` (all in one if not given)."""
    model = F.lit(0) if model is None else model
    return (trusted.select("text", model.alias("model")).mapInArrow(partial(_count, arrow_schema(GRAMS)), GRAMS)
            .groupBy("model", "gram").agg(F.sum("n").alias("n")))


def _discounts(counts: DataFrame) -> dict[int, list[float]]:
    """The discounts of counts 1, 2 and 3 or more, by model."""
    out = {}
    for r in counts.groupBy("model").agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in range(1, 5)]).collect():
        y = r.n1 / (r.n1 + 2 * r.n2) if r.n1 + r.n2 else 0.5
        d = [k - (k + 1) * y * r[f"n{k + 1}"] / r[f"n{k}"] if r[f"n{k}"] else k * 0.5 for k in (1, 2, 3)]
        out[r.model] = [min(max(x, 0.01), k - 0.01) for k, x in zip((1, 2, 3), d, strict=True)]
    return out


def fit(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(model, level, gram, p) and (model, level, context, gamma) from counts (model, gram, n) of the highest order.

    ``level`` is the number of bytes of the gram; a context of level k is followed by a k-th byte.
    """
    by_level = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        ending = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("gram")
        by_level[k] = by_level[k + 1].groupBy("model", ending).agg(F.count(F.lit(1)).alias("n"))
    grams = contexts = lower = None
    for k in range(1, ORDER + 1):
        table = written(by_level[k], f"grams-{k}") if k < ORDER else counts
        d = _discounts(table)
        context = F.shiftright("gram", 8).alias("context")
        of_count = F.coalesce(F.lit(None).cast("double"), *[
            F.when(F.col("model") == m, F.when(F.col("n") == 1, a).when(F.col("n") == 2, b).otherwise(c)) for m, (a, b, c) in d.items()])
        totals = table.groupBy("model", context).agg(F.sum("n").alias("all"), (F.sum(of_count) / F.sum("n")).alias("gamma"))
        joined = table.withColumn("context", context).join(totals, ["model", "context"])
        if lower is None:
            below = F.lit(1.0 / SYMBOLS)
        else:
            joined = joined.withColumn("ending", F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))).join(
                lower.select("model", F.col("gram").alias("ending"), F.col("p").alias("below")), ["model", "ending"])
            below = F.col("below")
        p = (F.col("n") - of_count) / F.col("all") + F.col("gamma") * below
        lower = written(joined.select("model", "gram", p.alias("p")), f"probabilities-{k}")
        level = F.lit(k).alias("level")
        here = lower.select("model", level, "gram", "p"), totals.select("model", level, "context", "gamma")
        grams, contexts = here if grams is None else (grams.unionByName(here[0]), contexts.unionByName(here[1]))
    return written(grams, "model-grams"), written(contexts, "model-contexts")


class Table:
    """A hash table of 64-bit keys in numpy, for whole arrays of keys at once."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.zeros(1 << self.bits, np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = np.flatnonzero(self.keys[slot] == np.uint64(2**64 - 1))
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.values[slot[first]] = keys[left[first]], values[left[first]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, found) of each key."""
        none, mask = np.uint64(2**64 - 1), (1 << self.bits) - 1
        slot = self._slot(keys)
        held = self.keys[slot]
        found = held == keys
        out = np.where(found, self.values[slot], np.float32(0))
        left = np.flatnonzero(~found & (held != none))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & mask
            held = self.keys[slot]
            hit = held == keys[left]
            out[left[hit]], found[left[hit]] = self.values[slot[hit]], True
            go = ~hit & (held != none)
            left, slot = left[go], slot[go]
        return out, found


class Model:
    """The model's tables by level, as logs."""

    def __init__(self, grams: pa.Table, contexts: pa.Table):
        def tables(t: pa.Table, key: str, value: str) -> dict[int, Table]:
            level, k = t["level"].to_numpy(), t[key].to_numpy().astype(np.uint64)
            v = np.log(t[value].to_numpy()).astype(np.float32)
            return {i: Table(k[level == i], v[level == i]) for i in range(1, ORDER + 1)}

        self.p, self.gamma = tables(grams, "gram", "p"), tables(contexts, "context", "gamma")

    def losses(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of -log p, bytes) of each text."""
        key, owner = packed(texts)
        total = np.zeros(len(key))
        at = np.arange(len(key))
        for k in range(ORDER, 0, -1):
            logs, found = self.p[k].get(key)
            total[at[found]] += logs[found]
            at, key = at[~found], key[~found]
            gamma, _ = self.gamma[k].get(key >> np.uint64(8))  # an unseen context leaves all to the next level
            total[at] += gamma
            key = key & np.uint64((1 << (8 * (k - 1))) - 1)
        total[at] -= np.log(SYMBOLS)
        n = np.bincount(owner, minlength=len(texts))
        return -np.bincount(owner, total, len(texts)), n


SCORED = "doc_id long, lang string, n_bytes long, loss double"


def _losses_by_broadcast(docs: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((grams.toArrow(), contexts.toArrow()))
    models: dict = {}

    def run(ids: list, texts: list, langs: list, judges: list) -> dict[str, list]:
        judges, loss, n = np.array(judges), np.zeros(len(ids)), np.zeros(len(ids), np.int64)
        for m in (0, 1):
            at = np.flatnonzero(judges == m)
            if len(at):
                if m not in models:
                    models[m] = Model(*(t.filter(pc.equal(t["model"], m)) for t in shared.value))
                loss[at], n[at] = models[m].losses([texts[i] or "" for i in at])
        return {"doc_id": ids, "lang": langs, "n_bytes": n.tolist(), "loss": loss.tolist()}

    return map_batches(docs, ["doc_id", "text", "lang", "model"], SCORED, run)


def _losses_by_join(docs: DataFrame, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """The same from joins of each text's distinct grams with the tables, from the highest order down."""
    schema = "row long, model int, gram long, n long"

    def distinct(target: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, model, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if text:
                    g, n = np.unique(packed([text])[0], return_counts=True)
                    yield batch_of([(row, model, int(x), int(y)) for x, y in zip(g, n, strict=True)], target)

    rows = written(docs.select("doc_id", "lang", "text", "model").withColumn("row", F.monotonically_increasing_id()), "numbered")
    left = rows.select("row", "model", "text").mapInArrow(partial(distinct, arrow_schema(schema)), schema)
    parts = None
    for k in range(ORDER, 0, -1):
        level = grams.filter(F.col("level") == k).select("model", "gram", "p")
        both = left.join(level, ["model", "gram"], "left")
        gone = both.filter("p IS NOT NULL").select("row", (F.col("n") * F.log("p")).alias("log"))
        gamma = contexts.filter(F.col("level") == k).select("model", "context", "gamma")
        rest = both.filter("p IS NULL").withColumn("context", F.shiftright("gram", 8)).join(gamma, ["model", "context"], "left")
        backed = rest.select("row", (F.col("n") * F.log(F.coalesce("gamma", F.lit(1.0)))).alias("log"))
        parts = gone.unionByName(backed) if parts is None else parts.unionByName(gone).unionByName(backed)
        left = rest.select("row", "model", F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)).alias("gram"), "n").groupBy(
            "row", "model", "gram").agg(F.sum("n").alias("n"))
    parts = parts.unionByName(left.select("row", (-F.col("n") * float(np.log(SYMBOLS))).alias("log")))
    sums = parts.groupBy("row").agg((-F.sum("log")).alias("loss"))
    return rows.join(sums, "row", "left").select(
        "doc_id", "lang", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.coalesce("loss", F.lit(0.0)).alias("loss"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id): all documents labelled good and not toxic."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct()


def quality_scores(docs: DataFrame, labels: DataFrame, broadcast_grams: int | None = None) -> DataFrame:
    """Perplexity, threshold and verdict of every text."""
    limit = BROADCAST_GRAMS if broadcast_grams is None else broadcast_grams
    trusted = written(trusted_ids(labels), "trusted")
    # with few ids the texts need no shuffle
    ids = F.broadcast(trusted) if trusted.count() <= BROADCAST_IDS else trusted
    learnt = docs.join(ids, "doc_id", "left_semi")
    counts = written(gram_counts(learnt, 1 - judge(F.col("text"))), f"grams-{ORDER}")
    grams, contexts = fit(counts)
    both = grams.filter("level = 1").select("model").distinct().count() == 2
    score = _losses_by_broadcast if grams.count() <= limit else _losses_by_join
    losses = written(score(docs.select("doc_id", "text", "lang", judge(F.col("text")).alias("model")), grams, contexts), "losses")
    rate = F.when(F.col("n_bytes") > 0, F.col("loss") / F.col("n_bytes"))
    judged = (losses.filter((F.col("n_bytes") > 0) & F.lit(both)).join(trusted, "doc_id", "left_semi")
              .select(F.struct("lang").alias("group"), rate.alias("rate"), "n_bytes"))
    limits = written(_limits(judged), "limits")
    everywhere = limits.filter("group IS NULL").select("median", "top").collect()  # one row, or none
    m_all, t_all = everywhere[0] if everywhere else (None, None)
    own = limits.filter("group IS NOT NULL")
    out = losses.join(own, F.struct("lang").eqNullSafe(F.col("group")), "left")
    median = F.coalesce("median", F.lit(m_all).cast("double"))
    top = F.coalesce("top", F.lit(t_all).cast("double"))
    drawn = _drawn(rate, F.col("n_bytes"), F.coalesce(median, rate))
    return out.select("doc_id", "lang", "n_bytes", F.exp(rate).alias("perplexity"), F.exp(top).alias("threshold"),
                      ((F.col("n_bytes") > 0) & F.coalesce(drawn <= top, F.lit(True))).alias("kept"))


def _drawn(rate: Column, n: Column, median: Column) -> Column:
    return (rate * n + median * PRIOR) / (n + PRIOR)


def _limits(judged: DataFrame) -> DataFrame:
    """(group, median, top) per language with enough trusted documents, and over all with a null group."""
    every = judged.select(F.lit(None).cast("struct<lang:string>").alias("group"), "rate", "n_bytes")
    both = judged.unionByName(every).withColumn("group", F.to_json("group"))
    both = both.withColumn("key", F.coalesce("group", F.lit("")))
    sizes = both.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") >= MIN_TRUSTED) | (F.col("key") == ""))
    middle = histogram_quantile(both, ["key"], "rate", 0.5, "median")
    drawn = both.join(middle, "key").select("key", _drawn(F.col("rate"), F.col("n_bytes"), F.col("median")).alias("drawn"))
    top = histogram_quantile(drawn, ["key"], "drawn", QUANTILE, "q")
    table = sizes.join(middle, "key").join(top, "key")
    return table.select(F.when(F.col("key") != "", F.from_json("key", "struct<lang:string>")).alias("group"), "median",
                        (F.col("q") + MARGIN).alias("top"))
