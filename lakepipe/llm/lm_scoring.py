"""LM scoring (operator 1): a gated recurrent language model trained and applied on the corpus.

Tokens are the words between ASCII blanks with A-Z lower-cased, and one end per text. Counts of all training
tokens are gathered by a shuffle. The ``NEURAL`` most frequent tokens get output vectors of their own, in classes of
about equal sums of root counts; all other tokens fall into ``TAILS`` tail classes by their last two bytes. The
network predicts the class from its state (softmax over classes), then the word within a word class (softmax over its
words); within a tail class a token has the share (c + 0.5) / (N_t + 0.5 * (V_t + 1)) of its class's counts, where
unseen tokens share the last place. At the start its output is that of the counts alone; training moves it from there.

Training is truncated backpropagation in numpy on every training document, once and whole, in ``ROUNDS`` rounds: each takes
another share of them by hash. In a round every task trains a copy on its documents and the copies
are averaged (later rounds at smaller rates), each row of a parameter by how often the tasks used it; so scores depend on how the
input is split into tasks, as a copy takes the steps that one split gives. A task reads about ``READ`` bytes and trains or scores
about ``HELD`` tokens at a time. Windows carry the state on from a document's start to its end, in training and in scoring, so a text's score is the log10 probability
of the complete text.

``base_score`` is the unigram score with the same counts. Counts of the ``LOOKUP`` most frequent tokens of at most ``LONGEST``
bytes are broadcast (that bounds their size); those of other tokens are joined, summed up per text. Null text counts as empty: its only
token is the end. Without training texts all counts are 0. Repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _gru
from ._base import arrow_schema, batch_of, written

NEURAL = 2048
WORD_CLASSES = 32
TAILS = 64
HIDDEN = 16
LOOKUP = 1 << 18
LONGEST = 64
ROUNDS = 2
HELD = 1 << 22
READ = 1 << 24
RATE = 0.3
#: Copies are added up in so many parts first, then the parts.
PARTS = 64
END = b""

COUNTS = "word binary, n long"
SCORED = ("doc_id long, n_tokens long, n_known long, base_part double, score_part double, "
          "rare array<binary>, rare_n array<int>")
BLOCKS = "name string, block int, weight binary, total binary"
BLOCK_ROWS = 64


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def pieces(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with about READ bytes of text each time; the text is the last column."""
    size = np.cumsum(pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(size // READ)) + 1).tolist(), b.num_rows]
    for k, end in zip(cuts, cuts[1:], strict=False):
        if end > k:
            yield b.slice(k, end - k)


def all_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(``tokens`` of each text, one after the other; where those of each text start, and their number at the end)."""
    # a blank after every text makes the split end in an empty string, which is END
    ended = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ")
    split = pc.ascii_split_whitespace(pc.ascii_lower(ended))
    words, first = split.flatten().cast(pa.binary()), split.offsets.to_numpy().astype(np.int64)
    first -= first[0]
    # a blank before the first word leaves an empty string, too
    blank = pc.equal(words.take(pa.array(first[:-1])), END).to_numpy(zero_copy_only=False)
    if blank.any():
        kept = np.ones(len(words), bool)
        kept[first[:-1][blank]] = False
        words = words.filter(pa.array(kept))
        first[1:] -= np.cumsum(blank)
    return words, first


def _count(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for piece in pieces(b):
            counted = pc.value_counts(all_tokens(piece.column(0))[0])
            yield pa.RecordBatch.from_arrays(counted.flatten(), schema=schema)


def token_counts(training: DataFrame) -> DataFrame:
    """(word, c) of all training tokens."""
    return (training.select("text").mapInArrow(partial(_count, arrow_schema(COUNTS)), COUNTS)
            .groupBy("word").agg(F.sum("n").alias("c")))


@dataclass
class Vocabulary:
    """Counts of the most frequent tokens by rank, and where every token stands in the model's output."""

    words: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    least: int  # every token with this count or more and at most LONGEST bytes is in ``words``
    suffixes: dict[bytes, int]
    tail_size: np.ndarray  # N_t + 0.5 * (V_t + 1)
    layout: _gru.Layout

    def tails_of(self, words: pa.Array) -> np.ndarray:
        """The tail class of each word, by its last two bytes; 0 of others."""
        known = pa.array(list(self.suffixes), pa.binary())
        at = pc.index_in(pc.binary_slice(words, -2), value_set=known).fill_null(-1).to_numpy()
        return np.array([*self.suffixes.values(), 0], np.int32)[at]


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From a written table (word, c)."""
    total = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).collect()[0]
    # numbers of words by count, in a bounded number of steps: the lowest step that keeps within LOOKUP words
    step = F.when(F.col("c") <= 4096, F.col("c")).otherwise(4096 + F.ceil(200 * F.log(F.col("c") / 4096)))
    least, held = 1 << 62, 0
    for r in sorted(counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low")).collect(),
                    key=lambda r: -r.s):
        held += r.n
        if held > LOOKUP:
            break
        least = r.low
    top = counts.filter((F.col("c") >= least) & (F.octet_length("word") <= LONGEST)).toArrow()
    order = sorted(zip((-c for c in top["c"].to_pylist()), top["word"].to_pylist(), strict=True))
    words, c = [bytes(w) for _, w in order], np.array([-n for n, _ in order], float)
    # tail classes: sums by the last two bytes (65,793 values at most), less the words that have their own output
    sums: Counter = Counter()
    types: Counter = Counter()
    for r in counts.groupBy(F.substring("word", -2, 2).alias("s")).agg(
            F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        sums[bytes(r.s)], types[bytes(r.s)] = r.n, r.v
    for w, n in zip(words[:NEURAL], c[:NEURAL], strict=True):
        sums[w[-2:]] -= int(n)
        types[w[-2:]] -= 1
    common = sorted((s for s in sums if types[s]), key=lambda s: (-sums[s], s))[:TAILS - 1]
    suffixes = {s: i + 1 for i, s in enumerate(common)}
    n_t, v_t = np.zeros(TAILS), np.zeros(TAILS)
    for s, n in sums.items():
        n_t[suffixes.get(s, 0)] += n
        v_t[suffixes.get(s, 0)] += types[s]
    size = n_t + 0.5 * (v_t + 1)
    return Vocabulary(words, c, int(total.n), int(total.v), least, suffixes, size,
                      _gru.make_layout(c[:NEURAL], size, WORD_CLASSES))


class Reader:
    """Texts to symbols, with the parts of both scores that counts alone give."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.words = pa.array(v.words, pa.binary())
        n = min(NEURAL, len(v.words))
        tails = v.tails_of(self.words[n:])
        self.symbol = np.concatenate([np.arange(n), n + tails, [0]]).astype(np.int32)
        self.n, self.log_size = n, np.log10(v.tail_size)
        self.log_count = np.append(np.log10(v.counts + 0.5), 0.0)
        self.in_tail = np.append(np.where(np.arange(len(v.words)) < n, 0.0, self.log_count[:-1]), 0.0)
        self.in_tail[n:-1] -= self.log_size[tails]

    def _find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        words, first = all_tokens(texts)
        ranks = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        rare_at = np.flatnonzero(ranks < 0)
        rare = words.take(pa.array(rare_at))
        tails = self.v.tails_of(rare)
        symbols = self.symbol[ranks]
        symbols[rare_at] = self.n + tails
        return symbols, first, ranks, rare_at, tails, rare

    def symbols(self, texts: pa.Array) -> list[np.ndarray]:
        """Symbols of each text."""
        symbols, first, *_ = self._find(texts)
        return [symbols[a:b] for a, b in zip(first, first[1:], strict=False)]

    def read(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, float, float, list[bytes]]]:
        """(symbols, base part, score part, tokens whose counts are not at hand) of each text."""
        symbols, first, ranks, rare_at, tails, rare = self._find(texts)
        if not len(texts):
            return
        of_tail = self.in_tail[ranks]
        of_tail[rare_at] = -self.log_size[tails]
        base, part = (np.add.reduceat(x, first[:-1]) for x in (self.log_count[ranks], of_tail))
        at, words = np.searchsorted(rare_at, first), rare.to_pylist()
        for k in range(len(texts)):
            yield symbols[first[k]:first[k + 1]], float(base[k]), float(part[k]), words[at[k]:at[k + 1]]


def _train(vocab, parameters, rate: float, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One copy trained on the texts of a task: sums of its changes, weighted by use, in blocks of rows."""
    reader, held, n = None, [], 0
    before = parameters.value
    after = {k: v.copy() for k, v in before.items()}
    progress = _gru.new_progress(after)
    for b in batches:
        reader = reader or Reader(vocab.value)
        for piece in pieces(b):
            for symbols in reader.symbols(piece.column(0)):
                held.append(symbols)
                n += len(symbols)
                if n >= HELD:
                    _gru.train(after, vocab.value.layout, held, rate=rate, progress=progress)
                    held, n = [], 0
    if reader is None:
        return
    used = _gru.train(after, vocab.value.layout, held, rate=rate, progress=progress)
    for name, v in after.items():
        w = used[name].astype(np.float32)
        change = (v - before[name]) * w[:, None]
        rows = [(name, k // BLOCK_ROWS, w[k:k + BLOCK_ROWS].tobytes(), change[k:k + BLOCK_ROWS].tobytes())
                for k in range(0, len(v), BLOCK_ROWS) if w[k:k + BLOCK_ROWS].any()]
        yield batch_of(rows, schema)


def _add(group: pd.DataFrame) -> pd.DataFrame:
    """The sum of a block over tasks."""
    add = lambda c: np.sum([np.frombuffer(x, np.float32) for x in group[c]], axis=0, dtype=np.float64)
    return pd.DataFrame({"name": group["name"][:1], "block": group["block"][:1],
                         "weight": [add("weight").astype(np.float32).tobytes()],
                         "total": [add("total").astype(np.float32).tobytes()]})


def fit(training: DataFrame, vocab, layout: _gru.Layout) -> dict[str, np.ndarray]:
    """Parameters after ROUNDS rounds of training copies and averaging them."""
    spark = training.sparkSession
    p = _gru.new_parameters(layout, HIDDEN)
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit("sgd")), F.lit(ROUNDS))
    for k in range(ROUNDS):
        shared = spark.sparkContext.broadcast(p)
        parts = (training.filter(drawn == k).select("text")
                 .mapInArrow(partial(_train, vocab, shared, RATE / (k + 1), arrow_schema(BLOCKS)), BLOCKS))
        # a block holds BLOCK_ROWS rows of one parameter; what is collected is the size of the model
        parts = parts.withColumn("part", F.spark_partition_id() % PARTS)
        summed = (parts.groupBy("name", "block", "part").applyInPandas(_add, BLOCKS)
                  .groupBy("name", "block").applyInPandas(_add, BLOCKS))
        p = {name: v.copy() for name, v in p.items()}
        for r in summed.collect():
            at = r.block * BLOCK_ROWS
            w = np.frombuffer(r.weight, np.float32)
            total = np.frombuffer(r.total, np.float32).reshape(len(w), -1)
            p[r["name"]][at:at + len(w)] += total / np.maximum(w, 1e-9)[:, None]
    return p


def _scored(vocab, parameters, schema: pa.Schema, held: list[tuple]) -> pa.RecordBatch:
    ids, symbols, base, part, rare = zip(*held, strict=True)
    neural = _gru.score(parameters.value, vocab.value.layout, list(symbols))
    counted = [Counter(r) for r in rare]
    return batch_of([(i, len(s), len(s) - len(r), x, float(y + z), list(c), list(c.values()))
                     for i, s, r, x, y, z, c in zip(ids, symbols, rare, base, part, neural, counted, strict=True)], schema)


def _score(vocab, parameters, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, held, n = None, [], 0
    for b in batches:
        reader = reader or Reader(vocab.value)
        for piece in pieces(b):
            for i, read in zip(piece.column(0).to_pylist(), reader.read(piece.column(1)), strict=True):
                held.append((i, *read))
                n += len(read[0])
                if n >= HELD:
                    yield _scored(vocab, parameters, schema, held)
                    held, n = [], 0
    if held:
        yield _scored(vocab, parameters, schema, held)


def lm_scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of every text by a model of the texts that are not held out."""
    spark = docs.sparkSession
    training = docs.filter(~held_out)
    counts = written(token_counts(training), "token-counts")
    v = vocabulary(counts)
    vocab = spark.sparkContext.broadcast(v)
    parameters = spark.sparkContext.broadcast(fit(training, vocab, v.layout))
    parts = docs.select("doc_id", "text").mapInArrow(partial(_score, vocab, parameters, arrow_schema(SCORED)), SCORED)
    # written before it is joined with itself: the row numbers are then fixed
    parts = written(parts.withColumn("row", F.monotonically_increasing_id()), "lm-parts")
    rare = parts.select("row", F.inline(F.arrays_zip(F.col("rare").alias("w"), F.col("rare_n").alias("k"))).alias("w", "k"))
    known = counts.filter((F.col("c") < v.least) | (F.octet_length("word") > LONGEST))
    c = F.coalesce("c", F.lit(0))
    sums = (rare.join(known, F.col("w") == F.col("word"), "left").groupBy("row")
            .agg(F.sum(F.col("k") * F.log10(c + 0.5)).alias("logs"), F.sum(F.when(c > 0, F.col("k"))).alias("seen")))
    out = parts.drop("rare", "rare_n").join(sums.withColumnRenamed("row", "r"), F.col("row") == F.col("r"), "left")
    logs = F.coalesce("logs", F.lit(0.0))
    each = float(np.log10(v.total + 0.5 * (v.distinct + 1)))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens",
                      (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
                      F.lit(v.total).cast("long").alias("train_tokens"),
                      (F.col("base_part") + logs - F.col("n_tokens") * each).alias("base_score"),
                      (F.col("score_part") + logs).alias("score"))
