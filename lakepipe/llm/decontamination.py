"""Benchmark decontamination (operator 10): SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Words are those between ASCII blanks, with A-Z lower-cased; shingles are ``WORDS`` words long (an item of
fewer words is one shingle). A document leaks an item if one of its windows of the item's number of words
(the whole text, if it is shorter) has a weighted similarity of ``SIMILARITY`` or more with the item: shared
shingles over all shingles, each counted as often as it occurs.

1. Windows. Moving a window right to the first of its shingles that the item has loses no shared shingle, so
   only windows that begin at such a shingle (or end with the text) can be the best one. A bitmap of the
   items' shingle hashes finds these places inside a text's row, a join on the hash confirms them; no other
   row leaves the scan.
2. SimHash. Each of 64 bits is the majority over the window's shingle hashes, counted in packed fields.
3. Index. Two fingerprints within ``RADIUS`` bits agree in one of ``RADIUS + 1`` blocks, so joining
   windows and items on (item, block, value) finds every pair within the radius. At the similarity asked for a pair's
   expected distance is 9.7 bits with a deviation of 2.9; 20 bits leave out fewer than one in 5,000 of pairs
   exactly at the limit and none that are equal. Blocks for so wide a radius have three or four bits, and most pairs share one:
   which items a window may hold is decided by the shingle join of step 1, and the index with its exact distance
   only spares step 4 the pairs that are far apart. A smaller radius would select better and lose pairs at the limit.
4. The similarity of what remains is computed in full.

Result: one row per document and leaked item, with the best window. Null and blank texts and items have no
shingles and leak nothing; repeated rows of a document or item give one row; ids may be null; other columns
are ignored. All steps are DataFrame expressions. The benchmark's tables are broadcast only if they hold
at most ``BROADCAST_SHINGLES`` shingles; above that all joins are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import let, unpacked, whole_rows, word_array

WORDS = 5
SIMILARITY_PERCENT = 80
RADIUS = 20
BROADCAST_SHINGLES = 200_000
BITMAP_BITS = 1 << 20


def shingles(words: Column, k: int) -> Column:
    """Hashes of the runs of ``k`` words, in order; none if there are fewer words."""
    return F.when(F.size(words) < k, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - k),
                    lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))


def _constant_array(values: list[int]) -> Column:
    """An array constant, folded when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def simhash(hashes: Column, most: int) -> Column:
    """64-bit SimHash of an array of at most ``most`` 64-bit hashes.

    Counts of several bits share one long; a field is wide enough that ``most`` never reaches its top bit.
    """
    width = next(w for w in (8, 16, 32) if most < 1 << (w - 1))
    per = 64 // width
    spread = _constant_array([sum((v >> j & 1) << (width * j) for j in range(per)) for v in range(1 << per)])
    digit = lambda h, a: F.shiftrightunsigned(h, a * per).bitwiseAND(F.lit((1 << per) - 1)).cast("int")
    zero = F.struct(*[F.lit(0).cast("long").alias(f"a{a}") for a in range(width)])
    counts = F.aggregate(hashes, zero, lambda acc, h: F.struct(
        *[(acc[f"a{a}"] + F.get(spread, digit(h, a))).alias(f"a{a}") for a in range(width)]))

    def bits(acc_and_size: Column) -> Column:
        half = acc_and_size["n"] / 2
        total = F.lit(0).cast("long")
        for b in range(64):
            field = F.shiftrightunsigned(acc_and_size["c"][f"a{b // per}"], width * (b % per)).bitwiseAND(
                F.lit((1 << width) - 1))
            one = (1 << b) - (1 << 64 if b == 63 else 0)
            total = total.bitwiseOR(F.when(field > half, F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
        return total

    return let(F.struct(counts.alias("c"), F.size(hashes).alias("n")), bits)


def blocks(fingerprint: Column) -> Column:
    """The RADIUS + 1 blocks of a fingerprint, as an array of values."""
    n = RADIUS + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).cast("int")
                     for a, b in zip(edges, edges[1:], strict=False)])


def _shared(a: Column, b: Column) -> Column:
    """Size of the intersection of two arrays, each value as often as it occurs in both."""
    count = lambda arr, x: F.size(F.filter(arr, lambda y: y == x))
    both = F.array_intersect(a, b)
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(both)).otherwise(
        F.aggregate(both, F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x))))


def _bitmap(hashes: DataFrame) -> list[int]:
    """Bits of the hashes' low digits, as longs: a constant size for any number of hashes."""
    low = F.col("hash").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = (hashes.select(F.shiftright(low, 6).alias("w"), low.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .distinct().groupBy("w").agg(F.collect_list("b").alias("bits")).collect())
    out = [0] * (BITMAP_BITS // 64)
    for r in words:
        v = sum(1 << b for b in r.bits)
        out[r.w] = v - (1 << 64) if v >> 63 else v
    return out


def _windows(docs: DataFrame, bitmap: list[int], k: int, longest: int) -> DataFrame:
    """(doc_id, hash, at, size, base, part): places whose shingle may be an item's, and the shingles around them."""
    table = _constant_array(bitmap)

    def in_bitmap(h: Column) -> Column:
        low = h.bitwiseAND(F.lit(BITMAP_BITS - 1))
        return F.getbit(F.get(table, F.shiftright(low, 6).cast("int")), low.bitwiseAND(F.lit(63)).cast("int")) == 1

    def places(hs: Column) -> Column:
        base = lambda i: F.greatest(F.lit(0), F.least(i, F.size(hs) - longest))
        return F.when(F.size(hs) == 0, F.array()).otherwise(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(hs) - 1), lambda i: in_bitmap(F.get(hs, i))),
            lambda i: F.struct(F.get(hs, i).alias("hash"), i.alias("at"), F.size(hs).alias("size"),
                               base(i).alias("base"), F.slice(hs, base(i) + 1, longest).alias("part"))))

    found = let(word_array(F.col("text"), lower=True), lambda w: let(shingles(w, k), places))
    return docs.select("doc_id", F.inline(found))


def _of_length(docs: DataFrame, items: DataFrame, k: int, longest: int, small: bool) -> DataFrame:
    sized = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    keys = items.select("item_id", F.size("item").alias("m"), F.explode(F.array_distinct("item")).alias("hash"))
    hits = _windows(docs, _bitmap(keys), k, longest).join(sized(keys), "hash")
    start = F.greatest(F.lit(0), F.least(F.col("at"), F.col("size") - F.col("m")))
    windows = hits.select("doc_id", "item_id", start.alias("start"),
                          F.slice("part", start - F.col("base") + 1, F.col("m")).alias("window"))
    prints = windows.withColumn("print", simhash(F.col("window"), longest))
    probe = prints.select("*", F.posexplode(blocks(F.col("print"))).alias("block", "value"))
    index = (items.select("item_id", simhash(F.col("item"), longest).alias("item_print"))
             .select("item_id", "item_print", F.posexplode(blocks(F.col("item_print"))).alias("block", "value")))
    # a pair meets once per equal block; it goes on from the first of them only
    first = F.array_position(F.zip_with(blocks(F.col("print")), blocks(F.col("item_print")), lambda a, b: a == b), True) - 1
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (probe.join(sized(index), ["item_id", "block", "value"])
            .filter((distance <= RADIUS) & (F.col("block") == first))
            .select("doc_id", "item_id", "start", "window", distance.alias("distance")))
    both = near.join(sized(items), "item_id").withColumn("shared", _shared(F.col("window"), F.col("item")))
    union = F.size("window") + F.size("item") - F.col("shared")
    return (both.filter(100 * F.col("shared") >= SIMILARITY_PERCENT * union)
            .select("doc_id", "item_id", (F.col("shared") / union).alias("similarity"),
                    F.col("start").cast("long").alias("first_word"),
                    (F.size("window") + k - 1).cast("long").alias("n_words"), "distance"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, benchmark item) pair with a window of SIMILARITY_PERCENT or more, and its best window."""
    words = benchmark.select("item_id", word_array(F.col("text"), lower=True).alias("words"))
    words = words.filter(F.size("words") > 0).withColumn("k", F.least(F.size("words"), F.lit(WORDS)))
    sizes = (words.groupBy("k").agg(F.max(F.size("words")).alias("most"), F.sum(F.size("words")).alias("all"))
             .orderBy("k").collect())  # one row per shingle length, WORDS at most
    small = sum(r["all"] for r in sizes) <= BROADCAST_SHINGLES
    none = F.lit(None).cast("long")
    found = docs.limit(0).select("doc_id", none.alias("item_id"), none.cast("double").alias("similarity"),
                                 none.alias("first_word"), none.alias("n_words"), none.cast("int").alias("distance"))
    for r in sizes:
        items = words.filter(F.col("k") == r.k).select("item_id", shingles(F.col("words"), r.k).alias("item"))
        part = _of_length(docs, items, r.k, r.most - r.k + 1, small)
        found = part if r is sizes[0] else found.unionByName(part)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("f"), "n_words", (-F.col("distance")).alias("d")))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.similarity", (-F.col("b.f")).alias("first_word"), "b.n_words",
                    (-F.col("b.d")).alias("distance")))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with their columns as they were."""
    def key(prefix: str = "") -> Column:
        return F.to_json(F.struct(F.col(f"{prefix}doc_id").alias("i"), F.xxhash64(f"{prefix}text").alias("t")))

    leaked = leaks(docs.select(key().alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("leaked")).distinct()
    return unpacked(whole_rows(docs).join(leaked, key("whole.") == F.col("leaked"), "left_anti"), docs.columns)
