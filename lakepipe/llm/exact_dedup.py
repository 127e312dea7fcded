"""Exact dedup (operator 13): deterministic block naming.

The UTF-8 bytes of each whole text are cut into blocks of ``BLOCK`` bytes (the last may be shorter; an empty text is one
empty block). All distinct blocks are sorted and numbered: a block's number is its name, equal for equal blocks and no
others. Then the names of adjacent blocks are paired, the distinct pairs are sorted and named in the same way, and so on
until each document has one name. Two documents have the same name after the same number of rounds if and only if their
texts are equal: a name stands for one sequence of bytes, so no two texts ever share one.

Bytes are shuffled once, to find the distinct blocks; copies are combined before. Afterwards a block is looked up by a
pair of 64-bit hashes. That these tell all distinct blocks apart is checked on the whole table of names; if two blocks
shared a pair, names would be made again with other seeds. So the result rests on compared bytes, not on hashes. Each
further round shuffles three numbers per pair, of the documents only that still have two names or more; there are log2 of
the blocks of the longest text. Groups are counted before they are shuffled, and a block or pair that a third of all
documents share is one key of a sort-merge join whose partition Spark can split.

Null text counts as empty. Repeated rows are rows of their own: each counts in ``group_size``, and if they hold the
largest id of their group all of them stay. Of equal texts with and without an id one with an id stays; if none has one,
all of them stay and ``keep_id`` is null. An empty table gives an empty result. Other columns are ignored, whatever
their names; ``without_copies`` returns them as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import let, unpacked, whole_rows, written

BLOCK = 32768


def blocks(text: Column, size: int = BLOCK) -> Column:
    """The bytes of a text in blocks of ``size`` bytes; one empty block for null and empty text."""
    def cut(data: Column) -> Column:
        last = F.floor(F.greatest(F.octet_length(data) - 1, F.lit(0)) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))

    return let(F.coalesce(text, F.lit("")).cast("binary"), cut)


def hashes(block: Column, seed: int) -> Column:
    """Two 64-bit hashes of a block."""
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def _named(keys: DataFrame, order: list[str], *kept: Column) -> DataFrame:
    """Distinct keys in sorted order with a number each; a partition that is made again has the same order and numbers."""
    return keys.distinct().sortWithinPartitions(*order).select(*kept, F.monotonically_increasing_id().alias("name"))


def block_names(docs: DataFrame, size: int = BLOCK, hashed=hashes) -> tuple[DataFrame, int]:
    """(a, b, name) of every distinct block, and the seed whose hashes tell them all apart."""
    every = docs.select(F.explode(blocks(F.col("text"), size)).alias("block"))
    seed = 0
    while True:
        names = written(_named(every, ["block"], hashed(F.col("block"), seed).alias("h")).select("h.a", "h.b", "name"), "block-names")
        if names.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return names, seed
        seed += 1


def identities(docs: DataFrame, size: int = BLOCK, hashed=hashes) -> DataFrame:
    """(row, doc_id, text_sha256, round, name): equal (round, name) if and only if equal texts."""
    names, seed = block_names(docs, size, hashed)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2(text, 256).alias("text_sha256"),
        F.transform(blocks(text, size), lambda b: hashed(b, seed)).alias("hashes")), "block-hashes")
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 0
    units = (rows.select("row", F.size("hashes").alias("left"), F.posexplode("hashes").alias("at", "h"))
             .select("row", "left", "at", "h.a", "h.b").join(names, ["a", "b"]).select("row", "left", "at", "name"))
    units = written(units, "block-units")
    done, k = [units.filter("left = 1").select("row", F.lit(0).alias("round"), "name")], 0
    while longest > 1:
        k, longest = k + 1, (longest + 1) // 2
        odd = F.col("at") % 2
        pairs = (units.filter("left > 1").groupBy("row", F.floor(F.col("at") / 2).cast("int").alias("at"))
                 .agg(F.max("left").alias("left"), F.max(F.when(odd == 0, F.col("name"))).alias("l"),
                      F.max(F.when(odd == 1, F.col("name"))).alias("r")))
        # a last block without a partner is paired with a number that names nothing
        pairs = pairs.select("row", "at", F.floor((F.col("left") + 1) / 2).cast("int").alias("left"), "l",
                             F.coalesce("r", F.lit(-1).cast("long")).alias("r"))
        named = _named(pairs.select("l", "r"), ["l", "r"], F.col("l"), F.col("r"))
        units = written(pairs.join(named, ["l", "r"]).select("row", "left", "at", "name"), "block-units")
        done.append(units.filter("left = 1").select("row", F.lit(k).alias("round"), "name"))
    every = done[0]
    for d in done[1:]:
        every = every.union(d)
    return rows.select("row", "doc_id", "text_sha256").join(every, "row")


def exact_dedup(docs: DataFrame, size: int = BLOCK, hashed=hashes) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per document."""
    named = identities(docs.select("doc_id", "text"), size, hashed)
    groups = named.groupBy("round", "name").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return named.join(groups, ["round", "name"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    stay = (exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest"))
            .distinct())
    digest = F.sha2(F.coalesce(F.col("whole.text"), F.lit("")), 256)
    kept = whole_rows(docs).join(stay, F.col("whole.doc_id").eqNullSafe(F.col("id")) & (digest == F.col("digest")), "left_semi")
    return unpacked(kept, docs.columns)
