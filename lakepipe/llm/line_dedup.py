"""Line dedup (operator 4): content-defined chunks of lines that repeat anywhere in the corpus.

A text is cut at ``\\n``; lines without a word are no lines here. Every line is hashed, and a rolling hash runs over the hashes of
two lines in succession. A line of ``LONG_LINE`` words or more is looked up alone, by its own hash. A chunk begins where the rolling hash starts to be one that occurred before in the corpus and ends
where it stops: its boundaries depend on the lines alone, so an inserted line shifts none of them elsewhere, and
every run of two or more lines that repeats is found whole, wherever its lines occur besides. (Boundaries chosen inside a text, by the least rolling hash of every few lines, miss most passages
of two to eight lines: a chunk must lie inside the passage whole.)

Of the places of one hash the first by document id and position stays; each other is compared with it byte by
byte, and is removed if they are equal, two lines with the lines without a word between them. A long line beside a short one
goes by its own comparison, as it occurs before wherever the two do; its bytes are shuffled once. A single
short line that many documents share stays, but for its repeated runs. The text of each line stays at one place at least: a line is
removed only where it is part of a run that occurred before.

Hashes are counted first; bitmaps of the repeated ones and of their first places (of bounded size) are
broadcast, so that only lines that may repeat are shuffled: once to be compared, and those that may come first once more. A run that a
third of all documents share is one key of a sort-merge join whose partition Spark can split. Of two different runs with one hash
the later is never removed.

Null text stays null and text without a repeated run stays as it is. Equal rows (id and text) count as
one document and have the same result. Ids may be null (they come first). Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._base import arrow_schema, batch_of, bitmap_of, in_bitmap, let, unpacked, whole_rows, written

LONG_LINE = 20

LIGHT = "doc_id long, row_key long, number int, hash long"
FULL = "doc_id long, row_key long, number int, hash long, at int, lines int, body string, maybe_first boolean"
BLANK = " \t\n\x0b\x0c\r"
#: Multiplier of the rolling hash.
ROLL = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def _long(line: str) -> bool:
    return len(line) >= 2 * LONG_LINE - 1 and len(line.split()) >= LONG_LINE


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def rolled(text: str | None) -> tuple[list[tuple[int, int, int, int, str]], list[str]]:
    """(number, hash, first line, end, bytes to compare) of every two lines in succession and of every long line; all lines.

    The range and the bytes of two lines are those of the short ones; two long lines are not looked up together.
    """
    lines = (text or "").split("\n")
    found, last, n = [], None, 0
    for i, line in enumerate(lines):
        if not line.strip(BLANK):
            continue
        h, long = xxhash.xxh3_64_intdigest(line), _long(line)
        if last is not None and not (last[2] and long):
            both = _signed((last[1] * ROLL + h) & MASK)
            body = lines[last[0]] if long else line if last[2] else f"{lines[last[0]]}\n{line}"
            found.append((2 * n, both, last[0] + last[2], i + (not long), body))
        if long:
            found.append((2 * n + 1, _signed(h), i, i + 1, line))
        last, n = (i, h, long), n + 1
    return found, lines


def _light(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(i, key, k, h) for i, text, key in zip(*(c.to_pylist() for c in b.columns), strict=True)
                for k, h, *_ in rolled(text)[0]]
        yield batch_of(rows, schema)


def _full(bitmaps, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose hash is in the first bitmap, with the bytes of their lines."""
    known, first = bitmaps.value
    for b in batches:
        rows, held = [], 0
        for i, text, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
            for k, h, a, e, body in rolled(text)[0]:
                if in_bitmap(known, h):
                    rows.append((i, key, k, h, a, e - a, body, in_bitmap(first, key ^ k ^ ((i or 0) << 8))))
                    held += len(body)
            if held > 8 << 20:
                yield batch_of(rows, schema)
                rows, held = [], 0
        yield batch_of(rows, schema)


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, removed): the line numbers to remove from each document that has any."""
    keyed = docs.select("doc_id", "text", row_key().alias("row_key"))
    occurrence = F.struct("doc_id", "row_key", "number")
    repeated = (keyed.mapInArrow(partial(_light, arrow_schema(LIGHT)), LIGHT).groupBy("hash")
                .agg(F.min(occurrence).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                .select(F.col("hash").alias("r_hash"), F.col("first.doc_id").alias("r_id"), F.col("first.row_key").alias("r_key"),
                        F.col("first.number").alias("r_number")))
    # a place in a bitmap, as in _full: the text's hash with number and id in its low digits
    of_id = F.call_function("shiftleft", F.coalesce("r_id", F.lit(0)), F.lit(8))
    place = F.col("r_key").bitwiseXOR(F.col("r_number").cast("long")).bitwiseXOR(of_id)
    repeated = written(repeated.withColumn("r_place", place), "repeated-lines")
    bitmaps = docs.sparkSession.sparkContext.broadcast(
        (bitmap_of(repeated, "r_hash"), bitmap_of(repeated, "r_place")))
    found = written(keyed.mapInArrow(partial(_full, bitmaps, arrow_schema(FULL)), FULL), "lines")
    # first occurrences are joined by their whole position, so a chunk that is everywhere is no hot key here
    at_first = ((F.col("hash") == F.col("r_hash")) & F.col("doc_id").eqNullSafe(F.col("r_id"))
                & (F.col("row_key") == F.col("r_key")) & (F.col("number") == F.col("r_number")))
    maybe = found.filter("maybe_first").join(repeated.drop("r_place"), at_first, "left")
    keepers = (maybe.filter("r_hash IS NOT NULL").select("r_hash", F.col("body").alias("k_body"))
               .dropDuplicates(["r_hash"]))  # equal rows bring the same first occurrence more than once
    later = found.filter("NOT maybe_first").unionByName(maybe.filter("r_hash IS NULL").select(*found.columns))
    same = later.join(keepers, F.col("hash") == F.col("r_hash")).filter(F.col("body") == F.col("k_body"))
    return (same.select("doc_id", "row_key", F.sequence(F.col("at"), F.col("at") + F.col("lines") - 1).alias("removed"))
            .groupBy("doc_id", "row_key").agg(F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed")))


def row_key(text: str = "text") -> Column:
    return F.xxhash64(text)


def rewrite(text: Column, removed: Column) -> Column:
    """The text without the lines of the given numbers."""
    return F.when(removed.isNull(), text).otherwise(let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed), lambda i: F.get(lines, i)), "\n")))


def _joined(docs: DataFrame) -> DataFrame:
    """(whole, removed): the rows of ``docs`` with the lines to remove, null if none."""
    r = removals(docs).select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"), "removed")
    return whole_rows(docs).join(r, F.col("whole.doc_id").eqNullSafe(F.col("id")) & (row_key("whole.text") == F.col("key")), "left")


def line_dedup(docs: DataFrame) -> DataFrame:
    """Text, lines and removed lines of every document."""
    out = _joined(docs.select("doc_id", "text")).select("whole.doc_id", "whole.text", "removed")
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    return out.select("doc_id", F.when(F.col("text").isNull(), F.lit(0)).otherwise(lines).alias("n_lines"),
                      F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                      rewrite(F.col("text"), F.col("removed")).alias("text"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their text rewritten; a document of which no word is left goes."""
    out = _joined(docs).withColumn("left", rewrite(F.col("whole.text"), F.col("removed")))
    kept = out.filter(F.col("removed").isNull() | F.col("left").rlike("[^\\x20\\x09-\\x0D]"))
    return unpacked(kept, docs.columns, text=F.col("left"))
