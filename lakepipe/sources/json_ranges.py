"""One large JSON array read by several tasks.

A file that holds one array has no line ends to split at, so a task that starts in its middle knows neither whether it is inside
a string nor how deep it is. Both follow from what comes before, and what a range of bytes does to them can be
told without knowing: quotes flip the string state, and brackets count for one of the two states the range may begin in. So

1. each range (a split of the file, cut at a closing brace) is summed up for both states: quotes, depth gained, and commas by
   depth (one small row per range);
2. a prefix sum over a file's ranges gives the state, the depth and the number of finished elements each begins with;
3. each range then cuts its elements out: those that begin and end in it are documents, the pieces at its ends are joined
   with those of the neighbouring ranges by file and element number.

Ranges are those of Spark's text source (``lineSep="}"``), so their size follows ``spark.sql.files.maxPartitionBytes``.
Every element becomes a document of its own: a one-member list, which gives the rows the whole array would give.
An empty array gives none. What is no single array (text after its end, an element missing, brackets or quotes
left open) is an error.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..errors import CheckFailed
from ..session import staged

#: Summaries of at most so many ranges are broadcast to the second pass (about 100 bytes each).
BROADCAST_RANGES = 100_000

_TOKEN = re.compile(r'\\.|["\[\]{},]', re.DOTALL)
_BLANK = " \t\n\r"
_COMMAS = "array<struct<depth: int, n: long>>"
SUMMARY = f"file string, start long, first string, flips long, gain_out int, gain_in int, commas_out {_COMMAS}, commas_in {_COMMAS}"
PARTS = "file string, element long, start long, part string, whole boolean, only boolean"


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a DDL string; on the driver only."""
    return to_arrow_schema(_parse_datatype_string(ddl))


def ranges(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, value): the text between closing braces, in the order of the file within each range."""
    raw = spark.read.format("text").option("lineSep", "}").load(paths)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, str]]:
    """(other columns, whether a range begins here, text with the brace before it) of each row."""
    last = None
    for b in batches:
        names = [n for n in b.schema.names if n != "value"]
        for value, *rest in zip(b.column("value").to_pylist(), *(b.column(n).to_pylist() for n in names), strict=True):
            begins = tuple(rest[:2]) != last
            last = tuple(rest[:2])
            # every text but the first of the file follows a closing brace
            yield tuple(rest), begins, value if begins and rest[1] == 0 else "}" + value


class Summary:
    """What a range does to the string state and the depth, for both states it may begin in."""

    def __init__(self):
        self.flips, self.first = 0, None
        self.gain = [0, 0]  # by state at the beginning: outside a string, inside one
        self.commas = [Counter(), Counter()]

    def add(self, text: str) -> None:
        if self.first is None and (rest := text.lstrip(_BLANK)):
            self.first = rest[0]
        for m in _TOKEN.finditer(text):
            c = m[0]
            k = self.flips & 1  # a bracket is outside strings for the one state or for the other
            if c == '"':
                self.flips += 1
            elif c in "[{":
                self.gain[k] += 1
            elif c in "]}":
                self.gain[k] -= 1
            elif c == ",":
                self.commas[k][self.gain[k]] += 1

    def row(self, file: str, start: int) -> dict:
        commas = [[{"depth": d, "n": n} for d, n in c.items()] for c in self.commas]
        return {"file": file, "start": start, "first": self.first, "flips": self.flips, "gain_out": self.gain[0],
                "gain_in": self.gain[1], "commas_out": commas[0], "commas_in": commas[1]}


def _summaries(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, summary, rows = None, Summary(), []
    for where, begins, text in _texts(batches):
        if begins and key is not None:
            rows.append(summary.row(*key))
        if begins:
            key, summary = where, Summary()
        summary.add(text)
    if key is not None:
        rows.append(summary.row(*key))
    yield pa.RecordBatch.from_pylist(rows, schema)


def states(summaries: DataFrame) -> DataFrame:
    """(file, start, inside, depth, element, elements, ok): what each range begins with, and the file's whole count."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    s = summaries.withColumn("inside", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2 == 1)
    s = s.withColumn("gain", F.when(F.col("inside"), F.col("gain_in")).otherwise(F.col("gain_out")))
    s = s.withColumn("depth", F.coalesce(F.sum("gain").over(before), F.lit(0)).cast("int"))
    commas = F.when(F.col("inside"), F.col("commas_in")).otherwise(F.col("commas_out"))
    # commas of the array itself: those at depth 1
    mine = F.filter(commas, lambda c: c["depth"] + F.col("depth") == 1)
    s = s.withColumn("n", F.coalesce(F.get(mine, 0)["n"], F.lit(0)))
    ok = (F.sum("gain").over(whole) == 0) & (F.sum("flips").over(whole) % 2 == 0)
    return s.select("file", "start", "inside", "depth", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("element"),
                    F.sum("n").over(whole).alias("elements"), ok.alias("ok"))


class Cutter:
    """The elements of a range, from the state it begins with."""

    def __init__(self, start: int, inside: bool, depth: int, element: int):
        self.inside, self.depth, self.element = inside, depth, element
        self.opened = start > 0  # a file's first range holds the opening bracket
        self.begun = not self.opened  # whether the current element begins in this range
        self.held: list[str] = []
        self.done: list[tuple[int, str, bool]] = []

    def _end(self) -> None:
        self.done.append((self.element, "".join(self.held), self.begun))
        self.held, self.begun = [], True

    def add(self, text: str) -> None:
        at = 0  # text before it is dealt with
        for m in _TOKEN.finditer(text):
            c = m[0]
            if c == '"':
                self.inside = not self.inside
            elif self.inside or c[0] == "\\":
                continue
            elif c in "[{":
                if self.depth == 0:
                    if self.opened or c == "{" or text[at:m.start()].strip(_BLANK):
                        raise ValueError("text outside the array of a JSON file")
                    self.opened, at = True, m.end()
                self.depth += 1
            elif c in "]}":
                self.depth -= 1
                if self.depth == 0:
                    self.held.append(text[at:m.start()])
                    self._end()
                    at = m.end()
            elif self.depth == 1:
                self.held.append(text[at:m.start()])
                self._end()
                self.element += 1
                at = m.end()
        if self.depth > 0:
            self.held.append(text[at:])
        elif text[at:].strip(_BLANK):
            raise ValueError("text outside the array of a JSON file")

    def finish(self) -> list[tuple[int, str, bool]]:
        if self.held:
            self.done.append((self.element, "".join(self.held), False))
        out, self.done = self.done, []
        return out


def _cut(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, cutter, where, rows, size = schema.names, None, None, [], 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    def of(where: tuple, found: list[tuple[int, str, bool]]) -> list[tuple]:
        return [(where[0], e, where[1], part, whole, where[5] == 0) for e, part, whole in found]

    for rest, begins, text in _texts(batches):
        if begins:
            if cutter is not None:
                rows += of(where, cutter.finish())
            where, cutter = rest, Cutter(*rest[1:5])
        cutter.add(text)
        found, cutter.done = cutter.done, []
        rows += of(where, found)
        size += len(text)
        if size > 4 << 20:
            yield batch(rows)
            rows, size = [], 0
    if cutter is not None:
        rows += of(where, cutter.finish())
    yield batch(rows)


def array_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, doc): a one-member list for each element of the array that each file holds."""
    texts = ranges(spark, paths)
    found = states(texts.mapInArrow(partial(_summaries, _arrow(SUMMARY)), SUMMARY))
    found = staged(found, "json-ranges")
    if not (first := found.filter("NOT ok").limit(1)).isEmpty():
        raise CheckFailed("document", first.first()["file"])
    few = found.count() <= BROADCAST_RANGES
    met = texts.withColumn("at", F.monotonically_increasing_id()).join(
        F.broadcast(found) if few else found, ["file", "start"])
    if not few:  # a shuffled join loses the order within a range
        met = met.repartition("file", "start").sortWithinPartitions("file", "start", "at")
    met = met.select("file", "start", "inside", "depth", "element", "elements", "value")
    parts = staged(met.mapInArrow(partial(_cut, _arrow(PARTS)), PARTS), "json-elements")
    inner = parts.filter("whole").select("file", "part", "only")
    ends = (parts.filter("NOT whole").groupBy("file", "element")
            .agg(F.array_sort(F.collect_list(F.struct("start", "part"))).alias("ps"), F.first("only").alias("only"))
            .select("file", F.array_join("ps.part", "").alias("part"), "only"))
    blank = F.btrim("part", F.lit(_BLANK)) == ""
    missing = F.raise_error(F.concat(F.lit("a member is missing in the array of "), F.col("file"))).cast("boolean")
    return (inner.unionByName(ends).where(F.when(blank & ~F.col("only"), missing).otherwise(~blank))
            .select(F.col("file").alias("source_file"), F.concat(F.lit("["), F.col("part"), F.lit("]")).alias("doc")))
