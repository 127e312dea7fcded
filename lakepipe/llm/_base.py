"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from ..session import remove_path, shared_dir

#: Separators of words: ASCII space and the five ASCII control blanks.
BLANKS = "[\\x20\\x09-\\x0D]+"


class Cache(dict):
    """A dict that computes missing values and empties itself when it holds ``limit`` keys.

    Values of keys longer than ``longest`` are computed each time, so its memory is bounded.
    """

    def __init__(self, compute: Callable, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_batches(df: DataFrame, columns: list[str], schema: str,
                fn: Callable[..., dict[str, list]]) -> DataFrame:
    """Apply ``fn`` to Arrow batches of ``columns``; only these columns reach Python.

    ``fn`` gets one list per column and returns a dict of equally long lists.
    """
    out_type = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                out = fn(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in out_type], schema=out_type)

    return df.select(*[F.col(c) for c in columns]).mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string; on the driver only."""
    return to_arrow_schema(_parse_datatype_string(schema))


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """An Arrow batch of row tuples."""
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Bits of a bitmap: at least eight per value while that is below the upper bound (4 MB).
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 25


def bitmap_of(df: DataFrame, column: str) -> bytes:
    """A bitmap of the low digits of a long column, of bounded size, to be broadcast.

    Values not in the column may be found in it, none of the column is missing: it only saves work.
    """
    n, bits = df.count(), LEAST_BITS
    while bits < min(8 * n, MOST_BITS):
        bits *= 2
    at = F.pmod(F.col(column), F.lit(bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(31)).cast("int"))
    words = df.groupBy(F.shiftright(at, 5).alias("w")).agg(F.bit_or(one).alias("v"))
    out = np.zeros(bits // 32, "<u4")
    for b in words.toLocalIterator():  # bits / 32 rows at most
        if b.w is not None:
            out[b.w] = b.v
    return out.tobytes()


def in_bitmap(bitmap: bytes, value: int) -> bool:
    at = value % (len(bitmap) * 8)
    return bitmap[at >> 3] >> (at & 7) & 1 == 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


QUANTILE_STEP, QUANTILE_LAST = 0.01, 5000


def histogram_quantile(values: DataFrame, by: list[str], value: str, q: float, name: str) -> DataFrame:
    """The q-quantile of ``value`` per key, from a histogram of fixed steps: exact to a step.

    Rows are counted per step before the shuffle; a key has at most ``2 * QUANTILE_LAST`` steps.
    """
    step = F.least(F.greatest(F.floor(F.col(value) / QUANTILE_STEP), F.lit(-QUANTILE_LAST)), F.lit(QUANTILE_LAST)).alias("_step")
    counts = values.groupBy(*by, step).agg(F.count(F.lit(1)).alias("_n"))
    upto, every = Window.partitionBy(*by).orderBy("_step"), Window.partitionBy(*by)
    return (counts.select(*by, "_step", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(every).alias("_all"))
            .filter(F.col("_upto") >= q * F.col("_all")).groupBy(*by)
            .agg(((F.min("_step") + 1) * QUANTILE_STEP).alias(name)))


def whole_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``whole``: no other column can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``whole`` as they were, but for those in ``changed``."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col("whole").getField(c).alias(c) for c in columns])


def word_array(text: Column, lower: bool = False) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    t = F.coalesce(text, F.lit(""))
    if lower:
        t = F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(t, BLANKS), lambda w: w != "")


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.mode("error").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._lakepipe_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete the folder behind a frame made by ``written``."""
    remove_path(df.sparkSession, df._lakepipe_path)
