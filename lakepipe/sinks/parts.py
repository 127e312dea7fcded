"""CSV exports cut into parts below a byte limit (K5, Q14).

A delivery with a size limit need not fail when it is too large: its rows are rendered once, and a prefix sum of
their bytes cuts them into parts in row order. The sum is taken in two steps: within the partitions in which the
rows were staged, and over the partitions' totals (one row each). A row belongs to the part in which it
begins; parts begin every ``limit`` less the header and the longest row, so that a row that reaches into the next
part still fits. Every part is one file with a header, written by one task that holds at most ``limit`` bytes of rows,
and has a manifest row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import CheckFailed
from ..session import move_path, remove_path, shared_dir, staged
from .export import csv_ready

_LOW_BITS = 33
#: How values are rendered: as ``export_csv`` renders them.
OPTIONS = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false",
           "ignoreTrailingWhiteSpace": "false", "dateFormat": "yyyy-MM-dd"}


def rendered(df: DataFrame, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> tuple[Column, str]:
    """The CSV line of a row of ``csv_ready(df)``, and the header line."""
    options = OPTIONS | {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    names = F.to_csv(F.struct(*[F.lit(c).alias(c) for c in df.columns]), OPTIONS)
    header = df.sparkSession.range(1).select(names.alias("h")).first()["h"]
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options), header


def numbered_parts(lines: DataFrame, size: int) -> DataFrame:
    """(part, at, line) of staged lines (at, line): parts of rows that begin within ``size`` bytes of each other."""
    rows = lines.select("at", "line", F.shiftright("at", _LOW_BITS).alias("_part"),
                        (F.octet_length("line") + 1).cast("long").alias("bytes"))
    totals = rows.groupBy("_part").agg(F.sum("bytes").alias("total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("_part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("offset") + F.coalesce(F.sum("bytes").over(within), F.lit(0))
    return rows.join(offsets, "_part").select(F.floor(begin / size).cast("long").alias("part"), "at", "line")


def export_csv_parts(df: DataFrame, path: str, limit: int, *, compression: str | None = None,
                     timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Write ``df`` as CSV files of at most ``limit`` bytes each (before compression), in the order of its rows.

    Returns (part, file_name, row_count, bytes), a row per file: its folder ``part=N`` under ``path`` holds that file
    alone. Part numbers ascend; one that no row begins in is left out. An empty frame gives one part with the header
    alone. A row that does not fit ``limit`` with the header fails the check ``size``, and nothing is published.
    """
    spark = df.sparkSession
    ready = csv_ready(df)
    line, header = rendered(ready, timestamp_format)
    lines = staged(ready.select(F.monotonically_increasing_id().alias("at"), line.alias("line")), "export-lines")
    head = len(header.encode()) + 1
    longest = lines.agg(F.coalesce(F.max(F.octet_length("line")) + 1, F.lit(0)).alias("n")).first()["n"]
    if head + longest > limit:
        raise CheckFailed("size", "export", bytes=head + longest, limit=limit)
    parts = numbered_parts(lines, limit - head - longest + 1)
    heads = parts.select("part").distinct() if longest else spark.range(1).select(F.col("id").alias("part"))
    first = heads.select("part", F.lit(-1).cast("long").alias("at"), F.lit(header).alias("line"))
    target = shared_dir(spark, "export-parts")
    out = parts.unionByName(first).repartition("part").sortWithinPartitions("part", "at").select("part", "line")
    out.write.partitionBy("part").option("compression", compression or "none").text(target)
    remove_path(spark, path)
    move_path(spark, target, path)
    number = F.regexp_extract("path", r"/part=(\d+)/", 1).cast("long")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path)
             .select(number.alias("part"), F.substring_index("path", "/", -1).alias("file_name"), F.col("length").alias("bytes")))
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("row_count"))
    return files.join(counts, "part", "left").select(
        "part", "file_name", F.coalesce("row_count", F.lit(0)).alias("row_count"), "bytes")
