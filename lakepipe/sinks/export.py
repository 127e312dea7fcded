"""CSV exports with a manifest.

The export is written by the executors in parallel (one part file per task)
unless ``single_file`` is asked for, which writes from one task and renames
the part file to the exact key. The row count is observed during the write
(no extra pass); the byte size is read from the file listing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_literal
from ..operators.quality import enforce_size
from ..session import move_path, remove_path

DEFAULT_SIZE_LIMIT = 10 * 1024 * 1024


@dataclass
class ExportResult:
    path: str
    row_count: int
    bytes: int
    files: int


def csv_ready(df: DataFrame) -> DataFrame:
    """Render booleans as ``True``/``False`` like the data-frame CSV writer."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c, F.lit("True")).when(~c, F.lit("False")).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def dated_key(prefix: str, name: str, as_of: date | datetime, ext: str = "csv") -> str:
    """``<prefix>/year=YYYY/month=MM/<name>_YYYY-MM-DD.<ext>``."""
    d = as_of.date() if isinstance(as_of, datetime) else as_of
    return f"{prefix.rstrip('/')}/year={d:%Y}/month={d:%m}/{name}_{d:%Y-%m-%d}.{ext}"


def written_bytes(spark: SparkSession, path: str, glob: str = "part-*") -> tuple[int, int]:
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", True).load(path))
    row = listing.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b"),
                      F.count(F.lit(1)).alias("n")).first()
    return int(row["b"]), int(row["n"])


def _rename_single_part(spark: SparkSession, directory: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(directory)
    fs = src_dir.getFileSystem(conf)
    parts = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")]
    dst = jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(dst):
        fs.delete(dst, False)
    fs.mkdirs(dst.getParent())
    if len(parts) != 1 or not fs.rename(parts[0], dst):
        raise OSError(f"{directory}: {len(parts)} part files, not moved to {target}")
    fs.delete(src_dir, True)


def export_csv(df: DataFrame, path: str, *, single_file: bool = False,
               compression: str | None = None,
               timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
               size_limit: int | None = None,
               partition_by: list[str] | None = None) -> ExportResult:
    """K4: header, null → empty field, quotes doubled, values not trimmed.

    ``single_file=True`` writes one file at exactly ``path`` through a single
    writing task; use it only for deliverables known to be small. With ``size_limit`` nothing is
    published at ``path`` if the file is larger.
    The default writes part files in parallel under ``path``. ``partition_by``
    (K10) writes Hive-style ``col=value`` folders, e.g. ``year=2024/month=01``.
    """
    if single_file and partition_by:
        raise ValueError("single_file and partition_by exclude each other")
    spark = df.sparkSession
    obs = Observation("export")
    out = csv_ready(df).observe(obs, F.count(F.lit(1)).alias("rows"))
    # a checked or single file is written aside and moved once it is known to be fine
    out_dir = path + ".parts" if single_file or size_limit is not None else path
    if single_file:
        out = out.repartition(1)  # only the write runs in one task, not what comes before it
    w = (out.write.mode("overwrite").option("header", True).option("quote", '"')
         .option("escape", '"').option("emptyValue", "").option("nullValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
         .option("dateFormat", "yyyy-MM-dd"))
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(out_dir)
    rows = int(obs.get["rows"])
    size, files = written_bytes(spark, out_dir)
    if size_limit is not None and size > size_limit:
        remove_path(spark, out_dir)
        enforce_size(size, size_limit)  # Q14: the file delivered before stays
    if single_file:
        _rename_single_part(spark, out_dir, path)
    elif out_dir != path:
        remove_path(spark, path)
        move_path(spark, out_dir, path)
    return ExportResult(path, rows, size, files)


def period_label(min_date: Column, max_date: Column, as_of: Column) -> Column:
    """K6: ``min to max`` when both are set, ``max`` when only max, else the as-of day."""
    lo = F.nullif(F.trim(min_date.cast("string")), F.lit(""))
    hi = F.nullif(F.trim(max_date.cast("string")), F.lit(""))
    return (F.when(lo.isNotNull() & hi.isNotNull(), F.concat_ws(" to ", lo, hi))
            .when(hi.isNotNull(), hi)
            .otherwise(F.to_date(as_of).cast("string")))


def export_manifest(spark: SparkSession, result: ExportResult, *, export_name: str,
                    category: str | None, min_date: str | None, max_date: str | None,
                    as_of: date | datetime) -> DataFrame:
    """K5: one manifest row describing a delivered export."""
    file_name = result.path.rstrip("/").rsplit("/", 1)[-1]
    base = spark.range(1).select(
        F.lit(export_name).alias("export_name"),
        F.lit(file_name).alias("file_name"),
        F.lit(category or "Uncategorized").alias("category"),
        period_label(F.lit(min_date).cast("string"), F.lit(max_date).cast("string"),
                     date_literal(as_of)).alias("period"),
        F.lit(result.row_count).cast("long").alias("row_count"),
        F.lit(result.bytes).cast("long").alias("bytes"),
        F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz").alias("written_at"))
    return base


def debug_path(base_dir: str, job_name: str) -> str:
    """K9: where a debug run writes its CSV instead of the real destination."""
    return f"{base_dir.rstrip('/')}/.output/{job_name}.csv"


__all__ = ["DEFAULT_SIZE_LIMIT", "ExportResult", "csv_ready", "dated_key", "debug_path",
           "export_csv", "export_manifest", "period_label", "written_bytes"]
