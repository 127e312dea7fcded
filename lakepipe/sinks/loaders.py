"""Load modes for catalog tables (K1–K3, Q6).

* ``DROP_INSERT``     – replace the table (definition and rows) by the frame;
* ``TRUNCATE_INSERT`` – the table must exist; keep its definition, replace its rows;
* ``INSERT``          – create when missing, else append; with a key, a batch that repeats a
  key or brings one that is already in the table is rejected first (Spark tables do
  not enforce keys): a grouped count of the batch's keys, and a left-semi join against the
  table's keys, both shuffled on the key. If the table is partitioned by columns of
  the key, only the partitions that the batch touches are read.

Tables are stored in the catalog's warehouse, or at an explicit ``path``.

Guarantees: writes go through Spark's commit protocol (a retried task never
leaves partial files). Replacing a parquet table is not atomic for readers, so
jobs run every check *before* the first file is written. The INSERT key check
and the append are two steps: they are not safe against a concurrent writer
appending the same keys (use a table format with MERGE for that).
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import CheckFailed, NotFound
from ..operators.quality import pk_violations, validate_table_name
from ..session import path_has_data


class LoadMode(Enum):
    DROP_INSERT = "drop_insert"
    TRUNCATE_INSERT = "truncate_insert"
    INSERT = "insert"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


#: Partition values of a batch that are put into the key check as a filter; a batch that
#: touches more partitions is checked against the whole table.
PRUNED_PARTITIONS = 1000


#: A batch with at most so many values of a key column is looked up by value: Parquet's Bloom filters of the column
#: then skip row groups (Spark pushes longer lists as a range only).
LISTED_KEYS = 10
#: Types whose least and largest value tell which row groups can hold a key.
_ORDERED = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType)


def _within_batch(df: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``target`` that can hold a key of ``df``, as filters that reach the scan."""
    names = [c for c in key if isinstance(target.schema[c].dataType, _ORDERED) and target.schema[c].dataType == df.schema[c].dataType]
    if not names:
        return target
    spans = df.agg(*[f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(names)
                     for k, f in (("lo", F.min), ("hi", F.max), ("n", F.approx_count_distinct))]).first()
    for i, c in enumerate(names):
        if spans[f"lo{i}"] is not None:
            target = target.where(F.col(f"`{c}`").between(F.lit(spans[f"lo{i}"]), F.lit(spans[f"hi{i}"])))
            if spans[f"n{i}"] <= LISTED_KEYS:
                values = [r[0] for r in df.select(f"`{c}`").where(F.col(f"`{c}`").isNotNull()).distinct().limit(LISTED_KEYS + 1).collect()]
                target = target.where(F.col(f"`{c}`").isin(values)) if len(values) <= LISTED_KEYS else target
    return target


def key_conflicts(df: DataFrame, target: DataFrame, key: list[str],
                  partitions: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key already exists in ``target`` (null keys never match).

    Of the target only row groups are read whose least and largest keys, and for a short batch whose Bloom filters, allow a
    key of the batch; what is read is joined exactly.

    ``partitions``: partition columns of ``target`` that are in the key.
    """
    kept = target
    for c in partitions or []:
        values = [r[0] for r in df.select(c).distinct().limit(PRUNED_PARTITIONS + 1).collect()]
        if len(values) <= PRUNED_PARTITIONS:
            kept = kept.where(F.col(c).isin(values))
    kept = _within_batch(df, kept, key)
    return df.select(*key).join(kept.select(*key).distinct(), key, "left_semi")


def check_batch_key(df: DataFrame, key: list[str]) -> None:
    """Reject a batch that repeats a key."""
    for row in pk_violations(df, key).limit(1).collect():
        raise CheckFailed("key", key, example=tuple(row)[:-1], rows=row["n"])


def load_table(df: DataFrame, name: str, mode: LoadMode, *, path: str | None = None,
               key: list[str] | None = None, partition_by: list[str] | None = None,
               bucket_by: tuple[int, list[str]] | None = None,
               file_format: str = "parquet", options: dict[str, str] | None = None) -> None:
    """Load ``df`` into catalog table ``name`` with the given mode.

    ``bucket_by=(n, columns)`` stores a newly created table in ``n`` buckets on
    ``columns``: joins and aggregations on those columns between tables bucketed
    the same way read co-located buckets instead of shuffling. ``options`` are stored with a new table.
    """
    spark = df.sparkSession
    validate_table_name(name)
    exists = table_exists(spark, name)
    if path and not exists and path_has_data(spark, path):
        # data written by an earlier session whose catalog is gone: attach it, so
        # INSERT checks keys against it and TRUNCATE_INSERT finds the table
        spark.catalog.createTable(name, path=path, source=file_format)
        exists = True
    if mode is LoadMode.INSERT and key:
        check_batch_key(df, key)
    if mode is LoadMode.TRUNCATE_INSERT:
        if not exists:
            raise NotFound("table", name)
        cols = spark.table(name).columns
        df.select(*cols).write.insertInto(name, overwrite=True)
        return
    if mode is LoadMode.INSERT and exists:
        if key:
            parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition and c.name in key]
            for hit in key_conflicts(df, spark.table(name), key, parts).limit(1).collect():
                raise CheckFailed("key", key, already_in=name, example=tuple(hit))
        cols = spark.table(name).columns
        df.select(*cols).write.insertInto(name, overwrite=False)
        return
    writer = df.write.format(file_format)
    for c in (key or []) if file_format == "parquet" else []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer = writer.options(**(options or {})).mode("overwrite" if mode is LoadMode.DROP_INSERT else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)

