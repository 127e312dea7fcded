"""Parquet table loading for the test tables (and any ``<dir>/<name>.parquet`` layout).

A scan has a task per file split and row-wise work follows in the same task; more tasks come from
more row groups and ``spark.sql.files.minPartitionNum``, never from a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names}
