"""Table mirroring (X6: S10, S12, K8, F6) with row-count reconciliation.

Each source table is copied with one parallel Spark job (partitioned read,
parallel write) — no OFFSET paging. The target is created from the source's
columns when missing, else its rows are replaced keeping its definition.
Columns that the target generates itself are left out. The source row count
is observed during the copy; the target count is read back after it.
``mirror_changes`` rewrites only what differs: key ranges are compared by digests.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import validate_table_name
from ..session import staged
from .loaders import LoadMode, load_table, table_exists

# Named groups of tables per source system.
TableGroups = Mapping[str, Mapping[str, list[str]]]


def select_tables(groups: TableGroups, system: str, group: str | None = None,
                  tables: list[str] | None = None) -> list[str]:
    """The tables to mirror: those named, else those of a system's group (default ``tables``)."""
    known = groups.get(system, {})
    name = group or "tables"
    if not tables and name not in known:
        raise KeyError(f"{system} has no table group {name}; it has {sorted(known)}")
    return list(tables or known[name])


def mirror_tables(spark: SparkSession, sources: Mapping[str, DataFrame], *,
                  target_prefix: str = "mirror_",
                  generated_columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Copy every source into ``<target_prefix><name>``; return the reconciliation
    ``(table_name, source_rows, target_rows)``."""
    generated_columns = generated_columns or {}
    recon = []
    for name, src in sources.items():
        validate_table_name(name)
        target = validate_table_name(target_prefix + name)
        skip = set(generated_columns.get(name, []))
        data = src.select(*[F.col(f"`{c}`") for c in src.columns if c not in skip])
        obs = Observation(f"mirror_{name}")
        data = data.observe(obs, F.count(F.lit(1)).alias("rows"))
        mode = LoadMode.TRUNCATE_INSERT if table_exists(spark, target) else LoadMode.DROP_INSERT
        load_table(data, target, mode)
        source_rows = int(obs.get["rows"])
        recon.append(spark.table(target).agg(F.count(F.lit(1)).alias("target_rows"))
                     .select(F.lit(name).alias("table_name"),
                             F.lit(source_rows).cast("long").alias("source_rows"),
                             "target_rows"))
    out = recon[0]
    for r in recon[1:]:
        out = out.unionByName(r)
    return out


#: Column of the mirror that holds a row's key range.
RANGE = "key_range"


def _range_of(key: list[str], ranges: int):
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(ranges)).cast("int")


def range_digests(df: DataFrame, key: list[str], ranges: int) -> DataFrame:
    """(key_range, rows, digest): one row per range of hashed keys, from one aggregation combined before its shuffle.

    The digest adds up two hashes of every row; nulls count, and so does how often a row occurs.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c != RANGE]
    parts = [*cols, *[c.isNull() for c in cols]]
    added = [F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    return df.groupBy(_range_of(key, ranges).alias(RANGE)).agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws("/", *added).alias("digest"))


def mirror_changes(spark: SparkSession, source: DataFrame, target: str, key: list[str], *, ranges: int = 256) -> DataFrame:
    """Bring the mirror ``target`` up to ``source``, rewriting only the key ranges that differ.

    The mirror is partitioned by range. Both sides are summed up to a digest per range (``ranges`` small rows); ranges with
    equal digests are left alone, the others are replaced from the source, and those without rows there are dropped. The
    first run writes all. Returns (key_range, source_rows, target_rows, changed), the state before the run.
    """
    validate_table_name(target)
    ours = range_digests(source, key, ranges).select(RANGE, F.col("rows").alias("source_rows"), F.col("digest").alias("a"))
    ranged = source.withColumn(RANGE, _range_of(key, ranges))
    if not table_exists(spark, target):
        # later overwrites replace the ranges they bring, not the table
        load_table(ranged.repartition(RANGE), target, LoadMode.DROP_INSERT, partition_by=[RANGE],
                   options={"partitionOverwriteMode": "dynamic"})
        return staged(ours.select(RANGE, "source_rows", F.lit(0).cast("long").alias("target_rows"), F.lit(True).alias("changed")), "mirror")
    theirs = range_digests(spark.table(target), key, ranges).select(RANGE, F.col("rows").alias("target_rows"), F.col("digest").alias("b"))
    compared = staged(ours.join(theirs, RANGE, "full").select(
        RANGE, F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
        (~F.col("a").eqNullSafe(F.col("b"))).alias("changed")), "mirror")
    changed = {r[RANGE]: r["source_rows"] for r in compared.where("changed").collect()}  # ``ranges`` rows at most
    written = [k for k, n in changed.items() if n]
    if written:
        columns = spark.table(target).columns
        (ranged.where(F.col(RANGE).isin(written)).repartition(RANGE).select(*[F.col(f"`{c}`") for c in columns])
         .write.insertInto(target, overwrite=True))
    for k in set(changed) - set(written):
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({RANGE} = {int(k)})")
    return compared


def mirror_jdbc_tables(spark: SparkSession, conn, tables: list[str], *,
                       partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
                       target_prefix: str = "mirror_",
                       generated_columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """X6 over JDBC: each table is read with parallel range queries when a
    ``(column, lower, upper, partitions)`` entry is given (S10), then mirrored."""
    from ..sources.jdbc import read_table
    partitioning = partitioning or {}
    sources = {}
    for t in tables:
        if t in partitioning:
            col, lo, hi, n = partitioning[t]
            sources[t] = read_table(spark, conn, t, partition_column=col, lower_bound=lo,
                                    upper_bound=hi, num_partitions=n)
        else:
            sources[t] = read_table(spark, conn, t)
    return mirror_tables(spark, sources, target_prefix=target_prefix,
                         generated_columns=generated_columns)
