"""Hot keys: one key holding a third of the rows must not change results, and the
shuffled (non-broadcast) plans must let AQE split the hot partition."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakepipe.plans.inventory_export import InventoryExport
from lakepipe.plans.inventory_snapshot import InventorySnapshot
from lakepipe.plans.job import RunContext
from lakepipe.registry import _X2_DIMS
from lakepipe.sources.fixtures import adapters

from .conftest import SF_ORACLE

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # keep map-side partitions apart at this tiny size: a hot partition can only
    # be split along the map outputs it is made of
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_inventory_export_hot_product_shuffled_join(spark):
    srcs = dict(adapters(spark, SF_ORACLE, _X2_DIMS))
    fact = srcs["fact_inventory_current"]
    # a third of the stock rows point at one product
    srcs["fact_inventory_current"] = fact.withColumn(
        "product_id", F.when(F.col("stock_id") % 3 == 0, F.lit(7)).otherwise(F.col("product_id")))
    ctx = RunContext(as_of=datetime(2024, 1, 31))
    expected = _rows(InventoryExport(srcs).build(spark, ctx=ctx))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = InventoryExport(srcs).build(spark, ctx=ctx)
        got = _rows(df)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
    assert "SortMergeJoin" in plan
    assert "skew=true" in plan


def test_inventory_snapshot_hot_product_is_combined_map_side(spark):
    srcs = dict(adapters(spark, SF_ORACLE, ["stock_quantities", "products", "product_prices"]))
    stock = srcs["stock_quantities"]
    srcs["stock_quantities"] = stock.withColumn(
        "product_id", F.when(F.col("total_qty") % 3 == 0, F.lit(11)).otherwise(F.col("product_id")))
    ctx = RunContext(as_of=datetime(2024, 1, 31))
    a = _rows(InventorySnapshot(srcs).build(spark, ctx=ctx))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = InventorySnapshot(srcs).build(spark, ctx=ctx)
    got = _rows(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == a
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan            # stock rows are combined before their shuffle
