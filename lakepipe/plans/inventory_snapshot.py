"""Inventory snapshot fact.

Per product and warehouse: quantities, average unit cost and values, priced
from the entity's product price, stamped with the as-of date.

Plan: stock rows are filtered (F1) and aggregated per product *before* the
product join — products are unique on ``id``, so grouping by product id
equals grouping by (id, warehouse, entity, status) after the join (A1–A3).
Partial aggregation therefore runs map-side on the raw stock rows and a hot
product collapses to one row per task. The join inputs are then one row per
product (J1, inner; J2, left on entity + product), broadcast only after a
checked row bound, else sort-merge on the product key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, date_literal
from ..functions.numeric import safe_ratio
from ..schema import (ColumnSpec, OutputSchema, unsigned_decimal, unsigned_int,
                      unsigned_smallint, unsigned_tinyint)
from ..sinks.loaders import LoadMode
from .job import BatchJob, Destination, RunContext

OUT_OF_STOCK_STATUS = 6

SCHEMA = OutputSchema(
    "fact_inventory",
    unsigned_int("date_id", primary_key=True),
    unsigned_int("product_id", primary_key=True),
    unsigned_tinyint("warehouse_id", primary_key=True),
    unsigned_tinyint("entity_id", nullable=False),
    unsigned_tinyint("status_id", nullable=False, default=0),
    unsigned_smallint("quantity", nullable=False),
    unsigned_decimal("avg_unit_cost", 7, 2, nullable=False, default=0),
    unsigned_decimal("total_cost", 10, 2, nullable=False, default=0),
    unsigned_decimal("unit_price", 7, 2, nullable=False, default=0),
    unsigned_decimal("total_value", 10, 2, nullable=False, default=0),
    ColumnSpec("stock_creation_date", T.TimestampNTZType()),
)


@dataclass
class InventorySnapshotParameters:
    pass


class InventorySnapshot(BatchJob):
    """Inputs: ``stock_quantities``, ``products``, ``product_prices``."""

    parameter_class = InventorySnapshotParameters
    schema = SCHEMA
    destination = Destination(table="fact_inventory", load_mode=LoadMode.INSERT)

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = sources

    def extract(self, spark: SparkSession, params, ctx: RunContext) -> dict[str, DataFrame]:
        s = self.sources["stock_quantities"]
        stock = (s.where((F.col("total_qty") > 0) & F.col("deleted_at").isNull())
                 .groupBy("product_id")
                 .agg(F.min("created_at").alias("stock_creation_date"),
                      F.sum(F.col("total_qty") * F.col("cost")).alias("total_cost"),
                      F.sum("total_qty").alias("total_qty"),
                      F.sum("available_qty").alias("available_qty")))
        products = (self.sources["products"]
                    .where(F.col("status_id") != OUT_OF_STOCK_STATUS)
                    .select(F.col("id"), F.col("system_id").alias("entity_id"),
                            "warehouse_id", "status_id"))
        prices = self.sources["product_prices"].select(
            "product_id", "entity_id", F.col("regular_price").alias("unit_price"))
        # Spark picks the joins from sizes in bytes; nothing is counted or broadcast ahead
        stock = (stock.join(products, stock.product_id == products.id, "inner")
                 .where(F.col("available_qty") > 0)
                 .select("entity_id", "warehouse_id", "product_id", "status_id",
                         "stock_creation_date", "total_cost", "total_qty", "available_qty"))
        return {"stock": stock, "product_prices": prices}

    def transform(self, inputs, params, ctx: RunContext) -> DataFrame:
        df = inputs["stock"].join(inputs["product_prices"], ["entity_id", "product_id"], "left")
        # Each column sees the ones before it (total_cost uses the rounded average).
        return (df.withColumn("date_id", date_key(date_literal(ctx.as_of)))
                # Spark keeps only 6 decimals when dividing its widened sum types
                # (decimal(38,4) / bigint), which can round twice; narrower operands
                # keep 14, so the rounding to cents below is the only one.
                .withColumn("avg_unit_cost", safe_ratio(F.col("total_cost").cast("decimal(28,4)"),
                                                        F.col("total_qty").cast("decimal(18,0)"),
                                                        2, 0))
                .withColumn("total_cost", F.round(F.col("avg_unit_cost") * F.col("available_qty"), 2))
                .withColumn("total_value", F.round(F.col("unit_price") * F.col("available_qty"), 2))
                .withColumnRenamed("available_qty", "quantity"))

