"""KPI export (X3): sales and purchase KPIs per day and geography, long format.

Both facts are filtered on their day (F2; Catalyst turns ``to_date(ts)
BETWEEN`` into a pushed half-open range on the timestamp) and become one tagged
table: the fact, its group (time, region_type, region, country), the order and the
amount. One aggregation gives every group's amount and distinct orders per fact
(``sums_and_distinct``): rows are folded into sums and bits of order ids in the
scan's tasks, so no order row is shuffled and no join is needed; the full outer merge
of the two facts' groups (J3) is the union of their KPI rows, as each KPI comes from
one fact. Null geography labels are replaced by ``N/A`` (the key is not-null), KPIs are
unpivoted (R1), rounded (M1), and zero and missing values dropped (F4).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_literal, default_window
from ..operators.aggregate import sums_and_distinct
from ..schema import ColumnSpec, OutputSchema
from .job import BatchJob, Destination, RunContext

GROUP_COLS = ["time", "region_type", "region", "country"]
VALUE_TYPE = T.DecimalType(18, 2)

SCHEMA = OutputSchema(
    "kpi_export",
    ColumnSpec("time", T.DateType(), primary_key=True),
    ColumnSpec("region_type", T.StringType(), primary_key=True),
    ColumnSpec("region", T.StringType(), primary_key=True),
    ColumnSpec("country", T.StringType(), primary_key=True),
    ColumnSpec("kpi_name", T.StringType(), primary_key=True),
    ColumnSpec("value", VALUE_TYPE, default=0),
)


@dataclass
class KpiExportParameters:
    min_date: str | None = None  # default: as_of - 7 days (D11)
    max_date: str | None = None  # default: as_of


def _window(params: KpiExportParameters, ctx: RunContext) -> tuple[str, str]:
    lo, hi = default_window(ctx.as_of, 7)
    return params.min_date or lo, params.max_date or hi


def in_window(ts_col: str, lo: str, hi: str):
    day = F.to_date(F.col(ts_col))
    return day.between(date_literal(lo), date_literal(hi))


#: The KPIs of each fact: its amount and its distinct orders.
KPI_NAMES = {"sales": ("net_subtotal", "sales_orders"), "purchases": ("total", "purchase_orders")}


def tagged(fact: str, df: DataFrame, order: str, amount: str) -> DataFrame:
    return df.select(F.lit(fact).alias("fact"), *GROUP_COLS, F.col(order).alias("order"),
                     F.col(amount).alias("amount"))


def kpi_rows(facts: DataFrame) -> DataFrame:
    """(group, kpi_name, value) of the tagged facts."""
    totals = sums_and_distinct(facts, ["fact", *GROUP_COLS], ["amount"], "order", "orders")
    parts = []
    for fact, (amount, orders) in KPI_NAMES.items():
        both = [F.struct(F.lit(name).alias("kpi_name"), F.col(c).cast(VALUE_TYPE).alias("value"))
                for name, c in ((amount, "amount"), (orders, "orders"))]
        parts.append(F.when(F.col("fact") == fact, F.array(*both)))
    return totals.select(*GROUP_COLS, F.inline(F.coalesce(*parts)))


class KpiExport(BatchJob):
    """Inputs: ``customer_sales``, ``customer_purchases``."""

    parameter_class = KpiExportParameters
    schema = SCHEMA
    destination = Destination(export_name="kpi", gzip_copy=True)

    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = sources

    def extract(self, spark: SparkSession, params, ctx: RunContext) -> dict[str, DataFrame]:
        lo, hi = _window(params, ctx)
        # key columns are not-null in the output: missing labels become N/A up
        # front, so both aggregates and the merge partition on the same keys
        geo = [F.coalesce(F.col(c), F.lit("N/A")).alias(c)
               for c in ["country", "region_type", "region"]]
        sales = (self.sources["customer_sales"].where(in_window("order_date", lo, hi))
                 .select(F.to_date("order_date").alias("time"), *geo, "order_id", "net_subtotal"))
        purchases = (self.sources["customer_purchases"].where(in_window("order_date", lo, hi))
                     .select(F.to_date("order_date").alias("time"), *geo, "po_id", "total"))
        return {"sales": sales, "purchases": purchases}

    def transform(self, inputs, params, ctx: RunContext) -> DataFrame:
        sales, purchases = inputs["sales"], inputs["purchases"]
        long = kpi_rows(tagged("sales", sales, "order_id", "net_subtotal")
                        .unionByName(tagged("purchases", purchases, "po_id", "total")))
        long = long.withColumn("value", F.round("value", 2))
        return long.where(F.col("value").isNotNull() & (F.col("value") != 0))
