"""Date dimension (X4): one row per day with calendar attributes.

The calendar is generated with ``spark.range`` over several partitions and
every attribute is a native expression (no per-row Python), so the job is a
single narrow stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.dates import date_attributes
from ..schema import ColumnSpec, OutputSchema, varchar
from ..sinks.loaders import LoadMode
from ..sources.calendar import date_range
from .job import BatchJob, Destination, RunContext

_I, _L = T.IntegerType(), T.LongType()

SCHEMA = OutputSchema(
    "dim_date",
    ColumnSpec("id", _I, primary_key=True),
    ColumnSpec("date", T.DateType(), nullable=False),
    ColumnSpec("day_num", _I, nullable=False),
    varchar("week_day_name", 255, nullable=False),
    ColumnSpec("week_day_num", _I, nullable=False),
    ColumnSpec("month_num", _I, nullable=False),
    varchar("month_name", 255, nullable=False),
    ColumnSpec("is_month_start", _I, nullable=False),
    ColumnSpec("is_month_end", _I, nullable=False),
    ColumnSpec("quarter_num", _I, nullable=False),
    ColumnSpec("year", _I, nullable=False),
    ColumnSpec("week_num", _I, nullable=False),
    ColumnSpec("start_unix", _L, nullable=False),
    ColumnSpec("end_unix", _L, nullable=False),
)


@dataclass
class DateDimensionParameters:
    start_date: str = "2000-01-01"
    end_date: str = "2099-12-31"


class DateDimension(BatchJob):
    parameter_class = DateDimensionParameters
    schema = SCHEMA
    destination = Destination(table="dim_date", load_mode=LoadMode.DROP_INSERT)

    def extract(self, spark: SparkSession, params, ctx: RunContext) -> dict[str, DataFrame]:
        days = date_range(spark, params.start_date, params.end_date, "date")
        return {"data": days.select(*[c.alias(n) for n, c in date_attributes("date").items()])}
