"""SQL text over DataFrames with bound parameters.

``{name}`` references bind DataFrames (no global views), ``:name`` markers bind
values as typed literals through Spark's parameterized SQL, so no value is ever
spliced into the SQL text. Catalyst plans the query like any DataFrame code
(filters and projections reach the scans).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, params: dict[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    return spark.sql(sql, args=params or None, **frames)
