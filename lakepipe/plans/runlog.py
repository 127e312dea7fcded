"""Run log (K7, S11): one appended row per status change of a job run.

``dataframes_memory`` holds the size of the prepared output in whole MB (rounded up).
"""

from __future__ import annotations

from datetime import datetime, timezone
from enum import Enum

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sinks.loaders import LoadMode, load_table, table_exists


class RunStatus(Enum):
    STARTED = 0
    COMPLETED = 1
    FAILED = 2


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("pipe_name", T.StringType(), False),
    T.StructField("manual_trigger", T.BooleanType(), False),
    T.StructField("status_id", T.IntegerType(), False),
    T.StructField("duration", T.IntegerType(), False),
    T.StructField("extracted_rows", T.LongType(), False),
    T.StructField("dataframes_memory", T.IntegerType(), False),
    T.StructField("loaded_rows", T.LongType(), False),
    T.StructField("uuid", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), False),
])


def append_run_record(spark: SparkSession, table: str, *, job_name: str, run_id: str,
                      manual_trigger: bool, status: RunStatus, duration: int,
                      extracted_rows: int, loaded_rows: int, error: str | None, output_bytes: int = 0,
                      created_at: datetime | None = None) -> None:
    created_at = created_at or datetime.now(timezone.utc).replace(tzinfo=None)
    row = [(job_name, bool(manual_trigger), status.value, int(duration), int(extracted_rows),
            -(-int(output_bytes) // 2**20), int(loaded_rows), run_id, error, created_at)]
    df = spark.createDataFrame(row, RUN_LOG_SCHEMA)
    mode = LoadMode.INSERT if table_exists(spark, table) else LoadMode.DROP_INSERT
    load_table(df, table, mode)
