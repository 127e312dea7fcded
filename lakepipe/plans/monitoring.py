"""Run monitoring report (X5) over the run log: one row per run.

Per run id: job name(s), retries (STARTED records − 1), manual trigger, first
start, last end, duration, rows and memory of the finishing record, distinct
errors, and a status rolled up by priority — any success → Success, else any
failure → Error, else only STARTED records older than 45 minutes → Timed out,
else Running (A4–A7, D9, D10, T6). Runs that started since the beginning of
the previous day are kept (F5), numbered by start time (W1, distributed — see
``global_row_number``) and sorted newest first (O1).

The per-run aggregate has map-side partial aggregation; the distinct-name
and distinct-error sets hold distinct values only, bounded by the number of
job names / error texts, not by the records of a run.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import minutes_before, ntz_literal, seconds_to_hms, start_of_day_before
from ..functions.text import last_segment
from ..operators.ordering import global_row_number

TIMEOUT_MINUTES = 45

REPORT_COLUMNS = ["ID", "Pipe name", "Retry", "Manual trigger", "Starting date", "Ending date",
                  "Duration", "Status", "Extracted rows", "Loaded rows", "Memory used",
                  "Error message"]


def _distinct_list(c):
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 0, F.array_join(s, ","))


def run_summaries(run_log: DataFrame, as_of: datetime) -> DataFrame:
    status = F.col("status_id")
    started = status == 0
    finished = status != 0
    return run_log.groupBy("uuid").agg(
        _distinct_list(last_segment("pipe_name")).alias("pipe_name"),
        (F.count_if(started) - 1).alias("retry"),
        F.bool_or("manual_trigger").alias("manual_trigger"),
        F.min(F.when(started, F.col("created_at"))).alias("starting_date"),
        F.max(F.when(finished, F.col("created_at"))).alias("ending_date"),
        seconds_to_hms(F.max(F.when(finished, F.col("duration")))).alias("duration"),
        F.when(F.count_if(status == 1) > 0, F.lit("Success"))
         .when(F.count_if(status == 2) > 0, F.lit("Error"))
         .when((F.max(status) == 0)
               & (F.min("created_at") < minutes_before(ntz_literal(as_of), TIMEOUT_MINUTES)),
               F.lit("Timed out"))
         .otherwise(F.lit("Running")).alias("status"),
        F.max(F.when(finished, F.col("extracted_rows"))).alias("extracted_rows"),
        F.max(F.when(finished, F.col("loaded_rows"))).alias("loaded_rows"),
        F.max(F.when(finished, F.col("dataframes_memory"))).alias("memory_used"),
        _distinct_list(F.col("error")).alias("error_message"),
    )


def monitoring_report(run_log: DataFrame, as_of: datetime, sort: bool = True) -> DataFrame:
    return numbered_report(run_summaries(run_log, as_of), as_of, sort)


def numbered_report(runs: DataFrame, as_of: datetime, sort: bool = True) -> DataFrame:
    """The report of run summaries: recent runs, numbered, under the report's column names."""
    recent = runs.where(F.col("starting_date") >= start_of_day_before(as_of, 1))
    numbered = global_row_number(recent, [F.col("starting_date"), F.col("uuid")], "ID")
    out = numbered.select(
        "ID", F.col("pipe_name").alias("Pipe name"), F.col("retry").alias("Retry"),
        F.col("manual_trigger").alias("Manual trigger"),
        F.col("starting_date").alias("Starting date"), F.col("ending_date").alias("Ending date"),
        F.col("duration").alias("Duration"), F.col("status").alias("Status"),
        F.col("extracted_rows").alias("Extracted rows"), F.col("loaded_rows").alias("Loaded rows"),
        F.col("memory_used").alias("Memory used"), F.col("error_message").alias("Error message"))
    return out.orderBy(F.col("Starting date").desc(), F.col("ID").desc()) if sort else out
