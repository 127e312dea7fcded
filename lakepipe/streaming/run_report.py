"""Incremental run report (S11, X5, A4–A7, D9): run summaries kept up to date from a stream of run-log records.

The batch report aggregates the whole log each time. Here each run is a key of streaming state that holds its summary so far
(a few numbers and the sets of its job names and errors, never its records), and a micro-batch touches only the runs it has records of.

Scheduled runs (``available_now``) use Spark's own streaming aggregation; its state is one row per run of the log. A stream that
runs all the time can set timers, which aggregations cannot: there a run that has started and not ended gets one, and when
``timeout_minutes`` pass without a record, its summary is given out once more as overdue, without any record to trigger it; the state
of a run is dropped ``keep_days`` after its last record. That takes a Python call per run and batch, which suits a live log and not the
catching up of a long one. A checkpoint serves one of the two kinds.

Every batch appends the summaries that changed to ``<target>/batch=<id>``; a batch that is repeated after a failure rewrites its own
folder. ``current_summaries`` takes the last summary of each run, and ``report_from`` makes of them the report that
``monitoring_report`` makes of the whole log: same columns, numbers, statuses and order.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.dates import minutes_before, ntz_literal, seconds_to_hms
from ..functions.text import last_segment
from ..plans.monitoring import TIMEOUT_MINUTES, numbered_report
from ..plans.runlog import RUN_LOG_SCHEMA

STATE = ("names array<string>, errors array<string>, started bigint, succeeded bigint, failed bigint, highest int, manual boolean, "
         "first_record timestamp_ntz, starting_date timestamp_ntz, ending_date timestamp_ntz, duration bigint, extracted_rows bigint, "
         "loaded_rows bigint, memory_used bigint")
SUMMARY = f"uuid string, {STATE}, overdue boolean"
_FIELDS = [c.split()[0] for c in STATE.split(", ")]
_HOUR_MS = 3_600_000
#: In place of the highest status: an open run that was given out as overdue.
TOLD = -1


def _known(values: list) -> list:
    return [v for v in values if v is not None and v == v]  # neither null nor not-a-number


def folded(before: tuple | None, records: pd.DataFrame) -> tuple:
    """The summary of a run after some more of its records."""
    s = dict(zip(_FIELDS, before or (None,) * len(_FIELDS), strict=True))
    r = {c: records[c].tolist() for c in RUN_LOG_SCHEMA.names if c != "created_at"}
    r["created_at"] = [None if t is pd.NaT else t for t in records["created_at"].tolist()]
    ended = [k for k, status in enumerate(r["status_id"]) if status != 0]
    begun = [k for k, status in enumerate(r["status_id"]) if status == 0]

    def joined(field: str, more: list[str]) -> list[str]:
        return sorted({*(s[field] if s[field] is not None else []), *more})

    def best(pick, field: str, column: str, rows) -> object:
        return pick(_known([s[field], *(r[column][k] for k in rows)]), default=None)

    out = {
        # the text after the last dot, as the batch report takes it
        "names": joined("names", [n.rpartition(".")[2] for n in _known(r["pipe_name"])]),
        "errors": joined("errors", _known(r["error"])),
        "started": (s["started"] or 0) + len(begun),
        "succeeded": (s["succeeded"] or 0) + r["status_id"].count(1),
        "failed": (s["failed"] or 0) + r["status_id"].count(2),
        "highest": best(max, "highest", "status_id", range(len(records))),
        "manual": bool(s["manual"]) or any(_known(r["manual_trigger"])),
        "first_record": best(min, "first_record", "created_at", range(len(records))),
        "starting_date": best(min, "starting_date", "created_at", begun),
        "ending_date": best(max, "ending_date", "created_at", ended),
        "duration": best(max, "duration", "duration", ended),
        "extracted_rows": best(max, "extracted_rows", "extracted_rows", ended),
        "loaded_rows": best(max, "loaded_rows", "loaded_rows", ended),
        "memory_used": best(max, "memory_used", "dataframes_memory", ended),
    }
    return tuple(out[f] for f in _FIELDS)


def _ended(summary: tuple) -> bool:
    return bool(summary[_FIELDS.index("succeeded")] or summary[_FIELDS.index("failed")])


def _updater(timeout_minutes: float, keep_days: int):
    highest = _FIELDS.index("highest")

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get if state.exists else None
        if state.hasTimedOut:
            if not _ended(before) and before[highest] != TOLD:
                # the first timer of an open run tells that it is overdue, the next one drops the state
                yield _row(key, before, True)
                state.update((*before[:highest], TOLD, *before[highest + 1:]))
                state.setTimeoutDuration(keep_days * 24 * _HOUR_MS)
            else:
                state.remove()
            return
        if before is not None and before[highest] == TOLD:
            before = (*before[:highest], 0, *before[highest + 1:])
        for records in batches:
            before = folded(before, records)
        state.update(before)
        state.setTimeoutDuration(keep_days * 24 * _HOUR_MS if _ended(before) else int(timeout_minutes * 60_000))
        yield _row(key, before, False)

    return update


def _summed(records: DataFrame) -> DataFrame:
    """SUMMARY of each run as a streaming aggregation."""
    status = F.col("status_id")

    def ended(f, c: str):
        return f(F.when(status != 0, F.col(c)))

    columns = {
        "names": F.array_sort(F.collect_set(last_segment("pipe_name"))), "errors": F.array_sort(F.collect_set("error")),
        "started": F.count_if(status == 0), "succeeded": F.count_if(status == 1), "failed": F.count_if(status == 2),
        "highest": F.max(status), "manual": F.coalesce(F.bool_or("manual_trigger"), F.lit(False)),
        "first_record": F.min("created_at"), "starting_date": F.min(F.when(status == 0, F.col("created_at"))),
        "ending_date": ended(F.max, "created_at"), "duration": ended(F.max, "duration").cast("long"),
        "extracted_rows": ended(F.max, "extracted_rows"), "loaded_rows": ended(F.max, "loaded_rows"),
        "memory_used": ended(F.max, "dataframes_memory").cast("long"),
    }
    return records.groupBy("uuid").agg(*[columns[f].alias(f) for f in _FIELDS]).withColumn("overdue", F.lit(False))


def _row(key: tuple, summary: tuple, overdue: bool) -> pd.DataFrame:
    out = pd.DataFrame([[key[0], *summary, overdue]], columns=["uuid", *_FIELDS, "overdue"])
    for c in ("first_record", "starting_date", "ending_date"):
        out[c] = pd.to_datetime(out[c])
    return out


def run_summaries_stream(spark: SparkSession, log_dir: str, target_dir: str, *, checkpoint: str | None = None,
                         trigger: str = "available_now", max_files_per_trigger: int = 1000,
                         timeout_minutes: float = TIMEOUT_MINUTES, keep_days: int = 3) -> StreamingQuery:
    """Follow the folder of a run-log table (see ``runlog``) and append changed summaries under ``target_dir``."""
    target, live = target_dir.rstrip("/"), trigger != "available_now"
    records = spark.readStream.schema(RUN_LOG_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(log_dir)
    if live:
        changed = records.groupBy("uuid").applyInPandasWithState(
            _updater(timeout_minutes, keep_days), SUMMARY, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout)
    else:
        changed = _summed(records)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = (changed.writeStream.outputMode("update").foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint or f"{target}/_checkpoint"))
    return (writer.trigger(processingTime=trigger) if live else writer.trigger(availableNow=True)).start()


def current_summaries(spark: SparkSession, target_dir: str) -> DataFrame:
    """The last summary of each run."""
    rows = spark.read.schema(f"{SUMMARY}, batch bigint").parquet(target_dir)
    last = F.max_by(F.struct(*[F.col(c) for c in (*_FIELDS, "overdue")]), "batch").alias("s")
    return rows.groupBy("uuid").agg(last).select("uuid", "s.*")


def report_from(summaries: DataFrame, as_of: datetime, sort: bool = True) -> DataFrame:
    """The monitoring report of the runs in ``current_summaries``."""
    def listed(c: str):
        return F.when(F.size(c) > 0, F.array_join(c, ","))

    late = F.col("first_record") < minutes_before(ntz_literal(as_of), TIMEOUT_MINUTES)
    runs = summaries.select(
        "uuid", listed("names").alias("pipe_name"), (F.col("started") - 1).alias("retry"), F.col("manual").alias("manual_trigger"),
        "starting_date", "ending_date", seconds_to_hms("duration").alias("duration"),
        F.when(F.col("succeeded") > 0, F.lit("Success")).when(F.col("failed") > 0, F.lit("Error"))
         .when((F.col("started") > 0) & F.col("ending_date").isNull() & late, F.lit("Timed out")).otherwise(F.lit("Running")).alias("status"),
        "extracted_rows", "loaded_rows", "memory_used", listed("errors").alias("error_message"))
    return numbered_report(runs, as_of, sort)
