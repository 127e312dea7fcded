"""Incremental JSON folder ingestion: only new files are processed per run."""

from __future__ import annotations

import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest

from lakepipe.plans.monitoring import monitoring_report
from lakepipe.plans.runlog import RUN_LOG_SCHEMA

from lakepipe.sources.json_docs import JsonShape
from lakepipe.streaming import ingest_json_folder, read_ingested
from lakepipe.streaming.run_report import current_summaries, report_from, run_summaries_stream


def test_ingest_new_files_only(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"id": 1, "tags": ["x", "y"]}))
    (src / "b.json").write_text('{"id": 2, "tags": []}\n{"id": 3, "tags": ["z"]}\n')  # NDJSON
    q = ingest_json_folder(spark, str(src), out, checkpoint=ck)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in read_ingested(spark, out).select("id", "tags").collect())
    # a.json: one list → exploded; b.json lines are members of a list document → lists kept
    assert first == [(1, "x"), (1, "y"), (2, "[]"), (3, '["z"]')]
    (src / "c.json").write_text(json.dumps([{"id": 4}]))
    q = ingest_json_folder(spark, str(src), out, checkpoint=ck)
    q.awaitTermination(120)
    ids = sorted(r["id"] for r in read_ingested(spark, out).collect())
    assert ids == [1, 1, 2, 3, 4]


def test_default_checkpoint_resumes(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.json").write_text(json.dumps({"id": 1}))
    ingest_json_folder(spark, str(src), out).awaitTermination(120)
    (src / "b.json").write_text(json.dumps({"id": 2}))
    ingest_json_folder(spark, str(src), out).awaitTermination(120)
    assert sorted(r["id"] for r in read_ingested(spark, out).collect()) == [1, 2]


def test_rows_are_written_once_over_batches(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    shape = JsonShape("STRUCT<id: BIGINT, u: STRUCT<n: STRING>, tags: ARRAY<STRING>>", None, True)

    def row(i, **more):
        return {"id": i, "u": {"n": f"n{i}"}, **more}

    files = [[row(1), row(2), row(1)], [row(2), row(3), row(4, tags=["a"])], [row(4, tags=["a"]), row(4), row(1)]]
    for k, members in enumerate(files):
        (src / f"{k}.json").write_text(json.dumps(members))
    q = ingest_json_folder(spark, str(src), out, shape=shape, within="7 days", max_files_per_trigger=1)
    q.awaitTermination(120)
    assert len([p for p in q.recentProgress if p["numInputRows"]]) == 3
    (src / "later.json").write_text(json.dumps([row(3), row(5), row(5)]))
    ingest_json_folder(spark, str(src), out, shape=shape, within="7 days").awaitTermination(120)
    written = [tuple(r) for r in spark.read.parquet(out).select("id", "`u.n`", "tags").collect()]
    want = {(1, "n1", None), (2, "n2", None), (3, "n3", None), (4, "n4", '["a"]'), (4, "n4", None), (5, "n5", None)}
    assert len(written) == len(want) and set(written) == want
    with pytest.raises(ValueError, match="shape"):
        ingest_json_folder(spark, str(src), out, within="7 days")


def _log_records(rnd, n, start):
    """Records of ``n`` runs: starts, retries, ends, failures, runs without an end, several names."""
    out = []
    for k in range(n):
        run, at = f"run-{start + k}", datetime(2024, 1, 30, 12) + timedelta(minutes=rnd.randrange(2160))
        for t in range(rnd.choice((1, 1, 2, 3))):
            out.append((f"jobs.{rnd.choice('ab')}.Pipe{rnd.randrange(3)}", rnd.random() < 0.5, 0, 0, 0, 0, 0, run, None, at + timedelta(minutes=t)))
        for status in rnd.choice(((), (1,), (2,), (2, 1), (2, 2))):
            out.append((f"jobs.a.Pipe{rnd.randrange(3)}", False, status, rnd.randrange(9000), rnd.randrange(100), rnd.randrange(5), rnd.randrange(90),
                        run, f"E{rnd.randrange(3)}" if status == 2 else None, at + timedelta(minutes=9 + status)))
    rnd.shuffle(out)
    return out


def test_incremental_report_equals_the_batch_report_after_every_batch(spark, tmp_path):
    rnd = random.Random(12)
    log, out, as_of = str(tmp_path / "log"), str(tmp_path / "out"), datetime(2024, 1, 31, 23)
    records = _log_records(rnd, 60, 0)
    for k in range(3):
        # a run's records come in any batch; one batch brings rows that are there already
        part = records[k::3] + (records[:5] if k == 2 else [])
        spark.createDataFrame(part, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)
        run_summaries_stream(spark, log, out).awaitTermination(120)
        got = report_from(current_summaries(spark, out), as_of).collect()
        want = monitoring_report(spark.read.schema(RUN_LOG_SCHEMA).parquet(log), as_of).collect()
        assert got == want and len(got) > 10, k
    assert {r["Status"] for r in got} == {"Success", "Error", "Timed out", "Running"} - {"Running"} | {r["Status"] for r in want}


def test_a_run_without_an_end_is_told_by_its_timer(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    at = datetime(2024, 1, 31, 8)
    rows = [("jobs.a.P", True, 0, 0, 0, 0, 0, "open", None, at), ("jobs.a.P", True, 0, 0, 0, 0, 0, "done", None, at),
            ("jobs.a.P", True, 1, 5, 1, 1, 1, "done", None, at)]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).write.parquet(log)
    q = run_summaries_stream(spark, log, out, trigger="1 second", timeout_minutes=0.02)
    try:
        for _ in range(60):
            time.sleep(1)
            if os.path.isdir(out) and any(n.startswith("batch=") for n in os.listdir(out)):
                found = {r["uuid"]: r for r in current_summaries(spark, out).collect()}
                if found.get("open") and found["open"]["overdue"]:
                    break
    finally:
        q.stop()
    assert found["open"]["overdue"] and not found["done"]["overdue"]
    assert found["open"]["started"] == 1 and found["done"]["succeeded"] == 1
