"""Sinks (K1–K11, X6) and whole-job behaviour (X8, K7), plus plan properties (§5.6)."""

from __future__ import annotations

import csv
import gzip
import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from lakepipe import registry
from lakepipe.errors import CheckFailed, NotFound
from lakepipe.plans.job import BatchJob, Destination, RunContext
from lakepipe.schema import ColumnSpec, OutputSchema
from lakepipe.sinks.loaders import key_conflicts
from lakepipe.sinks import (LoadMode, dated_key, export_csv, load_table, mirror_tables,
                            period_label, select_tables)

from .conftest import SF_ORACLE


def _name(base):
    return f"{base}_{uuid.uuid4().hex[:8]}"


def test_load_modes(spark):
    t = _name("t_modes")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    with pytest.raises(NotFound):
        load_table(df, t, LoadMode.TRUNCATE_INSERT)
    load_table(df, t, LoadMode.INSERT)                       # creates
    load_table(df.withColumn("name", F.upper("name")), t, LoadMode.TRUNCATE_INSERT)
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(1, "A"), (2, "B")]
    with pytest.raises(CheckFailed, match="more than once"):
        load_table(df, t, LoadMode.INSERT, key=["id"])
    load_table(spark.createDataFrame([(3, "c")], "id long, name string"), t, LoadMode.INSERT, key=["id"])
    assert spark.table(t).count() == 3
    load_table(df, t, LoadMode.DROP_INSERT)
    assert spark.table(t).count() == 2


def test_export_csv_quoting_nulls_and_single_file(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'say "hi"', None, True, datetime(2024, 1, 2, 3, 4, 5)),
         (2, " a,b ", "", False, None)],
        "id int, txt string, empty string, flag boolean, ts timestamp_ntz")
    path = str(tmp_path / "out" / "x.csv")
    res = export_csv(df, path, single_file=True)
    assert res.row_count == 2 and res.bytes > 0 and os.path.isfile(path)
    with open(path, newline="", encoding="utf-8") as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == ["id", "txt", "empty", "flag", "ts"]
    assert sorted(rows[1:]) == [["1", 'say "hi"', "", "True", "2024-01-02 03:04:05"],
                                ["2", " a,b ", "", "False", ""]]
    gz = str(tmp_path / "out" / "y.csv.gz")
    export_csv(df, gz, single_file=True, compression="gzip")
    with gzip.open(gz, "rt") as fh:
        assert fh.readline().strip() == "id,txt,empty,flag,ts"
    # too large: nothing is published, what was delivered before stays
    for single in (False, True):
        target = str(tmp_path / f"z{single}")
        export_csv(df, target, single_file=single)
        with pytest.raises(CheckFailed, match="more bytes"):
            export_csv(df, target, single_file=single, size_limit=10)
        assert os.path.exists(target) and not os.path.exists(target + ".parts")
        export_csv(df, target, single_file=single, size_limit=10**6)
        assert os.path.isfile(target) if single else os.listdir(target)


def test_dated_key_and_period_label(spark):
    assert dated_key("exports/inv", "inventory", date(2024, 3, 7)) == \
        "exports/inv/year=2024/month=03/inventory_2024-03-07.csv"
    df = spark.createDataFrame([("2024-01-01", "2024-01-31"), (None, "2024-01-31"), (" ", None)],
                               "lo string, hi string")
    got = [r[0] for r in df.select(period_label(F.col("lo"), F.col("hi"),
                                                F.lit("2024-02-01").cast("date"))).collect()]
    assert got == ["2024-01-01 to 2024-01-31", "2024-01-31", "2024-02-01"]


def test_mirror_tables_and_groups(spark):
    groups = {"erp": {"tables": ["a", "b"], "dims": ["a"]}}
    assert select_tables(groups, "erp") == ["a", "b"]
    assert select_tables(groups, "erp", "dims") == ["a"]
    assert select_tables(groups, "erp", tables=["c"]) == ["c"]
    with pytest.raises(KeyError):
        select_tables(groups, "erp", "nope")
    src = {"a": spark.range(10).withColumn("gen", F.col("id") * 2), "b": spark.range(3)}
    prefix = _name("m") + "_"
    out = mirror_tables(spark, src, target_prefix=prefix, generated_columns={"a": ["gen"]})
    assert sorted(tuple(r) for r in out.collect()) == [("a", 10, 10), ("b", 3, 3)]
    assert spark.table(prefix + "a").columns == ["id"]
    # second run truncates and refills, keeping the definition
    out = mirror_tables(spark, {"a": spark.range(4).withColumn("gen", F.lit(0))},
                        target_prefix=prefix, generated_columns={"a": ["gen"]})
    assert [tuple(r) for r in out.collect()] == [("a", 4, 4)]


class _Tiny(BatchJob):
    schema = OutputSchema("tiny", ColumnSpec("id", T.LongType(), primary_key=True),
                          ColumnSpec("v", T.StringType(), nullable=False))

    def __init__(self, rows):
        self.rows = rows

    def extract(self, spark, params, ctx):
        return {"data": spark.createDataFrame(self.rows, "id long, v string")}


def test_job_run_checks_before_writing_and_logs(spark):
    log, target = _name("log"), _name("tiny")
    ctx = RunContext(as_of=datetime(2024, 1, 1), run_log_table=log)
    stats = _Tiny([(1, "a"), (2, " b ")]).run(spark, None, ctx, Destination(table=target))
    assert stats["loaded_rows"] == 2 and stats["extracted_rows"] == 2
    assert sorted(tuple(r) for r in spark.table(target).collect()) == [(1, "a"), (2, "b")]
    bad_ctx = RunContext(as_of=datetime(2024, 1, 1), run_log_table=log)
    bad_target = _name("tiny_bad")
    with pytest.raises(CheckFailed):
        _Tiny([(1, "a"), (2, "NULL")]).run(spark, None, bad_ctx, Destination(table=bad_target))
    assert not spark.catalog.tableExists(bad_target)          # nothing was written
    statuses = sorted((r["uuid"] == ctx.run_id, r["status_id"], r["error"])
                      for r in spark.table(log).collect())
    assert statuses == [(False, 0, None), (False, 2, "v: a value is missing (rows=1)"),
                        (True, 0, None), (True, 1, None)]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_registered_query(spark):
    for name, fn in registry.QUERIES.items():
        plan = _plan(fn(spark, SF_ORACLE))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_inventory_export_broadcasts_by_size_without_a_job(spark):
    """Label tables are broadcast by their bytes; building the frame neither counts nor funnels rows."""
    tracker = spark.sparkContext.statusTracker()
    group = _name("build")
    spark.sparkContext.setJobGroup(group, "build only")
    df = E.queries()["inventory_export"](spark, SF_ORACLE)
    plan = _plan(df)
    # reading a parquet schema may start a job of one task; the dimensions are not counted
    assert len(tracker.getJobIdsForGroup(group)) <= 8
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("BroadcastHashJoin") >= 10 and "SinglePartition" not in plan


def test_kpi_window_filter_reaches_the_scan(spark):
    from lakepipe.plans.kpi_export import KpiExport, KpiExportParameters
    from lakepipe.sources.fixtures import adapters
    srcs = adapters(spark, SF_ORACLE, ["customer_sales", "customer_purchases"])
    df = KpiExport(srcs).build(spark, KpiExportParameters("1996-01-01", "1996-01-31"),
                               RunContext(as_of=datetime(2024, 1, 1)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_inventory_snapshot_aggregates_before_the_join(spark):
    plan = E.queries()["inventory_snapshot"](spark, SF_ORACLE)._jdf.queryExecution() \
        .optimizedPlan().toString()
    # the aggregate over stock rows sits below the product join
    assert plan.index("Join Inner") < plan.rindex("Aggregate [product_id")


def test_debug_run_writes_csv_and_warns_on_empty_input(spark, recwarn):
    import warnings
    ctx = RunContext(as_of=datetime(2024, 1, 1), debug=True)
    stats = _Tiny([(1, "a")]).run(spark, None, ctx, Destination(table=_name("never")))
    assert stats["loaded_rows"] == 1
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        _Tiny([]).run(spark, None, RunContext(as_of=datetime(2024, 1, 1), debug=True),
                      Destination(table=_name("never")))
    assert any("has no rows" in str(x.message) for x in w)


def test_enforce_not_empty_and_default_window(spark):
    from lakepipe.functions import default_window
    from lakepipe.operators.quality import enforce_not_empty
    with pytest.raises(CheckFailed):
        enforce_not_empty(spark.range(0), "t")
    enforce_not_empty(spark.range(1), "t")
    assert default_window(datetime(2024, 3, 8, 5), 7) == ("2024-03-01", "2024-03-08")


def test_sql_parameters_reach_the_scan(spark):
    from datetime import date as _date

    from lakepipe.registry import _SALES_SQL
    from lakepipe.sources.fixtures import adapter
    from lakepipe.sources.sql import run_sql
    df = run_sql(spark, _SALES_SQL, {"min_date": _date(1996, 1, 1), "max_date": _date(1996, 1, 31)},
                 customer_sales=adapter(spark, SF_ORACLE, "customer_sales"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan
    assert df.where(F.col("time") > F.lit("1996-01-31").cast("date")).count() == 0


def test_jdbc_connection_options_keep_password_out_of_the_url(spark, monkeypatch):
    from lakepipe.sources.jdbc import Connection, read_table
    c = Connection("dwh", "mysql", "db.local", None, "etl", "p@ss/word", "sales")
    assert c.url == "jdbc:mysql://db.local:3306/sales"
    opts = c.options(dbtable="t", fetchsize=100)
    assert opts["password"] == "p@ss/word" and "p@ss" not in opts["url"]
    assert opts["driver"] == "com.mysql.cj.jdbc.Driver" and opts["fetchsize"] == "100"
    monkeypatch.setenv("PG_HOST", "pg")
    monkeypatch.setenv("PG_USER", "u")
    pg = Connection.from_env("erp", "PG", "postgresql", "erp")
    assert pg.url == "jdbc:postgresql://pg:5432/erp" and pg.user == "u"
    with pytest.raises(CheckFailed):
        read_table(spark, c, "orders; drop table x")


def test_real_jobs_run_end_to_end(spark, tmp_path):
    from lakepipe.plans.inventory_export import InventoryExport
    from lakepipe.plans.inventory_snapshot import InventorySnapshot
    from lakepipe.plans.kpi_export import KpiExport, KpiExportParameters
    from lakepipe.registry import _X2_DIMS
    from lakepipe.sources.fixtures import adapters
    as_of = datetime(2024, 1, 31)
    log = _name("runs")
    kpi = KpiExport(adapters(spark, SF_ORACLE, ["customer_sales", "customer_purchases"]))
    params = KpiExportParameters("1996-01-01", "1996-03-31")
    out = str(tmp_path / "kpi")
    stats = kpi.run(spark, params, RunContext(as_of=as_of, run_log_table=log),
                    Destination(csv_path=out, compression="gzip"))
    assert stats["loaded_rows"] == kpi.build(spark, params, RunContext(as_of=as_of)).count() > 0
    assert spark.read.option("header", True).csv(out).count() == stats["loaded_rows"]

    inv = InventoryExport(adapters(spark, SF_ORACLE, _X2_DIMS))
    stats = inv.run(spark, None, RunContext(as_of=as_of, run_log_table=log),
                    Destination(csv_path=str(tmp_path / "inv")))
    assert stats["loaded_rows"] == 12053

    snap = InventorySnapshot(adapters(spark, SF_ORACLE, ["stock_quantities", "products", "product_prices"]))
    target = _name("fact_inventory")
    stats = snap.run(spark, None, RunContext(as_of=as_of, run_log_table=log),
                     Destination(table=target, load_mode=LoadMode.INSERT))
    assert stats["loaded_rows"] == spark.table(target).count() == 1771
    # a second snapshot for the same day violates the key (date, product, warehouse)
    with pytest.raises(CheckFailed, match="more than once"):
        snap.run(spark, None, RunContext(as_of=as_of, run_log_table=log),
                 Destination(table=target, load_mode=LoadMode.INSERT))
    statuses = [r["status_id"] for r in spark.table(log).orderBy("created_at").collect()]
    assert statuses.count(1) == 3 and statuses.count(2) == 1


def test_load_jdbc_modes_map_to_writer_options(spark, monkeypatch):
    """Without a database server: record what the JDBC writer would be asked to do."""
    import lakepipe.sources.jdbc as J
    calls = []
    monkeypatch.setattr(J, "write_table", lambda df, conn, table, mode, **kw: calls.append(
        (table, mode, kw.get("truncate", False))))
    monkeypatch.setattr(J, "table_exists_jdbc", lambda spark, conn, table: table == "present")
    conn = J.Connection("dwh", "mysql", "h", 3306, "u", "p", "db")
    df = spark.createDataFrame([(1,)], "id long")
    J.load_jdbc(df, conn, "t", LoadMode.DROP_INSERT)
    J.load_jdbc(df, conn, "present", LoadMode.TRUNCATE_INSERT)
    with pytest.raises(NotFound):
        J.load_jdbc(df, conn, "absent", LoadMode.TRUNCATE_INSERT)
    J.load_jdbc(df, conn, "absent", LoadMode.INSERT, key=["id"])
    monkeypatch.setattr(J, "read_table", lambda spark, conn, table, **kw: spark.range(3))
    with pytest.raises(CheckFailed, match="more than once"):
        J.load_jdbc(df, conn, "present", LoadMode.INSERT, key=["id"])
    assert calls == [("t", "overwrite", False), ("present", "overwrite", True),
                     ("absent", "append", False)]


def test_insert_reattaches_data_left_by_an_earlier_catalog(spark, tmp_path):
    t = _name("t_reattach")
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    path = str(tmp_path / t)
    load_table(df, t, LoadMode.DROP_INSERT, path=path)
    spark.sql(f"DROP TABLE {t}")              # external table: the files stay
    with pytest.raises(CheckFailed, match="more than once"):
        load_table(df, t, LoadMode.INSERT, key=["id"], path=path)
    load_table(spark.createDataFrame([(2, "b")], "id long, name string"), t, LoadMode.INSERT,
               key=["id"], path=path)
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(1, "a"), (2, "b")]


def test_export_partitioned_by_year_and_month(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 9)), (3, date(2024, 2, 10))],
                               "id int, d date")
    df = df.withColumn("year", F.year("d")).withColumn("month", F.date_format("d", "MM"))
    out = str(tmp_path / "exp")
    res = export_csv(df, out, partition_by=["year", "month"])
    assert res.row_count == 3 and res.files >= 2 and res.bytes > 0
    assert os.path.isdir(os.path.join(out, "year=2024", "month=02"))
    back = spark.read.option("header", True).csv(out)
    assert back.where("month = 2").count() == 2


def test_no_cross_joins_and_no_unbounded_global_windows(spark):
    for name, fn in registry.QUERIES.items():
        plan = _plan(fn(spark, SF_ORACLE))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        # the only window operator anywhere is global_row_number's running sum over
        # its per-partition counts (one row per partition)
        windows = [l for l in plan.split("\n") if "Window [" in l]
        assert all("_part" in l for l in windows), (name, windows)


def test_run_without_destination_fails_before_any_work(spark):
    log = _name("log_nodest")
    with pytest.raises(ValueError, match="names no table"):
        _Tiny([(1, "a")]).run(spark, None, RunContext(run_log_table=log), Destination())
    assert not spark.catalog.tableExists(log)


def test_bucketed_tables_join_without_shuffle(spark):
    a, b = _name("fact_b"), _name("dim_b")
    load_table(spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v")),
               a, LoadMode.DROP_INSERT, bucket_by=(8, ["k"]))
    load_table(spark.range(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")),
               b, LoadMode.DROP_INSERT, bucket_by=(8, ["k"]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(a).join(spark.table(b), "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_insert_rejects_keys_repeated_in_the_batch(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, name string")
    t = _name("t_batch")
    for target in (t, t):                                    # a new and an existing table
        with pytest.raises(CheckFailed, match="more than once"):
            load_table(df, target, LoadMode.INSERT, key=["id"])
        load_table(df.where("name = 'c'").limit(0), target, LoadMode.INSERT, key=["id"])
    assert spark.table(t).count() == 0


def test_key_check_reads_only_the_partitions_of_the_batch(spark):
    t = _name("t_parts")
    rows = spark.range(40).select((F.col("id") % 4).alias("day"), "id")
    load_table(rows, t, LoadMode.INSERT, key=["day", "id"], partition_by=["day"])
    new = spark.createDataFrame([(2, 100)], "day long, id long")
    plan = _plan(key_conflicts(new, spark.table(t), ["day", "id"], ["day"]))
    assert "PartitionFilters: [" in plan and "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    load_table(new, t, LoadMode.INSERT, key=["day", "id"])
    with pytest.raises(CheckFailed, match="more than once"):
        load_table(new, t, LoadMode.INSERT, key=["day", "id"])


class _TwoInputs(_Tiny):
    def extract(self, spark, params, ctx):
        return super().extract(spark, params, ctx) | {"unused": spark.range(7)}


def test_job_with_an_unread_input_ends_and_counts_it(spark):
    stats = _TwoInputs([(1, "a")]).run(spark, None, RunContext(), Destination(table=_name("unread")))
    assert stats["inputs"] == {"data": 1, "unused": 7} and stats["loaded_rows"] == 1


def test_job_into_an_existing_empty_table_is_completed(spark):
    log, t = _name("log"), _name("was_empty")
    load_table(spark.createDataFrame([], "id long, v string"), t, LoadMode.DROP_INSERT)
    stats = _Tiny([(i, "x") for i in range(50)]).run(spark, None, RunContext(run_log_table=log), Destination(table=t))
    assert stats["loaded_rows"] == spark.table(t).count() == 50 and stats["output_bytes"] > 0
    done = spark.table(log).where("status_id = 1").collect()
    assert len(done) == 1 and (done[0]["loaded_rows"], done[0]["dataframes_memory"]) == (50, 1)


def test_export_job_delivers_two_copies_with_manifests(spark, tmp_path):
    dest = Destination(export_name="tiny", export_root=str(tmp_path), gzip_copy=True, single_file=True,
                       size_limit=10**6)
    with pytest.warns(UserWarning, match="has no value"):
        stats = _Tiny2([(1, None)]).run(spark, None, RunContext(as_of=datetime(2024, 3, 7)), dest)
    rows = [r for m in stats["manifests"] for r in m.collect()]
    names = ["tiny_2024-03-07.csv", "tiny_2024-03-07.csv.gz"]
    assert [(r["file_name"], r["row_count"]) for r in rows] == [(n, 1) for n in names]
    assert all(os.path.isfile(tmp_path / "year=2024" / "month=03" / n) for n in names)


class _Tiny2(_Tiny):
    schema = OutputSchema("tiny2", ColumnSpec("id", T.LongType(), primary_key=True), ColumnSpec("v", T.StringType()))


def _part_files(path):
    """[(part, text of its one file)] in order."""
    found = []
    for folder in path.iterdir():
        if folder.name.startswith("part="):
            [file] = [f for f in folder.iterdir() if f.name.startswith("part-")]
            found.append((int(folder.name[5:]), file.read_bytes()))
    return sorted(found)


@pytest.mark.parametrize("limit", [60, 100, 1000, 10**6])
def test_parts_stay_below_the_limit_and_keep_the_order(spark, tmp_path, limit):
    from lakepipe.sinks import export_csv_parts
    rows = [(i, ("é" * (i % 7)) + ('"q,' if i % 5 == 0 else ""), i % 2 == 0, None if i % 3 else datetime(2024, 1, 1, 2, 3))
            for i in range(200)]
    df = spark.createDataFrame(rows, "id int, t string, b boolean, at timestamp_ntz").repartitionByRange(4, "id")
    out = tmp_path / "out"
    manifest = {r["part"]: r for r in export_csv_parts(df, str(out), limit).collect()}
    files = _part_files(out)
    header = b"id,t,b,at\n"
    assert [p for p, _ in files] == sorted(manifest) and (len(files) > 1) == (limit < 10**5)
    body = b""
    for part, text in files:
        assert text.startswith(header) and len(text) == manifest[part]["bytes"] <= limit
        assert text.count(b"\n") - 1 == manifest[part]["row_count"]
        body += text[len(header):]
    one = tmp_path / "one.csv"
    export_csv(df, str(one), single_file=False)
    whole = b"".join(f.read_bytes()[len(header):] for f in sorted(one.iterdir()) if f.name.startswith("part-"))
    assert body == whole
    assert spark.read.option("header", True).option("recursiveFileLookup", True).csv(str(out)).count() == 200


def test_parts_of_empty_and_too_long_rows(spark, tmp_path):
    from lakepipe.sinks import export_csv_parts
    df = spark.createDataFrame([(1, "x" * 50)], "id int, t string")
    done = export_csv_parts(df.limit(0), str(tmp_path / "empty"), 30).collect()
    assert [(r["part"], r["row_count"], r["bytes"]) for r in done] == [(0, 0, 5)]
    with pytest.raises(CheckFailed, match="more bytes"):
        export_csv_parts(df, str(tmp_path / "long"), 40)
    assert not (tmp_path / "long").exists()
    zipped = export_csv_parts(df, str(tmp_path / "zip"), 100, compression="gzip").collect()
    assert zipped[0]["file_name"].endswith(".gz") and zipped[0]["row_count"] == 1


def test_export_needs_a_root(spark):
    log = _name("log_noroot")
    with pytest.raises(ValueError, match="export_root"):
        _Tiny([(1, "a")]).run(spark, None, RunContext(run_log_table=log), Destination(export_name="tiny"))
    assert not spark.catalog.tableExists(log)


class _OwnDelivery(_Tiny):
    def write(self, spark, output, dest, ctx):
        self.delivered = [tuple(r) for r in output.collect()]
        return []


def test_write_hook_replaces_the_delivery(spark):
    log, t = _name("log"), _name("never")
    job = _OwnDelivery([(1, "a"), (2, "b")])
    stats = job.run(spark, None, RunContext(run_log_table=log), Destination(table=t))
    assert sorted(job.delivered) == [(1, "a"), (2, "b")] and stats["loaded_rows"] == 2
    assert not spark.catalog.tableExists(t) and spark.table(log).count() == 2


def test_connection_without_host():
    from lakepipe.sources.jdbc import Connection
    with pytest.raises(ValueError, match="no host"):
        Connection("sales", "mysql", None, 3306, None, None, None).url


def test_key_check_skips_row_groups(spark, tmp_path):
    t = _name("t_pruned")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        rows = spark.range(0, 400_000, 1, 4).select("id", F.concat(F.lit("k"), F.col("id")).alias("code"), F.lit("x" * 20).alias("v"))
        load_table(rows, t, LoadMode.INSERT, key=["id", "code"])
        new = spark.createDataFrame([(150_000, "k150000", "y"), (150_001, "other", "y"), (900_000, "k900000", "y")], "id long, code string, v string")
        found = key_conflicts(new, spark.table(t), ["id", "code"])
        assert [tuple(r) for r in found.collect()] == [(150_000, "k150000")]
        plan = _plan(found)
        assert "In(id" in plan and "GreaterThanOrEqual(id,150000)" in plan
        scanned = [m for m in _scan_rows(found) if m is not None]
        assert max(scanned) < 400_000, scanned
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with pytest.raises(CheckFailed, match="more than once"):
        load_table(new, t, LoadMode.INSERT, key=["id", "code"])
    load_table(new.where("id = 900000"), t, LoadMode.INSERT, key=["id", "code"])
    assert spark.table(t).count() == 400_001


def _scan_rows(df):
    """Rows that came out of each file scan of the executed plan."""
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        metrics = node.metrics()
        if "FileSourceScan" in node.getClass().getSimpleName() and metrics.contains("numOutputRows"):
            found.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_job_checks_come_from_the_staging_write(spark):
    class Bad(_Tiny):
        schema = OutputSchema("bad", ColumnSpec("id", T.LongType(), primary_key=True, max_value=10),
                              ColumnSpec("v", T.StringType(), nullable=False))

    for rows, words in (([(1, "a"), (1, "b")], "more than once"), ([(1, None), (2, "b")], "missing"), ([(99, "a")], "outside")):
        t = _name("never")
        with pytest.raises(CheckFailed, match=words):
            Bad(rows).run(spark, None, RunContext(), Destination(table=t))
        assert not spark.catalog.tableExists(t)
    stats = Bad([(3, "a"), (4, "b")]).run(spark, None, RunContext(), Destination(table=_name("fine")))
    assert stats["loaded_rows"] == 2


def test_mirror_rewrites_changed_ranges_only(spark):
    from lakepipe.sinks import mirror_changes
    from lakepipe.sinks.mirror import RANGE
    t = _name("mirror_c")
    rows = [(i, f"v{i}" if i % 4 else None, i % 3) for i in range(300)] + [(5, "v5", 2)]
    make = lambda rs: spark.createDataFrame(rs, "id long, v string, `n.x` int")
    read = lambda: sorted((tuple(r) for r in spark.table(t).drop(RANGE).collect()), key=str)
    first = mirror_changes(spark, make(rows), t, ["id"], ranges=16)
    assert first.where("changed").count() == 16 and read() == sorted(rows, key=str)
    assert mirror_changes(spark, make(rows), t, ["id"], ranges=16).where("changed").count() == 0

    def files():
        return {r[0] for r in spark.table(t).select("_metadata.file_path").distinct().collect()}

    before = files()
    # another value, a null for a value, one of two equal rows gone, a new key
    for changed in ([(7, "other", 1) if r[0] == 7 else r for r in rows], [(7, None, 1) if r[0] == 7 else r for r in rows],
                    rows[:-1], rows + [(1000, "new", 1)]):
        done = mirror_changes(spark, make(changed), t, ["id"], ranges=16).where("changed").collect()
        assert 1 <= len(done) <= 2 and read() == sorted(changed, key=str)
    assert len(before & files()) >= 12
    gone = mirror_changes(spark, make(rows[:3]), t, ["id"], ranges=16)
    assert read() == sorted(rows[:3], key=str) and gone.agg(F.sum("source_rows")).first()[0] == 3
    swapped = spark.createDataFrame([(1, None, "a"), (2, "a", None)], "id long, v string, w string")
    back = spark.createDataFrame([(1, "a", None), (2, None, "a")], "id long, v string, w string")
    t2 = _name("mirror_n")
    mirror_changes(spark, swapped, t2, ["id"], ranges=2)
    mirror_changes(spark, back, t2, ["id"], ranges=2)
    assert sorted(tuple(r) for r in spark.table(t2).drop(RANGE).where("v IS NOT NULL").collect()) == [(1, "a", None)]
