"""Batch job base class: extract → transform → output tail → checks → write → run log.

A job declares an ``OutputSchema`` and a destination and implements
``extract`` (lazy DataFrames) and optionally ``transform``. ``build`` returns
the conformed output frame without running anything; ``run`` executes it:

1. append a STARTED record to the run log;
2. compute the prepared output once and stage it as parquet under the shared
   checkpoint folder, observing per-input row counts on the way (no extra
   pass; S4, Q8 warns on empty inputs, Q7 on output columns without a value). The staged copy cuts the lineage: a
   lost executor after this point costs a re-read, not a recomputation;
3. check not-null and ranges from aggregates observed in that same write, and the key by a grouped count on the
   staged copy (Q1, Q2, Q13), *before* anything is written to the destination, then cast and write from it;
4. remove the staging folder; append COMPLETED (or FAILED with the error,
   then re-raise).
"""

from __future__ import annotations

import time
import uuid
import warnings
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import enforce_keys, enforce_metrics, output_metrics
from ..operators.tail import cast_to_schema, output_tail, prepare_output
from ..schema import OutputSchema
from ..sinks.export import dated_key, debug_path, export_csv, export_manifest, written_bytes
from ..sinks.loaders import LoadMode, load_table
from ..session import remove_path, shared_dir
from .runlog import RunStatus, append_run_record


@dataclass
class NoParameters:
    pass


@dataclass
class Destination:
    """Where ``run`` writes: a catalog table, a database table and/or a CSV export with its manifest."""
    table: str | None = None
    load_mode: LoadMode = LoadMode.INSERT
    csv_path: str | None = None
    single_file: bool = False
    compression: str | None = None
    jdbc: tuple | None = None  # (Connection, table name): a database table, same load modes
    partition_by: list[str] | None = None  # of a newly created table
    export_name: str | None = None  # CSV at the dated key of this name under ``export_root``
    export_root: str | None = None  # default: that of the run context
    gzip_copy: bool = False  # a second, compressed delivery beside the CSV
    size_limit: int | None = None  # bytes of a delivery

    @property
    def writes(self) -> bool:
        return bool(self.table or self.jdbc or self.csv_path or self.export_name)


@dataclass
class RunContext:
    as_of: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    manual_trigger: bool = True
    run_log_table: str | None = None
    debug: bool = False
    debug_root: str | None = None  # folder of the debug file; default: one of its own in the shared folder
    export_root: str | None = None  # folder of the exports that name none


def _observed(spark: SparkSession, obs: Observation) -> dict[str, int] | None:
    """What was observed, or None if no executed plan held the observation.

    Observations are set by the listener bus, so they are complete once it has handled the events of the write.
    """
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    row = obs._jo.getRowOrEmpty()
    return obs.get if row.isDefined() and row.get().length() else None


def _rows_read(spark: SparkSession, observed: dict[str, tuple[Observation, DataFrame]]) -> dict[str, int]:
    """Rows of each input as observed while the output was staged; an input that no plan read is counted."""
    out = {}
    for key, (obs, df) in observed.items():
        seen = _observed(spark, obs)
        out[key] = int(seen["rows"]) if seen else df.count()
    return out


class BatchJob:
    parameter_class: type = NoParameters
    schema: OutputSchema
    destination: Destination = Destination()

    @property
    def job_name(self) -> str:
        return f"{type(self).__module__}.{type(self).__name__}"

    def parameters(self, values: dict[str, Any] | None = None):
        return self.parameter_class(**(values or {}))

    # -- hooks ---------------------------------------------------------------
    def extract(self, spark: SparkSession, params, ctx: RunContext) -> dict[str, DataFrame]:
        raise NotImplementedError

    def transform(self, inputs: dict[str, DataFrame], params, ctx: RunContext) -> DataFrame:
        return inputs["data"]

    # -- composition ---------------------------------------------------------
    def build(self, spark: SparkSession, params=None, ctx: RunContext | None = None) -> DataFrame:
        """The conformed output (lazy): transform + tail + cast to schema types."""
        ctx = ctx or RunContext()
        params = params if params is not None else self.parameters()
        out = self.transform(self.extract(spark, params, ctx), params, ctx)
        return output_tail(out, self.schema)

    def run(self, spark: SparkSession, params=None, ctx: RunContext | None = None,
            destination: Destination | None = None) -> dict[str, Any]:
        ctx = ctx or RunContext()
        params = params if params is not None else self.parameters()
        dest = destination or self.destination
        if not (ctx.debug or dest.writes):
            raise ValueError(f"{self.job_name}: the destination names no table, "
                             "database table, CSV path or export")
        if dest.export_name and not (ctx.debug or dest.csv_path or dest.export_root or ctx.export_root):
            raise ValueError(f"{self.job_name}: no export_root for {dest.export_name}, neither in the destination nor in the run context")
        started = time.time()
        stats = {"extracted_rows": 0, "loaded_rows": 0}
        self._log(spark, ctx, RunStatus.STARTED, started, stats, None)
        try:
            inputs = self.extract(spark, params, ctx)
            observed = {}
            for key, df in inputs.items():
                obs = Observation(f"in_{key}_{uuid.uuid4().hex[:8]}")
                observed[key] = (obs, df)
                inputs[key] = df.observe(obs, F.count(F.lit(1)).alias("rows"))
            prepared = prepare_output(self.transform(inputs, params, ctx), self.schema)
            stage = shared_dir(spark, "staging", self.job_name.replace(".", "_"), ctx.run_id,
                               unique=False)
            checks, checked = output_metrics(self.schema), Observation(f"out_{uuid.uuid4().hex[:8]}")
            prepared.observe(checked, *[c.alias(k) for k, c in checks.items()]).write.mode("overwrite").parquet(stage)
            try:
                staged = spark.read.parquet(stage)
                size, _ = written_bytes(spark, stage)
                metrics = _observed(spark, checked)
                if metrics is None:  # an output without rows may be written without running its plan
                    metrics = staged.agg(*[c.alias(k) for k, c in checks.items()]).first().asDict()
                enforce_keys(staged, self.schema)
                enforce_metrics(metrics, self.schema)
                for i, name in enumerate(self.schema.names):
                    if not metrics[f"v{i}"]:
                        warnings.warn(f"{self.job_name}: output column {name} has no value")
                output = cast_to_schema(staged, self.schema)
                manifests = self.write(spark, output, dest, ctx)
                loaded = int(metrics["rows"])  # what was staged is what was written
            finally:
                remove_path(spark, stage)
            counts = _rows_read(spark, observed)
            for k, n in counts.items():
                if n == 0:
                    warnings.warn(f"{self.job_name}: input {k} has no rows")
            stats = {"extracted_rows": sum(counts.values()), "loaded_rows": loaded,
                     "inputs": counts, "output_bytes": size, "manifests": manifests}
        except Exception as e:
            self._log(spark, ctx, RunStatus.FAILED, started, stats, str(e))
            raise
        self._log(spark, ctx, RunStatus.COMPLETED, started, stats, None)
        return stats

    def write(self, spark: SparkSession, output: DataFrame, dest: Destination,
              ctx: RunContext) -> list[DataFrame]:
        """Hook (U2): write the checked output everywhere the destination says; manifests of the exports.

        A job with a delivery of its own overrides it; checks, run log and staging stay those of ``run``.
        """
        if ctx.debug:
            export_csv(output, debug_path(ctx.debug_root or shared_dir(spark, "debug"), self.job_name), single_file=True)
            return []
        key = self.schema.primary_key or None
        if dest.table:
            load_table(output, dest.table, dest.load_mode, key=key, partition_by=dest.partition_by)
        if dest.jdbc:
            from ..sources.jdbc import load_jdbc
            conn, table = dest.jdbc
            load_jdbc(output, conn, table, dest.load_mode, key=key)
        path = dest.csv_path
        if not path and dest.export_name:
            path = dated_key(dest.export_root or ctx.export_root, dest.export_name, ctx.as_of)
        if not path:
            return []
        deliveries = [(path, dest.compression)] + ([(f"{path}.gz", "gzip")] if dest.gzip_copy else [])
        manifests = []
        for target, compression in deliveries:
            done = export_csv(output, target, single_file=dest.single_file, compression=compression,
                              size_limit=dest.size_limit)
            manifests.append(export_manifest(spark, done, export_name=dest.export_name or self.schema.name,
                                             category=None, min_date=None, max_date=None, as_of=ctx.as_of))
        return manifests

    def _log(self, spark, ctx, status, started, stats, error):
        if not ctx.run_log_table:
            return
        append_run_record(spark, ctx.run_log_table, job_name=self.job_name, run_id=ctx.run_id,
                          manual_trigger=ctx.manual_trigger, status=status,
                          duration=round(time.time() - started),
                          extracted_rows=stats.get("extracted_rows", 0),
                          loaded_rows=stats.get("loaded_rows", 0), error=error,
                          output_bytes=stats.get("output_bytes", 0))

    def describe(self) -> dict[str, Any]:
        return {"job": self.job_name, "schema": self.schema.names,
                "destination": asdict(self.destination) if self.destination else None}
