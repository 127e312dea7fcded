"""Incremental JSON folder ingestion with Structured Streaming.

The directory reader (S8) applied to a folder that keeps receiving files:
a file stream picks up only files it has not seen (tracked in the
checkpoint), each micro-batch goes through the same document rules as the
batch reader (``json_rows``: list/object/scalar shapes, flatten, validate,
dedup within the batch), and the rows are written as parquet under
``<target>/batch=<id>``. Re-running a batch after a failure rewrites the same
folder, so the sink is idempotent. The checkpoint defaults to
``<target>/_checkpoint`` (parquet readers skip it), so repeated runs against the
same target continue where the last one stopped; keep the target in shared
storage on a cluster.

Rows of different batches are told apart in two ways: each batch is deduplicated by itself and
``read_ingested`` drops what several batches brought, or, with a ``shape`` and ``within``, the stream
keeps the rows it has seen as keyed state and writes each once (A8 across batches and files). A row's
state is dropped ``within`` after the batch that brought it, so it stays bounded; ``within`` is the
longest time after which an equal row may still come. Time is that of the batch, so no file is ever too late.

``trigger="available_now"`` processes everything present and stops — the
streaming equivalent of a scheduled batch run. A batch takes ``max_files_per_trigger`` files at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import PY_WHITESPACE
from ..sources.json_docs import JsonShape, documents_from_text, json_rows


#: Column of a row's batch time inside a deduplicating stream.
ARRIVED = "_arrived"


def ingest_json_folder(spark: SparkSession, source_dir: str, target_dir: str, *,
                       checkpoint: str | None = None, pattern: str = "*.json",
                       flatten: bool = True, deduplicate: bool = True,
                       explode_lists: str = "document", schema: dict | None = None,
                       trigger: str = "available_now",
                       max_files_per_trigger: int = 1000,
                       shape: JsonShape | None = None,
                       line_delimited: bool = False,
                       within: str | None = None) -> StreamingQuery:
    """Start the stream. With ``shape`` (see ``infer_json_shape``) every batch is
    reshaped to the same columns and types and no batch runs an inference pass;
    without it each batch infers its own. ``line_delimited=True`` reads files
    line by line (NDJSON; large files split across tasks), each line a
    one-member list document; otherwise each file is read whole. ``within`` (an interval such as
    ``"7 days"``; needs a ``shape``, as the state's columns must be known) writes each row once
    over all batches."""
    if within is not None and (shape is None or schema):
        raise ValueError("within needs a shape, and no schema beside it")
    reader = (spark.readStream.format("text").option("wholetext", not line_delimited)
              .option("pathGlobFilter", pattern))
    stream = reader.option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)

    def documents(texts: DataFrame, keep=()) -> DataFrame:
        if line_delimited:
            return texts.where(F.btrim("value", F.lit(PY_WHITESPACE)) != "").select(
                *keep, F.concat(F.lit("["), F.col("value"), F.lit("]")).alias("doc"))
        return documents_from_text(texts, "value", keep=keep)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        docs = documents(batch)
        if not docs.isEmpty():
            rows = json_rows(docs, "doc", flatten=flatten, deduplicate=deduplicate,
                             schema=schema, explode_lists=explode_lists, shape=shape)
            rows.write.mode("overwrite").parquet(f"{target_dir.rstrip('/')}/batch={batch_id}")

    target = target_dir.rstrip("/")
    if within is None:
        writer = stream.writeStream.foreachBatch(write_batch)
    else:
        timed = stream.select(F.current_timestamp().alias(ARRIVED), "value")
        rows = json_rows(documents(timed, [ARRIVED]), "doc", flatten=flatten, deduplicate=False,
                         explode_lists=explode_lists, shape=shape, keep=[ARRIVED])
        columns = [c for c in rows.columns if c != ARRIVED]
        once = rows.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark(columns)
        writer = once.select(*[F.col(f"`{c}`") for c in columns]).writeStream.format("parquet").option("path", target)
    writer = writer.option("checkpointLocation", checkpoint or f"{target}/_checkpoint")
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_ingested(spark: SparkSession, target_dir: str, deduplicate: bool = True) -> DataFrame:
    """All rows written so far (batches may differ in columns: schemas are merged).

    A batch is deduplicated when it is written; a row that several batches brought comes once here,
    unless ``deduplicate`` is off.
    """
    rows = spark.read.option("mergeSchema", True).parquet(target_dir)
    return rows.dropDuplicates([c for c in rows.columns if c != "batch"]) if deduplicate else rows
