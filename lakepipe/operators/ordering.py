"""Distributed global row numbering (W1) and final sort (O1).

``ROW_NUMBER() OVER (ORDER BY …)`` without a partition moves every row into
one task. Here the frame is range-partitioned on the order keys and sorted
within partitions; each row's position inside its partition comes from
``monotonically_increasing_id`` (partition index in the high bits, row index
in the low bits), and a partition's offset is the row count of all earlier
partitions. Only the per-partition counts (one row per partition) are
combined in a single task, and they are broadcast back — a bound set by the
partition count, not by the data.

The range-partitioned, sorted, id-stamped rows are materialised once with a
reliable ``checkpoint()`` (written under ``spark.checkpoint.dir``). Both the
per-partition counts and the numbered rows read that copy, so they agree by
construction: recomputing a range exchange twice could sample different
bounds, and a lost executor cannot change ids that are already written.
The order must still be total (add a unique tie-break column) for the
numbering to be reproducible between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = 33


def global_row_number(df: DataFrame, order_cols: list, name: str = "row_number",
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), _LOW_BITS)
    numbered = ranged.withColumn("_part", part) \
                     .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_part"), _LOW_BITS) + 1)
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_mid", "_part", "_local", "_offset"))
