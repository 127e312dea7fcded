"""Join helper for dimension tables.

No broadcast is forced: Spark broadcasts a side whose size in bytes (from file statistics, or measured
by AQE after its shuffle) is below ``spark.sql.autoBroadcastJoinThreshold``; any larger side is
joined by a shuffle on the key, where AQE can split a hot key. Building a join runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key, dim_key: str,
                   how: str = "left", prefix: str | None = None) -> DataFrame:
    """Join a dimension on ``fact_key = dim_key``.

    The dimension's columns are prefixed (``prefix + name``) so several
    dimensions with ``id``/``name`` columns can be joined to one fact.
    """
    prefix = prefix if prefix is not None else ""
    d = dim.select(*[F.col(f"`{c}`").alias(prefix + c) for c in dim.columns])
    fk = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    return fact.join(d, fk == F.col(f"`{prefix + dim_key}`"), how)
