"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import drop_written, written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
    return r.n, r.h


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (u, v): the component is its least node.

    Each round points every node's larger neighbours at its least neighbour (large star), then every node
    and its smaller neighbours at the least of them (small star), until nothing changes: a number of rounds that
    follows the log of the longest path. A node's least neighbour is an aggregate and comes back by a join that Spark
    can split, so no neighbourhood is ever gathered. Every round is written to the shared folder.
    """
    current = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .filter("u <> v").distinct(), "edges")
    state = _state(current)
    while state[0]:
        both = current.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        large = (both.filter("v > u").join(least, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        least = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(least, F.col("u") == F.col("k")).select(
            F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))))
        before, last = state, current
        current = written(small.filter("u <> v").distinct(), "edges")
        drop_written(last)
        if (state := _state(current)) == before:
            break
    found = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
