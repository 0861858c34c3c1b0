"""Positions of rows in a per-group sorted order, without one task per group.

A window ``partitionBy(group).orderBy(value)`` runs each group in a single
task; a group can be a whole vocabulary or a whole class (a third of the
rows), so that does not scale.  Here rows are range-partitioned on
``(group, value)`` — the partitioner samples the keys, so every task gets a
similar share even when one group is huge — and each row's position is

    rows of its group in earlier partitions  +  earlier rows in its partition.

The first term comes from a table with one row per (partition, group) that
is present, at most ``partitions + groups`` rows; the second from a window
over one partition's slice.  The range-partitioned table is checkpointed so
partition ids stay fixed when it is read twice (and survive executor loss).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROWS_PER_TASK = 1_000_000


def ordered_positions(df: DataFrame, groups: Sequence[str], order: str,
                      weight: str | None = None, partitions: int | None = None,
                      input_materialized: bool = False) -> DataFrame:
    """Add ``_start`` / ``_end`` (0-based first and last position of the row
    in its group's ascending ``order``; a row of weight w spans w positions)
    and ``_n`` (the group's total weight).

    The input (a reduced table: distinct values or value counts) is
    materialized first unless the caller already did, so the range
    partitioner's sampling pass does not recompute it from raw data."""
    g = list(groups)
    w = F.col(weight) if weight else F.lit(1)
    data = df.withColumn("_w", w.cast("bigint"))
    if not input_materialized:
        data = materialize(data, "rank_input")
    # about ROWS_PER_TASK rows per range task (counting a materialized table
    # is cheap): tiny inputs use one task, huge ones as many as they need
    n_parts = partitions or max(1, math.ceil(data.count() / ROWS_PER_TASK))
    ranged = materialize(data.repartitionByRange(n_parts, *g, order)
                         .withColumn("_pid", F.spark_partition_id()))

    local = Window.partitionBy("_pid", *g).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("_before", F.coalesce(F.sum("_w").over(local), F.lit(0)))

    per_part = ranged.groupBy("_pid", *g).agg(F.sum("_w").alias("_cnt"))
    earlier = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_part
               .withColumn("_offset", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
               .withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*g)))
               .select("_pid", *g, "_offset", "_n"))
    # one row per (partition, group): the planner broadcasts it when small;
    # the keys spread evenly by construction
    out = ranged.join(offsets, ["_pid", *g], "inner")
    out = (out.withColumn("_start", F.col("_offset") + F.col("_before"))
           .withColumn("_end", F.col("_start") + F.col("_w") - 1))
    return out.drop("_pid", "_before", "_offset", "_w")
