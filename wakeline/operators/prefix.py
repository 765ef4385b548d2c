"""Distributed running sums over a sorted key, without a per-group window.

``sum(x) OVER (PARTITION BY g ORDER BY v)`` puts a whole group in one task.
Here the rows are range-partitioned on ``(g, v)`` - Spark samples the key
distribution, so partitions are balanced even when one group dominates - and
the running sum is computed in two parts:

* inside each range partition, a window over that partition only;
* across partitions, an offset per ``(partition, g)`` from a small table of
  partition totals (one row per partition and group).

Range partitions are contiguous in ``(g, v)`` order, so offset + local running
sum is the global running sum.  The partitioned rows are stored once
(``materialize``): range bounds come from sampling, and a re-executed plan
could draw other bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .drift import broadcast_if_small


def running_sum(df: DataFrame, groups: Sequence[str], order: str, value: str, out: str = "running",
                exclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows of the same group with a smaller
    ``order`` (``exclusive``) or smaller-or-equal (inclusive).  ``order`` must be
    unique within a group (pre-aggregate duplicates first)."""
    groups = list(groups)
    # without an explicit count AQE may coalesce adjacent ranges (still contiguous,
    # ids still in order); range bounds come from a sample of the input, so the
    # partition ids are fixed once: totals and local sums read the same stored table
    by_range = (df.repartitionByRange(partitions, *groups, order) if partitions
                else df.repartitionByRange(*groups, order))
    ranged = materialize(by_range.withColumn("_pid", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_pid", *groups).agg(F.sum(value).alias("_pt"))
    w_off = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *groups, F.coalesce(F.sum("_pt").over(w_off), F.lit(0)).alias("_off"))
    end = -1 if exclusive else Window.currentRow
    w_loc = Window.partitionBy("_pid", *groups).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    local = ranged.withColumn("_loc", F.coalesce(F.sum(value).over(w_loc), F.lit(0)))
    return (local.join(broadcast_if_small(offsets), ["_pid", *groups])
            .withColumn(out, F.col("_off") + F.col("_loc")).drop("_pid", "_off", "_loc"))
