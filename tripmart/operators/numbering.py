"""Consecutive row numbers without one sorted task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a partition stand in the low bits of ``monotonically_increasing_id``.
_IN_PARTITION = 33


def with_row_number(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Numbers 0, 1, 2, ... in the order the partitions are read.

    Each partition's rows are counted (one row per partition), the counts are
    summed up to offsets, and a row's number is its place plus its partition's
    offset.  ``df`` is read twice and must give the same rows in the same
    partitions both times: number a stored table.
    """
    placed = df.withColumn("__at", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("__at", _IN_PARTITION)
    counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1))
    numbered = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")  # a row per partition
    return numbered.select(*df.columns, (F.col("__before") + inside).alias(name))
