"""Exact global numbering without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textspark.session import materialise

_ROW_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: the row within its partition


def global_rank(df: DataFrame, order: list[str | Column], name: str, start: int = 0) -> DataFrame:
    """Number rows from ``start`` in the given order; the order must be total.

    Rows are range-partitioned and sorted, numbered inside each partition, and shifted
    by the sizes of the partitions before. The numbered rows are written first, because
    range bounds come from a sample and must not be drawn twice.
    """
    # Without a fixed number, small inputs end up in few partitions; neighbours merge in order.
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    # At most one row per shuffle partition, whatever the data: safe to window and to broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(name, F.col("_row") + F.col("_shift") + start)
        .drop("_part", "_row", "_shift")
    )
