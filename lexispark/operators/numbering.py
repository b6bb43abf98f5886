"""Places in a total order without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.sources.work import kept


def numbered(rows: DataFrame, *order: Column | str, name: str = "ord") -> DataFrame:
    """rows with their place (long, from 0) in an order.

    Rows are dealt out by ranges of the order and sorted in each part; a row's place is its place
    in the part and the rows of the parts before. The parts are written once, as their borders
    come from a sample that may fall otherwise when it is drawn again. Equal rows in the
    order get their places in no certain sequence. Columns ``__part`` and ``__at`` may not be taken.
    """
    parts = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part.
    starts = parts.groupBy("__part").agg(F.count("*").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return parts.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def numbered_within(rows: DataFrame, group: list[str], *order: Column | str, name: str = "ord") -> DataFrame:
    """rows with their place in their group (columns without nulls) and ``n``, the rows of the group; a large group is dealt over many parts."""
    placed = numbered(rows, *group, *order, name="__place")
    first = placed.groupBy(*group).agg(F.min("__place").alias("__first"), F.count("*").alias("n"))
    return placed.join(first, group).withColumn(name, F.col("__place") - F.col("__first")).drop("__place", "__first")
