"""Places of rows in a global order, without a task that sees more than a range of them.

Rows are dealt by ranges of the order and sorted inside; a place is the row's number in its range plus the sizes of the
ranges before it. Rows that are equal in the order are split by where they were read, so that any number of equal rows
is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import shared

#: Ranges and groups up to this number are broadcast; beyond it they are joined.
BROADCAST_ROWS = 100_000
_OWN_BITS = 33  # of monotonically_increasing_id: the row in its partition


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """df dealt to ranges of `order` and sorted in each; equal rows may be in several."""
    split = df.withColumn("_read", F.monotonically_increasing_id())
    dealt = split.repartitionByRange(partitions(df), *order, "_read")
    return dealt.sortWithinPartitions(*order, "_read").drop("_read")


def numbered(df: DataFrame, group: str, order: list[str], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with `position` (from 0, in the order of `order`) and `n_group`, inside each value of `group`, which has no
    NULL. Written to the shared folder, so the order is fixed whatever is lost later. An empty table stays empty."""
    placed = shared.keep(sorted_ranges(df, [group, *order]).withColumn("_at", F.monotonically_increasing_id()), "ranks")
    placed = placed.withColumn("_range", F.shiftright("_at", _OWN_BITS))
    sizes = placed.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = shared.keep(sizes.select(group, "_range", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n_group")), "ranges")
    held = F.broadcast(ranges) if ranges.count() <= broadcast_rows else ranges
    return placed.join(held, [group, "_range"]).withColumn("position", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")
