"""Places of rows in an order, without a task that sees more than a range of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import storage

_OWN_BITS = 33  # of monotonically_increasing_id: the row in its partition


def numbered(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """df with `position`, from 0 in the order of the keys: sorted by ranges and written once, then moved up by the sizes
    of the ranges before, of which there are as many as shuffle partitions."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = storage.scratch(spark, "ordered")
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    dealt.write.parquet(at)
    placed = spark.read.schema(dealt.schema).parquet(at).withColumn("_range", F.shiftright("_at", _OWN_BITS))
    sizes = placed.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each partition
    shift = sizes.select("_range", (before - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(shift), "_range").withColumn("position", F.col("_at") + F.col("_shift")).drop("_at", "_range", "_shift")
