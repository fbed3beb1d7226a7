"""Terrain inputs derived from the driver's tables, in Spark and, with the same names, as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .registry import table

#: Pixels of a row of the raster made from `part`; parts of this size have no height.
WIDTH, NODATA_SIZE = 50, 7

PIXELS_SQL = f"""select p_partkey % {WIDTH} as col, p_partkey // {WIDTH} as row,
  case when p_size <> {NODATA_SIZE} then cast(p_retailprice as float) end as v from part"""
POINTS_SQL = f"""select event_id, ((event_id * 37) % {8 * WIDTH}) / 8.0e0 as u,
  ((event_id * 101) % (8 * (select max(p_partkey) // {WIDTH} + 1 from part))) / 8.0e0 as v from events"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.pmod(key, F.lit(WIDTH)).alias("col"),
        F.floor(key / WIDTH).alias("row"),
        F.when(F.col("p_size") != NODATA_SIZE, F.col("p_retailprice").cast("float")).alias("v"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").agg((F.floor(F.max("p_partkey") / WIDTH) + 1).alias("n_rows"))
    return table(spark, sf_dir, "events").crossJoin(F.broadcast(rows)).select(  # one row on the other side
        "event_id",
        (F.pmod(F.col("event_id") * 37, F.lit(8 * WIDTH)) / 8).alias("u"),
        (F.pmod(F.col("event_id") * 101, 8 * F.col("n_rows")) / 8).alias("v"),
    )


#: Six vertices a polygon, around a centre that depends on its number.
VERTICES_SQL = """select c_custkey // 6 as world, c_custkey % 6 as seq,
  cast((c_custkey // 6) * 7 % 64 + [0, 4, 6, 4, 0, -2][c_custkey % 6 + 1] as double) + (c_custkey * 29 % 8) / 8.0e0 as x,
  cast((c_custkey // 6) * 13 % 32 + [0, 0, 3, 6, 6, 3][c_custkey % 6 + 1] as double) + (c_custkey * 31 % 4) / 8.0e0 as y from customer"""
BOXES_SQL = """select s_suppkey as box, s_suppkey * 11 % 60 + 0.5e0 as west, s_suppkey * 17 % 30 + 0.25e0 as south,
  s_suppkey * 11 % 60 + 1.5e0 + s_suppkey % 5 as east, s_suppkey * 17 % 30 + 1.25e0 + s_suppkey % 3 as north from supplier"""
PLACES_SQL = "select event_id, 12 + (event_id * 37 % 4096) / 1024.0e0 as lon, 48.5e0 + (event_id * 101 % 2048) / 1024.0e0 as lat from events"


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("c_custkey"), F.floor(F.col("c_custkey") / 6)
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), (key % 6 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(
        n.alias("world"), (key % 6).alias("seq"),
        ((n * 7 % 64 + at([0, 4, 6, 4, 0, -2])).cast("double") + (key * 29 % 8) / 8).alias("x"),
        ((n * 13 % 32 + at([0, 0, 3, 6, 6, 3])).cast("double") + (key * 31 % 4) / 8).alias("y"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    west, south = key * 11 % 60 + 0.5, key * 17 % 30 + 0.25
    return table(spark, sf_dir, "supplier").select(
        key.alias("box"), west.alias("west"), south.alias("south"), (west + 1 + key % 5).alias("east"), (south + 1 + key % 3).alias("north"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(key, (12 + (key * 37 % 4096) / 1024).alias("lon"), (48.5 + (key * 101 % 2048) / 1024).alias("lat"))


#: Buckets in which rows are ranked; their totals fit one task at any size.
RANK_BUCKETS = 1024


def numbered(df: DataFrame, *keys: str) -> DataFrame:
    """df (with distinct integer keys) with `position` in the order of the keys: ranks inside ranges of the first key,
    and running sums over the ranges' totals, so that no task sorts all rows."""
    low, high = df.agg(F.min(keys[0]), F.max(keys[0])).first()
    step = max(1, (((high or 0) - (low or 0)) // RANK_BUCKETS) + 1)
    cut = df.withColumn("_range", F.floor((F.col(keys[0]) - (low or 0)) / step))
    totals = cut.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    return cut.join(F.broadcast(totals.select("_range", before.alias("_before"))), "_range").withColumn("position", F.col("_before") + own).drop("_range", "_before")
