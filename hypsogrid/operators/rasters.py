"""Raster tables (tile or block keys and pixels): masks, statistics, mosaics, seams, spot picks."""

from __future__ import annotations

import platform

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def valid(v: Column, *nodata: float) -> Column:
    """v, or NULL where it is not finite or one of the NoData values."""
    ok = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    for n in nodata:
        ok = ok & (v != F.lit(n))
    return F.when(ok, v)


def tile_stats(pixels: DataFrame, by: list[str], v: str = "v") -> DataFrame:
    return pixels.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("n_valid"), F.min(v).alias("min_v"), F.max(v).alias("max_v"),
        ((F.count(F.lit(1)) - F.count(v)) / F.count(F.lit(1))).alias("nodata_fraction"),
    )


def conversion_stats(pixels: DataFrame, before: str, after: str) -> DataFrame:
    d = F.col(after) - F.col(before)
    return pixels.agg(
        F.count(F.lit(1)).alias("total"), F.count(before).alias("n_valid"), F.count(d).alias("converted"),
        F.min(d).alias("min_delta"), F.max(d).alias("max_delta"), F.max(F.abs(d)).alias("max_abs_delta"),
    )


def mosaic(pixels: DataFrame, windows: DataFrame, block: int) -> DataFrame:
    """Pixels (col, row, v) in each window (window_id, col_min, row_min, width, height), counted from its corner.

    Windows are cut into blocks first: an equi-join on block keys, then the exact range within a block.
    """
    end = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / block)
    cut = windows.withColumn("_bx", F.explode(F.sequence(F.floor(F.col("col_min") / block), end("col_min", "width"))))
    cut = cut.withColumn("_by", F.explode(F.sequence(F.floor(F.col("row_min") / block), end("row_min", "height"))))
    keyed = pixels.withColumns({"_bx": F.floor(F.col("col") / block), "_by": F.floor(F.col("row") / block)})
    inside = (F.col("col") >= F.col("col_min")) & (F.col("col") < F.col("col_min") + F.col("width")) & (
        (F.col("row") >= F.col("row_min")) & (F.col("row") < F.col("row_min") + F.col("height")))
    return keyed.join(cut, ["_bx", "_by"]).where(inside).select(
        "window_id", (F.col("col") - F.col("col_min")).alias("col"), (F.col("row") - F.col("row_min")).alias("row"), "v")


def first_bad(pixels: DataFrame, by: list[str], bad: Column) -> DataFrame:
    """The first pixel in reading order for which `bad` holds, by tile."""
    at = F.struct("row", "col")
    return pixels.where(bad).groupBy(*by).agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("n_bad")).select(*by, "at.row", "at.col", "n_bad")


def neighbours(tiles: DataFrame) -> DataFrame:
    """Tiles (ix, iy, west, south, east, north) with their east and south neighbours and the gap between them."""
    near = tiles.select(F.explode(F.array(
        F.struct((F.col("ix") - 1).alias("ix"), F.col("iy").alias("iy"), F.lit("east").alias("side"), F.col("west").alias("edge")),
        F.struct(F.col("ix").alias("ix"), (F.col("iy") - 1).alias("iy"), F.lit("south").alias("side"), F.col("north").alias("edge")),
    )).alias("n")).select("n.*")
    joined = tiles.join(near, ["ix", "iy"])
    gap = F.when(F.col("side") == "east", F.col("edge") - F.col("east")).otherwise(F.col("south") - F.col("edge"))
    return joined.select("ix", "iy", "side", gap.alias("gap"))


def missing_and_stray(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with `problem`: missing or stray."""
    lone = lambda a, b, name: a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti").withColumn("problem", F.lit(name))
    return lone(declared, present, "missing").unionByName(lone(present, declared, "stray"))


def placed(pixels: DataFrame, left: int, top: int, width: int, height: int) -> DataFrame:
    """Pixels moved to a place in a tile of width by height; those outside are cut off."""
    moved = pixels.select((F.col("col") + left).alias("col"), (F.col("row") + top).alias("row"), "v")
    return moved.where((F.col("col") >= 0) & (F.col("col") < width) & (F.col("row") >= 0) & (F.col("row") < height))


def masked_rgb(pixels: DataFrame) -> DataFrame:
    """(col, row, r, g, b, a) with a mask for alpha: NULL alpha is opaque, and where it is 0 the colours are 0."""
    seen = F.coalesce(F.col("a"), F.lit(255)) > 0
    return pixels.select("col", "row", *(F.when(seen, F.col(c)).otherwise(0).cast("short").alias(c) for c in "rgb"), seen.alias("mask"))


def scaled_up(pixels: DataFrame, k: int) -> DataFrame:
    """Each pixel as k by k pixels."""
    steps = lambda c: F.explode(F.sequence(F.col(c) * k, F.col(c) * k + k - 1))
    return pixels.withColumn("col", steps("col")).withColumn("row", steps("row"))


def bounds_of(a: Column, c: Column, e: Column, f: Column, width: Column, height: Column) -> Column:
    """Bounds of a north-up raster from its affine terms and shape."""
    return F.struct(c.alias("west"), (f + e * height).alias("south"), (c + a * width).alias("east"), f.alias("north"))


def parse_points(lines: DataFrame) -> DataFrame:
    """Reference points from lines (line_no, line) of latitude, longitude and height; blank lines are left out, others
    come with their problem."""
    parts = F.split("line", ",")
    n = [F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in range(3)]
    problem = F.when(F.size(parts) != 3, "not three fields").when(n[0].isNull() | n[1].isNull() | n[2].isNull(), "not a number")
    read = lines.where(F.trim("line") != "").select("line_no", problem.alias("problem"), *(c.alias(k) for c, k in zip(n, ("lat", "lon", "height"))))
    return read.select("line_no", *(F.when(F.col("problem").isNull(), F.col(c)).alias(c) for c in ("lat", "lon", "height")), "problem")


def tags_or_none(tags: Column) -> Column:
    return F.coalesce(tags, F.create_map().cast("map<string,string>"))


def provenance(spark: SparkSession, facts: dict[str, str | Column]) -> Column:
    """Tags of a tile as a map: the facts (texts or columns), and the versions that made it."""
    pairs = {**facts, "spark_version": spark.version, "python_version": platform.python_version()}
    return F.create_map(*(F.lit(x) for k in sorted(pairs) for x in (k, pairs[k])))
