"""Bilinear and nearest sampling of a sparse pixel table by equi-joins on pixel keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Offsets of the four pixels around a point, named as column then row.
CORNERS = {"v00": (0, 0), "v10": (1, 0), "v01": (0, 1), "v11": (1, 1)}


def split_fraction(df: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Adds the integer pixel (c0, r0) and the fractions (fx, fy) of fractional pixel coordinates."""
    return df.withColumns({
        "c0": F.floor(u), "r0": F.floor(v),
        "fx": F.col(u) - F.floor(u), "fy": F.col(v) - F.floor(v),
    })


def lerp2(v00: Column, v10: Column, v01: Column, v11: Column, fx: Column, fy: Column) -> Column:
    """Across, then down; NULL if any corner is NULL. The order of operations is part of the result."""
    top = v00 * (1 - fx) + v10 * fx
    bottom = v01 * (1 - fx) + v11 * fx
    return top * (1 - fy) + bottom * fy


def bilinear(points: DataFrame, pixels: DataFrame, u: str = "u", v: str = "v", out: str = "height") -> DataFrame:
    """Heights at fractional pixel coordinates (0 at a pixel's centre).

    pixels: (col, row, v), at most one row a pixel; an absent or NULL pixel is missing. Each of the four
    corners is a left equi-join, which keeps the form free of state when points is a stream.
    """
    df = split_fraction(points, u, v)
    for name, (dc, dr) in CORNERS.items():
        corner = pixels.select(
            (F.col("col") - dc).alias("c0"), (F.col("row") - dr).alias("r0"), F.col("v").cast("double").alias(name)
        )
        df = df.join(corner, ["c0", "r0"], "left")
    height = lerp2(*(F.col(c) for c in CORNERS), F.col("fx"), F.col("fy"))
    return df.withColumn(out, height).drop(*CORNERS)


def nearest(points: DataFrame, pixels: DataFrame, u: str = "u", v: str = "v", out: str = "height") -> DataFrame:
    """Height of the pixel whose square holds the point, in pixel-edge coordinates."""
    keyed = points.withColumns({"c0": F.floor(u), "r0": F.floor(v)})
    cells = pixels.select(F.col("col").alias("c0"), F.col("row").alias("r0"), F.col("v").cast("double").alias(out))
    return keyed.join(cells, ["c0", "r0"], "left")
