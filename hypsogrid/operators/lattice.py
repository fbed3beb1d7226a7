"""The geographic lattice: half-open windows (col_min, row_min, width, height) of pixels counted from (-180, 90)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import LATTICE_NORTH, LATTICE_WEST

#: Metres of a degree, tolerances of a lattice's scale (relative) and phase (pixels).
METRES_PER_DEGREE, SCALE_TOLERANCE, PHASE_TOLERANCE = 111_320.0, 1e-9, 1e-4
NAMES = ("col_min", "row_min", "width", "height")


def _window(*parts: Column) -> Column:
    return F.struct(*(p.cast("long").alias(n) for p, n in zip(parts, NAMES)))


def resolution_of_metres(metres: Column) -> Column:
    """Degrees a pixel; NULL unless positive."""
    return F.when(metres > 0, metres / METRES_PER_DEGREE)


def tile_of(lon: Column, lat: Column, span: Column | float) -> Column:
    return F.struct(F.floor((lon - LATTICE_WEST) / span).alias("ix"), F.floor((LATTICE_NORTH - lat) / span).alias("iy"))


def tile_window(ix: Column, iy: Column, px: int) -> Column:
    return _window(ix * px, iy * px, F.lit(px), F.lit(px))


def window_bounds(w: Column, resolution: float) -> Column:
    west, north = LATTICE_WEST + w["col_min"] * resolution, LATTICE_NORTH - w["row_min"] * resolution
    return F.struct(west.alias("west"), (north - w["height"] * resolution).alias("south"), (west + w["width"] * resolution).alias("east"), north.alias("north"))


def window_transform(w: Column, resolution: float) -> Column:
    """The affine terms a, c, e, f of the window's raster."""
    return F.struct(F.lit(resolution).alias("a"), (LATTICE_WEST + w["col_min"] * resolution).alias("c"), F.lit(-resolution).alias("e"), (LATTICE_NORTH - w["row_min"] * resolution).alias("f"))


def window_of_transform(a: Column, b: Column, c: Column, d: Column, e: Column, f: Column, width: Column, height: Column, resolution: float) -> Column:
    """The window of a raster that lies on the lattice, else NULL. Halves round to even."""
    near = lambda x, want: F.abs(x - want) <= SCALE_TOLERANCE * F.greatest(F.abs(x), F.lit(abs(want)))
    col, row = (c - LATTICE_WEST) / resolution, (LATTICE_NORTH - f) / resolution
    in_phase = (F.abs(col - F.bround(col)) <= PHASE_TOLERANCE) & (F.abs(row - F.bround(row)) <= PHASE_TOLERANCE)
    return F.when(near(a, resolution) & near(e, -resolution) & (b == 0) & (d == 0) & in_phase, _window(F.bround(col), F.bround(row), width, height))


def _ends(w: Column) -> tuple[Column, Column]:
    return w["col_min"] + w["width"], w["row_min"] + w["height"]


def contains(a: Column, b: Column) -> Column:
    (ae, as_), (be, bs) = _ends(a), _ends(b)
    return (a["col_min"] <= b["col_min"]) & (a["row_min"] <= b["row_min"]) & (ae >= be) & (as_ >= bs)


def intersection(a: Column, b: Column) -> Column:
    """NULL where no pixel is shared."""
    (ae, as_), (be, bs) = _ends(a), _ends(b)
    left, top = F.greatest(a["col_min"], b["col_min"]), F.greatest(a["row_min"], b["row_min"])
    width, height = F.least(ae, be) - left, F.least(as_, bs) - top
    return F.when((width > 0) & (height > 0), _window(left, top, width, height))


def union(a: Column, b: Column) -> Column:
    (ae, as_), (be, bs) = _ends(a), _ends(b)
    left, top = F.least(a["col_min"], b["col_min"]), F.least(a["row_min"], b["row_min"])
    return _window(left, top, F.greatest(ae, be) - left, F.greatest(as_, bs) - top)


def offset_in(a: Column, outer: Column) -> Column:
    return F.struct((a["col_min"] - outer["col_min"]).alias("col"), (a["row_min"] - outer["row_min"]).alias("row"))


def sub_window(w: Column, col: Column, row: Column, width: Column, height: Column) -> Column:
    return _window(w["col_min"] + col, w["row_min"] + row, width, height)


def tiles_of_windows(df: DataFrame, px: int) -> DataFrame:
    """df (with the columns of a window) with ix and iy: a row for each tile that the window overlaps, in reading order."""
    last = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / px)
    rows = df.withColumn("iy", F.explode(F.sequence(F.floor(F.col("row_min") / px), last("row_min", "height"))))
    return rows.withColumn("ix", F.explode(F.sequence(F.floor(F.col("col_min") / px), last("col_min", "width"))))


def tile_needs(df: DataFrame, px: int) -> DataFrame:
    """For each tile the box around the parts of all windows in it: ix, iy and a window."""
    cut = tiles_of_windows(df, px)
    low = lambda a, t: F.greatest(F.col(a), F.col(t) * px)
    high = lambda a, n, t: F.least(F.col(a) + F.col(n), F.col(t) * px + px)
    g = cut.groupBy("ix", "iy").agg(
        F.min(low("col_min", "ix")).alias("c0"), F.min(low("row_min", "iy")).alias("r0"), F.max(high("col_min", "width", "ix")).alias("c1"), F.max(high("row_min", "height", "iy")).alias("r1"))
    return g.select("ix", "iy", F.col("c0").alias("col_min"), F.col("r0").alias("row_min"), (F.col("c1") - F.col("c0")).alias("width"), (F.col("r1") - F.col("r0")).alias("height"))
