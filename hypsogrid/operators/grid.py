"""Tile grids and geographic lattices as column arithmetic. Columns grow east, rows grow south; indices floor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampling slack and snapping tolerance in pixels, origin of the geographic lattice.
SLACK_PX, SNAP_PX = 1e-3, 1e-6
LATTICE_WEST, LATTICE_NORTH = -180.0, 90.0


@dataclass(frozen=True)
class TileGrid:
    """A grid of square tiles; its scalars are literals, so that they fold into the plan."""

    origin_x: float
    origin_y: float
    tile_px: int
    resolution: float

    @property
    def span(self) -> float:
        return self.tile_px * self.resolution

    def tile_index(self, x: Column, y: Column) -> Column:
        return F.struct(F.floor((x - self.origin_x) / self.span).alias("ix"), F.floor((self.origin_y - y) / self.span).alias("iy"))

    def tile_bounds(self, ix: Column, iy: Column) -> Column:
        west, north = self.origin_x + ix * self.span, self.origin_y - iy * self.span
        return F.struct(west.alias("west"), (north - self.span).alias("south"), (west + self.span).alias("east"), north.alias("north"))

    def pixel_center(self, col: Column, row: Column) -> Column:
        return F.struct((self.origin_x + (col + 0.5) * self.resolution).alias("x"), (self.origin_y - (row + 0.5) * self.resolution).alias("y"))

    def fractional(self, x: Column, y: Column) -> Column:
        """Pixel coordinates that are whole at pixel centres."""
        return F.struct(((x - self.origin_x) / self.resolution - 0.5).alias("u"), ((self.origin_y - y) / self.resolution - 0.5).alias("v"))

    def local(self, col: Column, row: Column) -> Column:
        """Tile and pixel within it; floor division, so negative pixels belong to tiles west and north of the origin."""
        n = F.lit(self.tile_px)
        return F.struct(
            F.floor(col / n).alias("ix"), F.floor(row / n).alias("iy"), F.pmod(col, n).alias("col"), F.pmod(row, n).alias("row")
        )

    def sampling_region(self, ix: Column, iy: Column) -> Column:
        """The tile grown by half a pixel and the slack: points outside never read its pixels."""
        grow, b = (0.5 + SLACK_PX) * self.resolution, self.tile_bounds(ix, iy)
        return F.struct((b["west"] - grow).alias("west"), (b["south"] - grow).alias("south"), (b["east"] + grow).alias("east"), (b["north"] + grow).alias("north"))

    def sampling_pixels(self, points: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
        """The inclusive range of pixels that bilinear sampling at a group's points may read."""
        f = self.fractional(F.col(x), F.col(y))
        g = points.select(*by, f["u"].alias("u"), f["v"].alias("v")).groupBy(*by)
        return g.agg(
            F.floor(F.min("u") - SLACK_PX).alias("col_min"), F.floor(F.min("v") - SLACK_PX).alias("row_min"),
            (F.floor(F.max("u") + SLACK_PX) + 1).alias("col_max"), (F.floor(F.max("v") + SLACK_PX) + 1).alias("row_max"),
        )


def transform_of(bounds: Column, resolution: float) -> Column:
    """The affine terms (a, c, e, f) of a north-up raster of these bounds."""
    return F.struct(F.lit(resolution).alias("a"), bounds["west"].alias("c"), F.lit(-resolution).alias("e"), bounds["north"].alias("f"))


def affine(a, b, c, d, e, f, col: Column, row: Column) -> Column:
    """x = a col + b row + c, y = d col + e row + f."""
    return F.struct((col * a + row * b + c).alias("x"), (col * d + row * e + f).alias("y"))


def inverse_affine(a, b, c, d, e, f, x: Column, y: Column) -> Column:
    det = a * e - b * d
    return F.struct((((x - c) * e - (y - f) * b) / det).alias("col"), (((y - f) * a - (x - c) * d) / det).alias("row"))


def align_origin(nominal: Column, native: Column, step: Column) -> Column:
    """The first place at or east of nominal that lies in the native grid's phase."""
    return nominal + F.pmod(native - nominal, step)


def phase_distance(a: Column, b: Column, step: Column) -> Column:
    d = F.pmod(a - b, step)
    return F.least(d, step - d)


def snap_window(west: Column, south: Column, east: Column, north: Column, resolution: Column | float) -> Column:
    """The half-open lattice window that covers a box: outward, but for SNAP_PX, and one pixel at least."""
    left = F.floor((west - LATTICE_WEST) / resolution + SNAP_PX)
    top = F.floor((LATTICE_NORTH - north) / resolution + SNAP_PX)
    right = F.ceil((east - LATTICE_WEST) / resolution - SNAP_PX)
    bottom = F.ceil((LATTICE_NORTH - south) / resolution - SNAP_PX)
    one = F.lit(1).cast("long")
    return F.struct(left.alias("col_min"), top.alias("row_min"), F.greatest(one, right - left).alias("width"), F.greatest(one, bottom - top).alias("height"))


def scale_window(w: Column, k: int) -> Column:
    return F.struct(*((w[n] * k).alias(n) for n in ("col_min", "row_min", "width", "height")))


def split_windows(df: DataFrame, most: int) -> DataFrame:
    """Each (width, height) cut into pieces of at most `most` pixels a side, in reading order: piece_x, piece_y, piece_w, piece_h."""
    rows = df.withColumn("piece_y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("height") - 1, F.lit(most).cast("long"))))
    both = rows.withColumn("piece_x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("width") - 1, F.lit(most).cast("long"))))
    return both.withColumns({"piece_w": F.least(F.lit(most), F.col("width") - F.col("piece_x")), "piece_h": F.least(F.lit(most), F.col("height") - F.col("piece_y"))})


def ring(west: Column, south: Column, east: Column, north: Column, edge: int = 64) -> Column:
    """Points around a box, `edge` steps a side, both ends of each side: an array of (side, k, x, y)."""
    def side(number: int, x, y) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(edge)), lambda k: F.struct(
            F.lit(number).alias("side"), k.alias("k"), x(k / edge).alias("x"), y(k / edge).alias("y")))

    along_x, along_y = (lambda t: west + (east - west) * t), (lambda t: south + (north - south) * t)
    return F.concat(
        side(0, along_x, lambda t: south + t * 0), side(1, along_x, lambda t: north + t * 0),
        side(2, lambda t: west + t * 0, along_y), side(3, lambda t: east + t * 0, along_y),
    )


def to_tag(*parts: Column) -> Column:
    return F.array_join(F.array(*(p.cast("string") for p in parts)), ",")


def from_tag(tag: Column) -> Column:
    """Four whole 64-bit numbers, or NULL if the tag is malformed or the range is empty."""
    p = F.split(tag, ",")
    n = [F.trim(F.get(p, F.lit(i))).try_cast("long") for i in range(4)]
    whole = F.size(F.filter(p, lambda x: ~F.trim(x).rlike("^[+-]?[0-9]+$"))) == 0
    good = (F.size(p) == 4) & whole & (n[2] >= n[0]) & (n[3] >= n[1])
    return F.when(good, F.struct(*(c.alias(k) for c, k in zip(n, ("col_min", "row_min", "col_max", "row_max")))))


def tile_path(ix: Column, iy: Column, pattern: str = "tile_{ix}_{iy}.tif") -> Column:
    return F.replace(F.replace(F.lit(pattern), F.lit("{ix}"), ix.cast("string")), F.lit("{iy}"), iy.cast("string"))


def parse_tile_path(name: Column) -> Column:
    number = lambda k: F.regexp_extract(name, r"^tile_(-?\d+)_(-?\d+)\.tif$", k)
    return F.when(number(1) != "", F.struct(number(1).try_cast("long").alias("ix"), number(2).try_cast("long").alias("iy")))
