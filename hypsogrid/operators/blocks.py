"""Rasters as tables of blocks: (bx, by, values), values being size * size pixels in reading order, NULL where there
is no height. A block without heights has no row. Scans, samples and statistics work on blocks; pixels are made rows
only where a query asks for pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .sampling import CORNERS, lerp2, split_fraction


def to_blocks(pixels: DataFrame, size: int) -> DataFrame:
    """pixels (col, row, v) -> blocks. A block gathers its pixels, size * size of them as its bound; where a source gives
    a pixel more than once, its smallest value stays."""
    within = F.pmod(F.col("row"), F.lit(size)) * size + F.pmod(F.col("col"), F.lit(size))
    keyed = pixels.where("v is not null").select(
        F.floor(F.col("col") / size).alias("bx"), F.floor(F.col("row") / size).alias("by"), F.struct(within.cast("int").alias("i"), "v").alias("p"))
    once = lambda p: F.filter(p, lambda x, k: (k == 0) | (F.get(p, k - 1)["i"] != x["i"]))
    listed = keyed.groupBy("bx", "by").agg(F.sort_array(F.collect_list("p")).alias("p"))
    maps = listed.select("bx", "by", F.map_from_entries(once(F.col("p"))).alias("m"))
    values = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.try_element_at("m", i))
    return maps.select("bx", "by", values.alias("values"))


def pixels_of(blocks: DataFrame, size: int) -> DataFrame:
    """A full scan, block by block: (col, row, v) of all pixels that have a height."""
    each = blocks.select("bx", "by", F.posexplode("values").alias("i", "v")).where("v is not null")
    return each.select((F.col("bx") * size + F.col("i") % size).alias("col"), (F.col("by") * size + F.expr(f"i div {size}")).alias("row"), "v")


def block_stats(blocks: DataFrame, by: list[Column | str], size: int) -> DataFrame:
    """Counts and range of the heights of each group of blocks, without a row for each pixel."""
    some = F.filter("values", lambda v: v.isNotNull() & ~F.isnan(v))
    s = blocks.select(*by, F.size(some).alias("n"), F.array_min(some).alias("lo"), F.array_max(some).alias("hi"),
                      F.size(F.filter("values", lambda v: v.isNotNull() & F.isnan(v))).alias("bad"))
    names = s.columns[: len(by)]
    return s.groupBy(*names).agg(F.sum("n").alias("n_valid"), F.min("lo").alias("min_v"), F.max("hi").alias("max_v"), F.sum("bad").alias("n_not_finite"),
                                 (F.count(F.lit(1)) * size * size).alias("n_in_blocks"))


def window_scan(blocks: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(window_id, col, row, v) for the heights in half-open windows (window_id, col_min, row_min, width, height).
    Only blocks that a window overlaps are joined, and only those pixels become rows that lie in it."""
    last = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / size)
    cut = windows.withColumn("bx", F.explode(F.sequence(F.floor(F.col("col_min") / size), last("col_min", "width"))))
    cut = cut.withColumn("by", F.explode(F.sequence(F.floor(F.col("row_min") / size), last("row_min", "height"))))
    ends = lambda b, a, n: (F.greatest(F.col(b) * size, F.col(a)), F.least(F.col(b) * size + size, F.col(a) + F.col(n)) - 1)
    cols, rows = ends("bx", "col_min", "width"), ends("by", "row_min", "height")
    met = cut.join(blocks, ["bx", "by"]).withColumn("row", F.explode(F.sequence(*rows))).withColumn("col", F.explode(F.sequence(*cols)))
    v = F.get("values", ((F.col("row") - F.col("by") * size) * size + F.col("col") - F.col("bx") * size).cast("int"))
    return met.select("window_id", "col", "row", v.alias("v")).where("v is not null")


def fill_windows(scanned: DataFrame, windows: DataFrame) -> DataFrame:
    """Every pixel of each window, counted from its corner, NULL where the scan has none."""
    whole = windows.withColumn("row", F.explode(F.sequence(F.col("row_min"), F.col("row_min") + F.col("height") - 1)))
    whole = whole.withColumn("col", F.explode(F.sequence(F.col("col_min"), F.col("col_min") + F.col("width") - 1)))
    joined = whole.join(scanned, ["window_id", "col", "row"], "left")
    return joined.select("window_id", (F.col("col") - F.col("col_min")).alias("col"), (F.col("row") - F.col("row_min")).alias("row"), "v")


def pixel_at(points: DataFrame, blocks: DataFrame, size: int, u: str = "u", v: str = "v", out: str = "height") -> DataFrame:
    """The pixel whose square holds a point (edge coordinates): one left join by block, NULL if there is none."""
    keyed = points.withColumns({"_c": F.floor(u), "_r": F.floor(v)})
    keyed = keyed.withColumns({"bx": F.floor(F.col("_c") / size), "by": F.floor(F.col("_r") / size)})
    at = (F.pmod("_r", F.lit(size)) * size + F.pmod("_c", F.lit(size))).cast("int")
    return keyed.join(blocks, ["bx", "by"], "left").withColumn(out, F.get("values", at).cast("double")).drop("_c", "_r", "bx", "by", "values")


def corners(points: DataFrame, key: list[str], u: str = "u", v: str = "v") -> DataFrame:
    """The four pixels around each point: key, corner (as in CORNERS), col, row."""
    split = split_fraction(points, u, v)
    four = [F.struct(F.lit(n).alias("corner"), (F.col("c0") + dc).alias("col"), (F.col("r0") + dr).alias("row")) for n, (dc, dr) in CORNERS.items()]
    return split.select(*key, F.explode(F.array(*four)).alias("k")).select(*key, "k.*")


def bilinear(points: DataFrame, key: list[str], blocks: DataFrame, size: int, u: str = "u", v: str = "v", out: str = "height") -> DataFrame:
    """key and the height of each point, whose key is its own. A point goes to the one to four blocks that hold its
    corners: one join by block, then one regrouping; any corner without height gives NULL."""
    split = split_fraction(points, u, v).select(*key, "c0", "r0", "fx", "fy")
    block = lambda dc, dr: F.struct(F.floor((F.col("c0") + dc) / size).alias("bx"), F.floor((F.col("r0") + dr) / size).alias("by"))
    sent = split.withColumn("b", F.explode(F.array_distinct(F.array(*(block(*c) for c in CORNERS.values())))))
    met = sent.select(*key, "c0", "r0", "fx", "fy", "b.bx", "b.by").join(blocks, ["bx", "by"], "left")

    def own(dc: int, dr: int) -> Column:
        x, y = F.col("c0") + dc - F.col("bx") * size, F.col("r0") + dr - F.col("by") * size
        here = (x >= 0) & (x < size) & (y >= 0) & (y < size)
        return F.when(here, F.get("values", (y * size + x).cast("int"))).cast("double")

    read = met.select(*key, "fx", "fy", *(own(*c).alias(n) for n, c in CORNERS.items()))
    one = read.groupBy(*key).agg(F.first("fx").alias("fx"), F.first("fy").alias("fy"), *(F.max(n).alias(n) for n in CORNERS))
    return one.select(*key, lerp2(*(F.col(c) for c in CORNERS), F.col("fx"), F.col("fy")).alias(out))


def spot_picks(blocks: DataFrame, size: int, most: int = 16) -> DataFrame:
    """Evenly spaced heights of each tile (ix, iy, bx, by, values) in reading order, `most` at most. Heights are counted
    for each line of each block first; places fall to lines by running sums over those counts, not over pixels."""
    lines = blocks.select("ix", "iy", "bx", "by", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda r: F.slice("values", r * size + 1, F.lit(size)))).alias("r", "line"))
    lines = lines.select("ix", "iy", (F.col("by") * size + F.col("r")).alias("row"), "bx", "line", F.size(F.filter("line", lambda v: v.isNotNull())).cast("long").alias("n")).where("n > 0")
    tile = Window.partitionBy("ix", "iy")
    counted = lines.withColumns({"before": F.sum("n").over(tile.orderBy("row", "bx").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"), "total": F.sum("n").over(tile)})
    m = F.least(F.lit(most).cast("long"), F.col("total"))
    step = lambda k: F.when(m == 1, F.lit(0).cast("long")).otherwise(F.floor(k * (F.col("total") - 1) / (m - 1)))
    places = F.array_distinct(F.transform(F.sequence(F.lit(0).cast("long"), m - 1), step))
    mine = F.filter(places, lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("n")))
    heights = F.filter(F.transform("line", lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda s: s["v"].isNotNull())
    picked = counted.select("ix", "iy", "row", "bx", "before", heights.alias("h"), F.explode(mine).alias("place"))
    hit = F.element_at("h", (F.col("place") - F.col("before") + 1).cast("int"))
    return picked.select((F.col("bx") * size + hit["i"]).alias("col"), "row", hit["v"].alias("v"), "ix", "iy")


def overlaps(blocks: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """window_id, bx, by of the blocks that have a row and overlap a window."""
    last = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / size)
    cut = windows.withColumn("bx", F.explode(F.sequence(F.floor(F.col("col_min") / size), last("col_min", "width"))))
    cut = cut.withColumn("by", F.explode(F.sequence(F.floor(F.col("row_min") / size), last("row_min", "height"))))
    return cut.join(blocks.select("bx", "by"), ["bx", "by"], "left_semi").select("window_id", "bx", "by")
