"""Polygons as rows of vertices (polygon, seq, x, y): edges, boxes, text, and tests against boxes and points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def edges(vertices: DataFrame, polygon: str = "world") -> DataFrame:
    """Each vertex with the next one (x1, y1); the last is followed by the first."""
    w = Window.partitionBy(polygon).orderBy("seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return vertices.select(
        polygon, "seq", F.col("x").alias("x0"), F.col("y").alias("y0"),
        F.coalesce(F.lead("x").over(w), F.first("x").over(whole)).alias("x1"), F.coalesce(F.lead("y").over(w), F.first("y").over(whole)).alias("y1"),
    )


def bounds(vertices: DataFrame, polygon: str = "world") -> DataFrame:
    return vertices.groupBy(polygon).agg(F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))


def centroid(vertices: DataFrame, polygon: str = "world") -> DataFrame:
    """The mean of the vertices, which is not the centroid of the area."""
    return vertices.groupBy(polygon).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


def wkt(vertices: DataFrame, polygon: str = "world") -> DataFrame:
    """POLYGON text, closed by its first vertex; a polygon is a small group by nature."""
    v = vertices.groupBy(polygon).agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))).alias("v"))
    point = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    ring = F.concat(F.transform("v", point), F.array(point(F.col("v")[0])))
    return v.select(polygon, F.concat(F.lit("POLYGON (("), F.array_join(ring, ", "), F.lit("))")).alias("wkt"))


def segment_meets_box(x0: Column, y0: Column, x1: Column, y1: Column, box: dict[str, Column]) -> Column:
    """Clips the segment's parameter interval [0, 1] by the four sides of a closed box."""
    low, high, inside = [F.lit(0.0)], [F.lit(1.0)], F.lit(True)
    for p, q in ((x0 - x1, x0 - box["west"]), (x1 - x0, box["east"] - x0), (y0 - y1, y0 - box["south"]), (y1 - y0, box["north"] - y0)):
        t = F.try_divide(q, p)
        low.append(F.when(p < 0, t).otherwise(0.0))
        high.append(F.when(p > 0, t).otherwise(1.0))
        inside = inside & ((p != 0) | (q >= 0))  # a parallel segment must lie between the sides
    return inside & (F.greatest(*low) <= F.least(*high))


def crosses_ray(px: Column, py: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether the ray from a point to the east crosses an edge; an odd number of crossings is inside."""
    above = (y0 > py) != (y1 > py)
    return above & (px < (x1 - x0) * F.try_divide(py - y0, y1 - y0) + x0)


def meets_boxes(vertices: DataFrame, boxes: DataFrame, polygon: str = "world", box: str = "box") -> DataFrame:
    """Rows of boxes (polygon, box, west, south, east, north: candidates for that polygon) that it meets: an
    edge meets the box, or the box's centre is inside."""
    pairs = boxes.join(edges(vertices, polygon), polygon)
    sides = {n: F.col(n) for n in ("west", "south", "east", "north")}
    ends = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    centre = ((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2)
    tested = pairs.groupBy(polygon, box).agg(
        F.bool_or(segment_meets_box(*ends, sides)).alias("edge"), (F.count_if(crosses_ray(*centre, *ends)) % 2 == 1).alias("inside")
    )
    return tested.where("edge or inside").select(polygon, box)


def points_inside(vertices: DataFrame, points: DataFrame, polygon: str = "world") -> DataFrame:
    """points (polygon, px, py) with `inside`; one point a polygon."""
    met = points.join(edges(vertices, polygon), polygon)
    crosses = crosses_ray(*(F.col(c) for c in ("px", "py", "x0", "y0", "x1", "y1")))
    return met.groupBy(polygon).agg((F.count_if(crosses) % 2 == 1).alias("inside"))


def tiles_met(vertices: DataFrame, size: float, polygon: str = "world") -> DataFrame:
    """polygon, ix, iy of each tile of `size` that a polygon meets within its own box: an edge meets the closed tile, or
    the tile's centre is inside. Each edge goes to the tiles beside its own line only, and what lies inside follows
    from the crossings of each row of tiles, so no polygon's edges meet all of its candidates in one place."""
    e = edges(vertices, polygon)
    tile = lambda c: F.floor(c / size)
    box = bounds(vertices, polygon).select(polygon, *(tile(F.col(c)).alias("_" + c) for c in ("west", "south", "east", "north")))
    low_y, high_y = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = e.withColumn("iy", F.explode(F.sequence(F.ceil(low_y / size) - 1, tile(high_y))))
    south, north = F.col("iy") * size, F.col("iy") * size + size
    # the part of the edge between the row's sides, a tile more on either side, then the exact test
    at = lambda y: F.col("x0") + (F.col("x1") - F.col("x0")) * F.coalesce(F.try_divide(y - F.col("y0"), F.col("y1") - F.col("y0")), F.lit(0.0))
    inside_row = lambda y: F.greatest(low_y, F.least(high_y, y))
    ends = (at(inside_row(south)), at(inside_row(north)))
    flat = F.col("y0") == F.col("y1")
    left = F.when(flat, F.least("x0", "x1")).otherwise(F.least(*ends))
    right = F.when(flat, F.greatest("x0", "x1")).otherwise(F.greatest(*ends))
    near = rows.withColumn("ix", F.explode(F.sequence(tile(left) - 1, tile(right) + 1)))
    sides = {"west": F.col("ix") * size, "south": south, "east": F.col("ix") * size + size, "north": north}
    border = near.where(segment_meets_box(*(F.col(c) for c in ("x0", "y0", "x1", "y1")), sides)).select(polygon, "ix", "iy")
    middle = (F.col("iy") + 0.5) * size
    crossed = e.withColumn("iy", F.explode(F.sequence(tile(low_y), tile(high_y)))).where((F.col("y0") > middle) != (F.col("y1") > middle))
    crossed = crossed.select(polygon, "iy", at(middle).alias("x"))
    w = Window.partitionBy(polygon, "iy").orderBy("x")
    spans = crossed.select(polygon, "iy", "x", F.lead("x").over(w).alias("to"), F.row_number().over(w).alias("n")).where("n % 2 = 1")
    first, last = F.ceil((F.col("x") - size / 2) / size), F.ceil((F.col("to") - size / 2) / size) - 1
    inner = spans.where(first <= last).select(polygon, F.explode(F.sequence(first, last)).alias("ix"), "iy")
    own = border.unionByName(inner).distinct().join(box, polygon)
    return own.where((F.col("ix") >= F.col("_west")) & (F.col("ix") <= F.col("_east")) & (F.col("iy") >= F.col("_south")) & (F.col("iy") <= F.col("_north"))).select(polygon, "ix", "iy")
