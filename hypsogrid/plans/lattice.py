"""Queries on the geographic lattice, on boxes and on what a plan needs of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boxes, grid, lattice
from . import grids, inputs
from .registry import query

RES = 0.125
WINDOW = lattice.NAMES
#: Windows of the suppliers on the lattice, and each with the one of forty numbers further on.
WIN = "w as (select s_suppkey as k, s_suppkey * 7 % 60 as c, s_suppkey * 5 % 45 as r, 2 + s_suppkey % 9 as w, 1 + s_suppkey % 6 as h from supplier)"
PAIR = f"{WIN}, p as (select a.k, a.c, a.r, a.w, a.h, b.c as c2, b.r as r2, b.w as w2, b.h as h2 from w a join w b on b.k = a.k + 20)"


def _windows(spark, sf_dir):
    k = F.col("s_suppkey")
    return inputs.table(spark, sf_dir, "supplier").select(
        k.alias("k"), F.struct((k * 7 % 60).alias("col_min"), (k * 5 % 45).alias("row_min"), (2 + k % 9).alias("width"), (1 + k % 6).alias("height")).alias("w"))


def _pairs(spark, sf_dir):
    df = _windows(spark, sf_dir)
    return df.join(df.select((F.col("k") - 20).alias("k"), F.col("w").alias("o")), "k")


@query("prj10_lattice_tiles", f"""with p as ({inputs.PLACES_SQL}), t as (select event_id, cast(floor((lon + 180) / 2) as bigint) as ix, cast(floor((90 - lat) / 2) as bigint) as iy from p)
select event_id, ix, iy, ix * 16 as col_min, iy * 16 as row_min, 16::bigint as width, 16::bigint as height, -180 + ix * 2.0e0 as west, 90 - iy * 2.0e0 as north from t""")
def prj10(spark, sf_dir):
    df = inputs.places(spark, sf_dir).select("event_id", lattice.tile_of(F.col("lon"), F.col("lat"), 16 * RES).alias("t")).select("event_id", "t.*")
    df = df.withColumn("w", lattice.tile_window(F.col("ix"), F.col("iy"), 16)).withColumn("b", lattice.window_bounds(F.col("w"), RES))
    return df.select("event_id", "ix", "iy", "w.*", "b.west", "b.north")


@query("prj11_lattice_resolution", "select p_partkey, case when p_size - 3 > 0 then (p_size - 3) / 4.0e0 / 111320 end as degrees from part")
def prj11(spark, sf_dir):
    return inputs.table(spark, sf_dir, "part").select("p_partkey", lattice.resolution_of_metres((F.col("p_size") - 3) / 4).alias("degrees"))


@query("prj12_window_bounds", f"""with {WIN} select k, -180 + c * 0.125e0 as west, 90 - r * 0.125e0 - h * 0.125e0 as south, -180 + c * 0.125e0 + w * 0.125e0 as east, 90 - r * 0.125e0 as north, 0.125e0 as a, -180 + c * 0.125e0 as c, -0.125e0 as e, 90 - r * 0.125e0 as f from w""")
def prj12(spark, sf_dir):
    df = _windows(spark, sf_dir)
    return df.select("k", lattice.window_bounds(F.col("w"), RES).alias("b"), lattice.window_transform(F.col("w"), RES).alias("t")).select("k", "b.*", "t.*")


@query("prj14_window_of_transform", """select p_partkey as k, case when p_size % 5 <> 0 and p_size % 7 <> 0 and p_partkey % 3 <> 0 then p_partkey % 300 end as col_min, case when p_size % 5 <> 0 and p_size % 7 <> 0 and p_partkey % 3 <> 0 then p_partkey % 200 end as row_min,
 case when p_size % 5 <> 0 and p_size % 7 <> 0 and p_partkey % 3 <> 0 then p_size::bigint end as width, case when p_size % 5 <> 0 and p_size % 7 <> 0 and p_partkey % 3 <> 0 then 4::bigint end as height from part""")
def prj14(spark, sf_dir):
    """Some rasters are out of scale, some out of phase, some turned."""
    k, s = F.col("p_partkey"), F.col("p_size")
    a = F.when(s % 5 == 0, RES * 1.001).otherwise(RES * (1 + 1e-12))
    c = -180 + (k % 300) * RES + F.when(s % 7 == 0, 0.01).otherwise(1e-7)
    b = F.when(k % 3 == 0, 0.5).otherwise(0.0)
    w = lattice.window_of_transform(a, b, c, F.lit(0.0), F.lit(-RES), 90 - (k % 200) * RES, s, F.lit(4), RES)
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), w.alias("w")).select("k", "w.*")


@query("prj15_window_algebra", f"with {PAIR} select k, c - c2 as col, r - r2 as row, c + 1 as col_min, r + 0 as row_min, w - 1 as width, h + 0 as height from p")
def prj15b(spark, sf_dir):
    """A window's place within another one, and a part of it: all but its first column."""
    w = F.col("w")
    part = lattice.sub_window(w, F.lit(1), F.lit(0), w["width"] - 1, w["height"])
    return _pairs(spark, sf_dir).select("k", lattice.offset_in(w, F.col("o")).alias("at"), part.alias("s")).select("k", "at.*", "s.*")


@query("flt06_window_algebra", f"""with {PAIR}, q as (select *, greatest(c, c2) as ic, greatest(r, r2) as ir, least(c + w, c2 + w2) as ie, least(r + h, r2 + h2) as ib from p)
select k, c <= c2 and r <= r2 and c + w >= c2 + w2 and r + h >= r2 + h2 as holds, case when ie > ic and ib > ir then ic end as col_min, case when ie > ic and ib > ir then ir end as row_min, case when ie > ic and ib > ir then ie - ic end as width,
 case when ie > ic and ib > ir then ib - ir end as height, least(c, c2) as u_col_min, least(r, r2) as u_row_min, greatest(c + w, c2 + w2) - least(c, c2) as u_width, greatest(r + h, r2 + h2) - least(r, r2) as u_height from q""")
def flt06(spark, sf_dir):
    w, o = F.col("w"), F.col("o")
    df = _pairs(spark, sf_dir).select("k", lattice.contains(w, o).alias("holds"), lattice.intersection(w, o).alias("i"), lattice.union(w, o).alias("u"))
    return df.select("k", "holds", "i.*", *(F.col(f"u.{n}").alias(f"u_{n}") for n in WINDOW))


@query("flt05_range_contains", grids.RANGES + " select a.k as a, a.c0 <= b.c0 and a.r0 <= b.r0 and a.c1 >= b.c1 and a.r1 >= b.r1 as holds from r a join r b on b.k = a.k + 40")
def flt05b(spark, sf_dir):
    return grids._ranges(spark, sf_dir).select("a", boxes.range_contains(F.col("s"), F.col("o")).alias("holds"))


BOX = f"bx as ({inputs.BOXES_SQL})"


@query("flt03_coverage", f"""with {BOX} select box, west >= 4 and south >= 2 and east <= 50 and north <= 26 as planned, west < 50 and east > 4 and south < 26 and north > 2 as requested from bx""")
def flt03(spark, sf_dir):
    """A plan needs the source to hold its box; a request only needs to meet it."""
    b = F.struct(*grids.SIDES)
    cover = F.struct(*(F.lit(v).alias(n) for v, n in zip((4.0, 2.0, 50.0, 26.0), grids.SIDES)))
    return inputs.boxes(spark, sf_dir).select("box", boxes.contains(cover, b).alias("planned"), boxes.intersection(cover, b).isNotNull().alias("requested"))


@query("flt04_buffered", f"with {BOX} select box, west - 0.75e0 as west, south - 0.75e0 as south, east + 0.75e0 as east, north + 0.75e0 as north from bx")
def flt04b(spark, sf_dir):
    return inputs.boxes(spark, sf_dir).select("box", boxes.buffered(F.struct(*grids.SIDES), 0.75).alias("b")).select("box", "b.*")


@query("flt14_imagery_coverage", f"with {BOX} select box from bx where west >= 2 and south >= 1 and east <= 55 and north <= 28")
def flt14(spark, sf_dir):
    cover = F.struct(*(F.lit(v).alias(n) for v, n in zip((2.0, 1.0, 55.0, 28.0), grids.SIDES)))
    return inputs.boxes(spark, sf_dir).where(boxes.contains(cover, F.struct(*grids.SIDES))).select("box")


@query("flt15_tolerance", "select p_partkey as k, abs(p_retailprice - (p_retailprice + p_size * 1e-8)) <= 2e-7 as absolute, abs(p_size * 1e-10) <= 2e-9 as relative from part")
def flt15(spark, sf_dir):
    p, s = F.col("p_retailprice"), F.col("p_size")
    return inputs.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), boxes.close(p, p + s * 1e-8, absolute=2e-7).alias("absolute"), (F.abs(s * 1e-10) <= 2e-9).alias("relative"))


@query("jn04_window_tiles", f"""with {WIN}, y as (select *, unnest(range(r // 8, (r + h - 1) // 8 + 1)) as iy from w) select k, unnest(range(c // 8, (c + w - 1) // 8 + 1)) as ix, iy from y order by k, iy, ix""")
def jn04(spark, sf_dir):
    df = lattice.tiles_of_windows(_windows(spark, sf_dir).select("k", "w.*"), 8)
    return df.select("k", "ix", "iy").orderBy("k", "iy", "ix")


NEEDS = f"""{WIN}, y as (select *, unnest(range(r // 8, (r + h - 1) // 8 + 1)) as iy from w), x as (select *, unnest(range(c // 8, (c + w - 1) // 8 + 1)) as ix from y),
n as (select ix, iy, min(greatest(c, ix * 8)) as c0, min(greatest(r, iy * 8)) as r0, max(least(c + w, ix * 8 + 8)) as c1, max(least(r + h, iy * 8 + 8)) as r1 from x group by ix, iy)"""


@query("agg03_lattice_needs", f"with {NEEDS} select ix, iy, c0 as col_min, r0 as row_min, c1 - c0 as width, r1 - r0 as height from n")
def agg03(spark, sf_dir):
    return lattice.tile_needs(_windows(spark, sf_dir).select("w.*"), 8)


@query("agg11_tile_set", f"with {NEEDS} select iy, array_to_string(list(ix order by ix), ',') as tiles from n group by iy")
def agg11(spark, sf_dir):
    """Of each line of tiles the set of them, in order."""
    t = lattice.tiles_of_windows(_windows(spark, sf_dir).select("w.*"), 8)
    return t.groupBy("iy").agg(F.array_join(F.transform(F.array_sort(F.collect_set("ix")), lambda x: x.cast("string")), ",").alias("tiles"))


@query("agg08_sampling_pixels", f"""with v as ({inputs.VERTICES_SQL}), f as (select world, x / 0.5e0 - 0.5e0 as u, (32 - y) / 0.5e0 - 0.5e0 as v from v)
select world, cast(floor(min(u) - 1e-3) as bigint) as col_min, cast(floor(min(v) - 1e-3) as bigint) as row_min, cast(floor(max(u) + 1e-3) as bigint) + 1 as col_max, cast(floor(max(v) + 1e-3) as bigint) + 1 as row_max from f group by world""")
def agg08(spark, sf_dir):
    return grids.SMALL.sampling_pixels(inputs.vertices(spark, sf_dir), ["world"])


@query("agg10_resolutions", "select p_brand as dataset, count(distinct round((p_size + p_partkey % 2 * 1e-11) / 8.0e0, 9)) as n, count(distinct round((p_size + p_partkey % 2 * 1e-11) / 8.0e0, 9)) > 1 as mixed from part where p_size % 25 < 2 group by p_brand")
def agg10(spark, sf_dir):
    r = F.round((F.col("p_size") + F.col("p_partkey") % 2 * 1e-11) / 8, 9)
    df = inputs.table(spark, sf_dir, "part").where("p_size % 25 < 2").groupBy(F.col("p_brand").alias("dataset"))
    return df.agg(F.count_distinct(r).alias("n"), (F.count_distinct(r) > 1).alias("mixed"))


@query("agg12_distinct_corners", f"""with v as ({inputs.VERTICES_SQL}), c as (select floor(x / 4) as lon, floor(y / 4) as lat, world * 6 + seq as pos from v) select lon, lat, min(pos) as first_pos from c group by lon, lat""")
def agg12(spark, sf_dir):
    """Each corner once, in the order of its first occurrence."""
    c = inputs.vertices(spark, sf_dir).select(F.floor(F.col("x") / 4).cast("double").alias("lon"), F.floor(F.col("y") / 4).cast("double").alias("lat"), (F.col("world") * 6 + F.col("seq")).alias("pos"))
    return c.groupBy("lon", "lat").agg(F.min("pos").alias("first_pos")).orderBy("first_pos")


for _name, _order in (("srt01_reading_order", "iy, ix"), ("srt02_natural_order", "ix, iy")):
    def _sorted(spark, sf_dir, keys=tuple(_order.split(", "))):
        t = lattice.tile_needs(_windows(spark, sf_dir).select("w.*"), 8).select("ix", "iy")
        return inputs.numbered(t, *keys)

    query(_name, f"with {NEEDS} select ix, iy, row_number() over (order by {_order}) - 1 as position from n")(_sorted)


@query("prj06_tile_transform", f"""with bt as (select s_suppkey as k, s_suppkey % 9 - 4 as ix, s_suppkey % 5 - 2 as iy from supplier) select k, 0.5e0 as a, ix * 2.0e0 as c, -0.5e0 as e, 32 - iy * 2.0e0 as f, 2.0e0 as span from bt""")
def prj06b(spark, sf_dir):
    k = F.col("s_suppkey")
    df = inputs.table(spark, sf_dir, "supplier").select(k.alias("k"), grids.SMALL.tile_bounds(k % 9 - 4, k % 5 - 2).alias("b"))
    return df.select("k", grid.transform_of(F.col("b"), grids.SMALL.resolution).alias("t"), F.lit(grids.SMALL.span).alias("span")).select("k", "t.*", "span")


@query("prj08_rotated_affine", "select event_id, event_id % 40 * 2 + event_id % 30 * 0.5e0 + 3 as x, event_id % 40 * 1 + event_id % 30 * 4.0e0 + 5 as y from events")
def prj08b(spark, sf_dir):
    k = F.col("event_id")
    return inputs.table(spark, sf_dir, "events").select(k, grid.affine(2, 0.5, 3, 1, 4.0, 5, k % 40, k % 30).alias("p")).select("event_id", "p.*")


@query("prj18_out_of_phase", f"""with {BOX}, d as (select box, (((west - 0.375e0) % 2) + 2) % 2 as d from bx) select box, 'grid origin is ' || cast(least(d, 2 - d) as varchar) || ' off the source phase' as warning from d where least(d, 2 - d) > 1e-6""")
def prj18(spark, sf_dir):
    off = grid.phase_distance(F.col("west"), F.lit(0.375), F.lit(2.0))
    df = inputs.boxes(spark, sf_dir).select("box", off.alias("off")).where("off > 1e-6")
    return df.select("box", F.concat(F.lit("grid origin is "), F.col("off").cast("string"), F.lit(" off the source phase")).alias("warning"))


@query("src19_read_bounds", f"with {BOX} select box, greatest(1, cast(ceil((east - west) / 0.3e0 - 1e-9) as bigint)) as width, greatest(1, cast(ceil((north - south) / 0.3e0 - 1e-9) as bigint)) as height from bx")
def src19(spark, sf_dir):
    """Pixels of a read of arbitrary bounds, snapped outward."""
    n = lambda a, b: F.greatest(F.lit(1).cast("long"), F.ceil((F.col(b) - F.col(a)) / 0.3 - 1e-9))
    return inputs.boxes(spark, sf_dir).select("box", n("west", "east").alias("width"), n("south", "north").alias("height"))
