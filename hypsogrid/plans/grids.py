"""Grid, lattice and projection queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boxes, grid, projection
from . import inputs
from .registry import query

GRID = grid.TileGrid(-999999.6, -800000.12, 4096, 2.0)
SMALL = grid.TileGrid(0.0, 32.0, 4, 0.5)
PT, BOX = f"pt as ({inputs.POINTS_SQL})", f"bx as ({inputs.BOXES_SQL})"
SIDES = ("west", "south", "east", "north")


def _flat(df, *names):
    return df.select("event_id", *(f"{n}.*" for n in names))


@query("prj05_tile_index", f"""with {PT} select event_id, cast(floor((u - 0) / 2) as bigint) as ix, cast(floor((32 - v) / 2) as bigint) as iy from pt""")
def prj05(spark, sf_dir):
    return _flat(inputs.points(spark, sf_dir).withColumn("t", SMALL.tile_index(F.col("u"), F.col("v"))), "t")


@query("prj06_tile_bounds", f"""with {PT}, t as (select event_id, cast(floor(u / 2) as bigint) as ix, cast(floor((32 - v) / 2) as bigint) as iy from pt)
select event_id, ix * 2.0e0 as west, 32 - iy * 2.0e0 - 2 as south, ix * 2.0e0 + 2 as east, 32 - iy * 2.0e0 as north from t""")
def prj06(spark, sf_dir):
    df = inputs.points(spark, sf_dir).withColumn("t", SMALL.tile_index(F.col("u"), F.col("v")))
    return _flat(df.withColumn("b", SMALL.tile_bounds(F.col("t.ix"), F.col("t.iy"))), "b")


@query("prj07_tile_local", """with p as (select event_id, (event_id * 37 % 101) - 50 as c, (event_id * 53 % 97) - 48 as r from events)
select event_id, cast(floor(c / 4.0e0) as bigint) as ix, cast(floor(r / 4.0e0) as bigint) as iy, ((c % 4) + 4) % 4 as col, ((r % 4) + 4) % 4 as row from p""")
def prj07(spark, sf_dir):
    key = F.col("event_id")
    df = inputs.table(spark, sf_dir, "events").select(key, SMALL.local(key * 37 % 101 - 50, key * 53 % 97 - 48).alias("t"))
    return _flat(df, "t")


@query("prj08_pixel_center", """select event_id, (event_id * 37 % 101 + 0.5e0) * 0.5e0 as x, 32 - (event_id * 53 % 97 + 0.5e0) * 0.5e0 as y from events""")
def prj08(spark, sf_dir):
    key = F.col("event_id")
    return _flat(inputs.table(spark, sf_dir, "events").select(key, SMALL.pixel_center(key * 37 % 101, key * 53 % 97).alias("p")), "p")


@query("prj09_inverse_affine", f"""with {PT} select event_id, ((u - 3) * 4 - (v - 5) * 0.5e0) / 7.5e0 as col, ((v - 5) * 2 - (u - 3)) / 7.5e0 as row from pt""")
def prj09(spark, sf_dir):
    df = inputs.points(spark, sf_dir)
    return _flat(df.withColumn("p", grid.inverse_affine(2.0, 0.5, 3.0, 1.0, 4.0, 5.0, F.col("u"), F.col("v"))), "p")


SNAP = f"""with {BOX}, s as (select box, cast(floor((west + 180) / 0.125e0 + 1e-6) as bigint) as l, cast(floor((90 - north) / 0.125e0 + 1e-6) as bigint) as t,
 cast(ceil((east + 180) / 0.125e0 - 1e-6) as bigint) as r, cast(ceil((90 - south) / 0.125e0 - 1e-6) as bigint) as b from bx)
select box, l as col_min, t as row_min, greatest(1, r - l) as width, greatest(1, b - t) as height from s"""


def _snapped(spark, sf_dir):
    return inputs.boxes(spark, sf_dir).withColumn("w", grid.snap_window(*(F.col(c) for c in SIDES), 0.125))


@query("prj13_snap_window", SNAP)
def prj13(spark, sf_dir):
    return _snapped(spark, sf_dir).select("box", "w.*")


@query("prj15_scale_window", f"select box, 8 * col_min as col_min, 8 * row_min as row_min, 8 * width as width, 8 * height as height from ({SNAP})")
def prj15(spark, sf_dir):
    return _snapped(spark, sf_dir).select("box", grid.scale_window(F.col("w"), 8).alias("w")).select("box", "w.*")


@query("ras05_split_windows", f"""with s as ({SNAP}), y as (select *, unnest(range(0, height, 7)) as piece_y from s), x as (select *, unnest(range(0, width, 7)) as piece_x from y)
select box, piece_x, piece_y, least(7, width - piece_x) as piece_w, least(7, height - piece_y) as piece_h from x""")
def ras05(spark, sf_dir):
    cut = grid.split_windows(_snapped(spark, sf_dir).select("box", "w.*"), 7)
    return cut.select("box", "piece_x", "piece_y", "piece_w", "piece_h")


@query("prj16_densified_ring", f"""with {BOX}, k as (select unnest(range(0, 65)) as k), s as (select unnest(range(0, 4)) as side)
select box, cast(side as int) as side, cast(k as int) as k,
 case side when 2 then west when 3 then east else west + (east - west) * (k / 64.0e0) end as x,
 case side when 0 then south when 1 then north else south + (north - south) * (k / 64.0e0) end as y from bx, s, k""")
def prj16(spark, sf_dir):
    df = inputs.boxes(spark, sf_dir)
    return df.select("box", F.explode(grid.ring(*(F.col(c) for c in SIDES))).alias("p")).select("box", "p.*")


@query("prj17_align_origin", f"""with {BOX} select box, west + (((0.375e0 - west) % 2) + 2) % 2 as aligned,
 least((((west - 0.375e0) % 2) + 2) % 2, 2 - (((west - 0.375e0) % 2) + 2) % 2) as off_phase from bx""")
def prj17(spark, sf_dir):
    west, native, step = F.col("west"), F.lit(0.375), F.lit(2.0)
    return inputs.boxes(spark, sf_dir).select(
        "box", grid.align_origin(west, native, step).alias("aligned"), grid.phase_distance(west, native, step).alias("off_phase"))


@query("prj22_range_tags", """with t as (select event_id, case event_id % 4 when 0 then concat(event_id, ',', event_id % 7, ',', event_id + event_id % 5, ',', event_id % 7)
 when 1 then concat(event_id, ',2,3') when 2 then concat(event_id, ',x,', event_id, ',4') else concat(event_id, ',5,', event_id - 1, ',9') end as tag from events)
select event_id, tag, case when event_id % 4 = 0 then event_id end as col_min, case when event_id % 4 = 0 then event_id % 7 end as row_min,
 case when event_id % 4 = 0 then event_id + event_id % 5 end as col_max, case when event_id % 4 = 0 then event_id % 7 end as row_max from t""")
def prj22(spark, sf_dir):
    k = F.col("event_id")
    tag = (F.when(k % 4 == 0, grid.to_tag(k, k % 7, k + k % 5, k % 7)).when(k % 4 == 1, grid.to_tag(k, F.lit(2), F.lit(3)))
           .when(k % 4 == 2, grid.to_tag(k, F.lit("x"), k, F.lit(4))).otherwise(grid.to_tag(k, F.lit(5), k - 1, F.lit(9))))
    df = inputs.table(spark, sf_dir, "events").select(k, tag.alias("tag"))
    return df.select("event_id", "tag", grid.from_tag(F.col("tag")).alias("r")).select("event_id", "tag", "r.*")


@query("prj23_tile_paths", """select event_id, concat('tile_', event_id % 9 - 4, '_', event_id % 5 - 2, '.tif') as path, event_id % 9 - 4 as ix, event_id % 5 - 2 as iy from events""")
def prj23(spark, sf_dir):
    k = F.col("event_id")
    df = inputs.table(spark, sf_dir, "events").select(k, grid.tile_path(k % 9 - 4, k % 5 - 2).alias("path"))
    return df.select("event_id", "path", grid.parse_tile_path(F.col("path")).alias("t")).select("event_id", "path", "t.*")


@query("flt11_sampling_region", """select distinct event_id % 9 - 4 as ix, event_id % 5 - 2 as iy, round((event_id % 9 - 4) * 2.0e0 - 0.501e0 * 0.5e0, 6) as west,
 round(32 - (event_id % 5 - 2) * 2.0e0 - 2 - 0.501e0 * 0.5e0, 6) as south, round((event_id % 9 - 4) * 2.0e0 + 2 + 0.501e0 * 0.5e0, 6) as east,
 round(32 - (event_id % 5 - 2) * 2.0e0 + 0.501e0 * 0.5e0, 6) as north from events""")
def flt11(spark, sf_dir):
    k = F.col("event_id")
    tiles = inputs.table(spark, sf_dir, "events").select((k % 9 - 4).alias("ix"), (k % 5 - 2).alias("iy")).distinct()
    r = SMALL.sampling_region(F.col("ix"), F.col("iy"))
    return tiles.select("ix", "iy", *(F.round(r[n], 6).alias(n) for n in SIDES))


@query("flt04_box_algebra", f"""with {BOX} select a.box as a, b.box as b, greatest(a.west, b.west) as west, greatest(a.south, b.south) as south, least(a.east, b.east) as east, least(a.north, b.north) as north,
 a.west <= b.west and a.south <= b.south and a.east >= b.east and a.north >= b.north as holds
 from bx a join bx b on b.box = a.box + 60 where greatest(a.west, b.west) < least(a.east, b.east) and greatest(a.south, b.south) < least(a.north, b.north)""")
def flt04(spark, sf_dir):
    df = inputs.boxes(spark, sf_dir).select("box", F.struct(*SIDES).alias("s"))
    other = df.select((F.col("box") - 60).alias("box"), F.col("box").alias("b"), F.col("s").alias("o"))
    met = df.join(other, "box").select(F.col("box").alias("a"), "b", boxes.intersection(F.col("s"), F.col("o")).alias("i"), boxes.contains(F.col("s"), F.col("o")).alias("holds"))
    return met.where("i is not null").select("a", "b", "i.*", "holds")


RANGES = """with r as (select s_suppkey as k, s_suppkey * 7 % 40 as c0, s_suppkey * 5 % 30 as r0, s_suppkey * 7 % 40 + s_suppkey % 6 as c1, s_suppkey * 5 % 30 + s_suppkey % 4 as r1 from supplier)"""


def _ranges(spark, sf_dir):
    k = F.col("s_suppkey")
    c, r = k * 7 % 40, k * 5 % 30
    rng = F.struct(c.alias("col_min"), r.alias("row_min"), (c + k % 6).alias("col_max"), (r + k % 4).alias("row_max"))
    df = inputs.table(spark, sf_dir, "supplier").select(k.alias("a"), rng.alias("s"))
    return df.join(df.select((F.col("a") - 40).alias("a"), F.col("s").alias("o")), "a")


@query("flt05_range_algebra", RANGES + """ select a.k as a, case when ok then greatest(a.c0, b.c0) end as col_min, case when ok then greatest(a.r0, b.r0) end as row_min,
 case when ok then least(a.c1, b.c1) end as col_max, case when ok then least(a.r1, b.r1) end as row_max,
 least(a.c0, b.c0) as u_col_min, least(a.r0, b.r0) as u_row_min, greatest(a.c1, b.c1) as u_col_max, greatest(a.r1, b.r1) as u_row_max
 from r a join r b on b.k = a.k + 40, lateral (select greatest(a.c0, b.c0) <= least(a.c1, b.c1) and greatest(a.r0, b.r0) <= least(a.r1, b.r1) as ok)""")
def flt05(spark, sf_dir):
    df = _ranges(spark, sf_dir).select("a", boxes.range_intersection(F.col("s"), F.col("o")).alias("i"), boxes.range_union(F.col("s"), F.col("o")).alias("u"))
    return df.select("a", "i.*", *(F.col(f"u.{n}").alias(f"u_{n}") for n in boxes.RANGE))


#: Ends in the table `kr`: all of p with r and d, from which x = -r sin(n d) and y = -r cos(n d).
KROVAK_SQL = f"""p as ({inputs.PLACES_SQL}), g as (select event_id, radians(lon) as lam, radians(lat) as phi, {projection.WGS84_A} / sqrt(1 - {projection.WGS84_F * (2 - projection.WGS84_F)!r} * sin(radians(lat)) * sin(radians(lat))) as n from p),
c as (select event_id, (n * cos(phi) * cos(lam) - 572.213e0) / 1.0000035378e0 as x, (n * cos(phi) * sin(lam) - 85.334e0) / 1.0000035378e0 as y,
 (n * {1 - projection.WGS84_F * (2 - projection.WGS84_F)!r} * sin(phi) - 461.94e0) / 1.0000035378e0 as z from g),
h as (select event_id, x + {projection.ROTATION[2]!r} * y - {projection.ROTATION[1]!r} * z as x, y - {projection.ROTATION[2]!r} * x + {projection.ROTATION[0]!r} * z as y,
 z + {projection.ROTATION[1]!r} * x - {projection.ROTATION[0]!r} * y as z from c),
th as (select *, sqrt(x * x + y * y) as r, atan2(z * 6377397.155e0, sqrt(x * x + y * y) * {projection.BESSEL_A * (1 - projection.BESSEL_F)!r}) as th from h),
b as (select event_id, atan2(y, x) as lam, atan2(z + {projection.BESSEL_F * (2 - projection.BESSEL_F) / (1 - projection.BESSEL_F * (2 - projection.BESSEL_F)) * projection.BESSEL_A * (1 - projection.BESSEL_F)!r} * sin(th) * sin(th) * sin(th),
 r - {projection.BESSEL_F * (2 - projection.BESSEL_F) * projection.BESSEL_A!r} * cos(th) * cos(th) * cos(th)) as phi from th),
k as (select sqrt(0.006674372230614e0) as e, 0.006674372230614e0 as e2, radians(49.5e0) as p0, radians(24 + 50 / 60.0e0) as l0, pi() / 2 - 1.04216856380474e0 as al, radians(78.5e0) as pp),
k2 as (select *, 6377397.155e0 * sqrt(1 - e2) / (1 - e2 * sin(p0) ** 2) as a, sqrt(1 + e2 * cos(p0) ** 4 / (1 - e2)) as bb, sin(pp) as n from k),
k3 as (select *, tan(pi() / 4 + asin(sin(p0) / bb) / 2) * ((1 + e * sin(p0)) / (1 - e * sin(p0))) ** (e * bb / 2) / tan(pi() / 4 + p0 / 2) ** bb as t0, 0.9999e0 * a / tan(pp) as r0 from k2),
u as (select *, 2 * (atan(t0 * tan(phi / 2 + pi() / 4) ** bb / ((1 + e * sin(phi)) / (1 - e * sin(phi))) ** (e * bb / 2)) - pi() / 4) as u, bb * (l0 - lam) as v from b, k3),
t as (select *, asin(cos(al) * sin(u) + sin(al) * cos(u) * cos(v)) as t from u),
d as (select *, asin(cos(u) * sin(v) / cos(t)) as d, r0 * tan(pp / 2 + pi() / 4) ** n / tan(t / 2 + pi() / 4) ** n as r from t),
kr as (select event_id, -r * sin(n * d) as x, -r * cos(n * d) as y from d)"""


@query("prj01_krovak", f"with {KROVAK_SQL} select event_id, round(x, 3) as x, round(y, 3) as y from kr")
def prj01(spark, sf_dir):
    return projection.krovak(inputs.places(spark, sf_dir)).select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query("prj02_web_mercator", f"""select event_id, round(6378137 * radians(lon), 3) as x, round(6378137 * ln(tan(radians(lat) / 2 + pi() / 4)), 3) as y from ({inputs.PLACES_SQL})""")
def prj02(spark, sf_dir):
    return projection.project(inputs.places(spark, sf_dir), 3857).select("event_id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


UTM_SQL = """with o as (select c_custkey as world, case when c_custkey % 4 = 0 then 'LATLON' else 'UTM' end as units, case when c_custkey % 4 = 0 then c_custkey % 90 * 1.0e0 else 400000.0e0 + c_custkey * 37 % 200000 end as x,
 case when c_custkey % 4 = 0 then c_custkey % 180 * 1.0e0 else 5300000.0e0 + c_custkey * 101 % 300000 end as y, 12 + c_custkey % 700 / 100.0e0 as clon, case when c_custkey % 7 = 0 then -49.5e0 else 49.5e0 end as clat from customer),
k as (select 1 / 298.257223563e0 * (2 - 1 / 298.257223563e0) as e2), k2 as (select e2, e2 / (1 - e2) as ep2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) as e1 from k),
a as (select *, greatest(1, least(60, cast(floor((clon + 180) / 6) as int) + 1)) * 6.0e0 - 183 as mid, (y - case when clat >= 0 then 0 else 10000000.0e0 end) / 0.9996e0 / (6378137.0e0 * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256)) as mu from o, k2),
b as (select *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu) + 151 * e1 ** 3 / 96 * sin(6 * mu) + 1097 * e1 ** 4 / 512 * sin(8 * mu) as p from a),
c as (select *, 6378137.0e0 / sqrt(1 - e2 * sin(p) ** 2) as n, tan(p) ** 2 as t, ep2 * cos(p) ** 2 as c, (1 - e2 * sin(p) ** 2) / (1 - e2) as q from b),
d as (select *, (x - 500000) / (n * 0.9996e0) as d from c)
select world, round(case when units = 'LATLON' then x else degrees(p - tan(p) * q * (d ** 2 / 2 - (5 + 3 * t + 10 * c - 4 * c ** 2 - 9 * ep2) * d ** 4 / 24 + (61 + 90 * t + 298 * c + 45 * t ** 2 - 252 * ep2 - 3 * c ** 2) * d ** 6 / 720)) end, 6) as origin_lat,
 round(case when units = 'LATLON' then y else mid + degrees((d - (1 + 2 * t + c) * d ** 3 / 6 + (5 - 2 * c + 28 * t - 3 * c ** 2 + 8 * ep2 + 24 * t ** 2) * d ** 5 / 120) / cos(p)) end, 6) as origin_lon from d"""


@query("prj03_origin_latlon", UTM_SQL)
def prj03(spark, sf_dir):
    """Origins given as latitude and longitude stay; UTM ones lie in the zone and hemisphere of the polygon's centre."""
    k = F.col("c_custkey")
    flat = k % 4 == 0
    o = inputs.table(spark, sf_dir, "customer").select(
        k.alias("world"), flat.alias("flat"), F.when(flat, (k % 90).cast("double")).otherwise(400000.0 + k * 37 % 200000).alias("x"),
        F.when(flat, (k % 180).cast("double")).otherwise(5300000.0 + k * 101 % 300000).alias("y"),
        (12 + k % 700 / 100).alias("clon"), F.when(k % 7 == 0, -49.5).otherwise(49.5).alias("clat"))
    df = projection.utm_to_lonlat(o, "x", "y", projection.utm_zone(F.col("clon")), F.col("clat") >= 0)
    pick = lambda a, b: F.round(F.when(F.col("flat"), F.col(a)).otherwise(F.col(b)), 6)
    return df.select("world", pick("x", "lat").alias("origin_lat"), pick("y", "lon").alias("origin_lon"))


BACK_SQL = f"""k as (select sqrt(0.006674372230614e0) as e, 0.006674372230614e0 as e2, radians(49.5e0) as p0, radians(24 + 50 / 60.0e0) as l0, pi() / 2 - 1.04216856380474e0 as al, radians(78.5e0) as pp),
k2 as (select *, 6377397.155e0 * sqrt(1 - e2) / (1 - e2 * sin(p0) ** 2) as a, sqrt(1 + e2 * cos(p0) ** 4 / (1 - e2)) as bb, sin(pp) as n from k),
k3 as (select *, tan(pi() / 4 + asin(sin(p0) / bb) / 2) * ((1 + e * sin(p0)) / (1 - e * sin(p0))) ** (e * bb / 2) / tan(pi() / 4 + p0 / 2) ** bb as t0, 0.9999e0 * a / tan(pp) as r0 from k2),
i0 as (select id, sqrt(x * x + y * y) as rho, atan2(-x, -y) / n as d, k3.* from m, k3),
i1 as (select *, 2 * (atan((r0 / rho) ** (1 / n) * tan(pp / 2 + pi() / 4)) - pi() / 4) as t from i0),
i2 as (select *, asin(cos(al) * sin(t) - sin(al) * cos(t) * cos(d)) as u from i1),
i3 as (select id, e, l0 - asin(cos(t) * sin(d) / cos(u)) / bb as lam, (tan(u / 2 + pi() / 4) / t0) ** (1 / bb) as k, list_reduce([u] || range(6), lambda p, i:
  2 * (atan((tan(u / 2 + pi() / 4) / t0) ** (1 / bb) * ((1 + e * sin(p)) / (1 - e * sin(p))) ** (e / 2)) - pi() / 4)) as phi from i2),
b1 as (select id, lam, phi, 6377397.155e0 / sqrt(1 - {projection.BESSEL_F * (2 - projection.BESSEL_F)!r} * sin(phi) ** 2) as nu, 0.0e0 as h from i3)"""


def _back_pass(before: str, after: str) -> str:
    m, e2, b = projection._helmert_inverse(), projection.WGS84_F * (2 - projection.WGS84_F), projection.WGS84_A * (1 - projection.WGS84_F)
    axis = lambda i: f"({m[i][0]!r} * gx + {m[i][1]!r} * gy + {m[i][2]!r} * gz) * 1.0000035378e0 + {projection.SHIFT[i]!r}"
    return f"""{after}g as (select *, (nu + h) * cos(phi) * cos(lam) as gx, (nu + h) * cos(phi) * sin(lam) as gy, (nu * {1 - projection.BESSEL_F * (2 - projection.BESSEL_F)!r} + h) * sin(phi) as gz from {before}),
{after}w as (select id, lam, phi, nu, h, {axis(0)} as wx, {axis(1)} as wy, {axis(2)} as wz from {after}g),
{after}t as (select *, sqrt(wx * wx + wy * wy) as r, atan2(wz * 6378137.0e0, sqrt(wx * wx + wy * wy) * {b!r}) as th from {after}w),
{after}l as (select *, atan2(wz + {e2 / (1 - e2) * b!r} * sin(th) ** 3, r - {e2 * projection.WGS84_A!r} * cos(th) ** 3) as lat from {after}t),
{after} as (select id, lam, phi, nu, h - (r / cos(lat) - 6378137.0e0 / sqrt(1 - {e2!r} * sin(lat) ** 2)) as h, degrees(atan2(wy, wx)) as lon, degrees(lat) as lat from {after}l)"""


@query("prj02_krovak_to_lonlat", f"""with m as (select s_suppkey as id, -900000.0e0 + s_suppkey * 4001 % 450000 as x, -1200000.0e0 + s_suppkey * 2503 % 260000 as y from supplier), {BACK_SQL}, {_back_pass("b1", "b2")}, {_back_pass("b2", "b3")}
select id, round(lon, 9) as lon, round(lat, 9) as lat from b3""")
def prj02_back(spark, sf_dir):
    """Krovak's metres as degrees."""
    k = F.col("s_suppkey")
    m = inputs.table(spark, sf_dir, "supplier").select(k.alias("id"), (-900000.0 + k * 4001 % 450000).alias("x"), (-1200000.0 + k * 2503 % 260000).alias("y"))
    return projection.transform(m, 5514, 4326, out=("lon", "lat")).select("id", F.round("lon", 9).alias("lon"), F.round("lat", 9).alias("lat"))


UTM_PLACES = """select id as event_id, 15 + degrees((d - (1 + 2 * t + c) * d ** 3 / 6 + (5 - 2 * c + 28 * t - 3 * c ** 2 + 8 * ep2 + 24 * t ** 2) * d ** 5 / 120) / cos(p)) as lon,
 degrees(p - tan(p) * q * (d ** 2 / 2 - (5 + 3 * t + 10 * c - 4 * c ** 2 - 9 * ep2) * d ** 4 / 24 + (61 + 90 * t + 298 * c + 45 * t ** 2 - 252 * ep2 - 3 * c ** 2) * d ** 6 / 720)) as lat
 from (select *, (x - 500000) / (n * 0.9996e0) as d from (select *, 6378137.0e0 / sqrt(1 - e2 * sin(p) ** 2) as n, tan(p) ** 2 as t, ep2 * cos(p) ** 2 as c, (1 - e2 * sin(p) ** 2) / (1 - e2) as q from (
 select *, mu + (3 * e1 / 2 - 27 * e1 ** 3 / 32) * sin(2 * mu) + (21 * e1 ** 2 / 16 - 55 * e1 ** 4 / 32) * sin(4 * mu) + 151 * e1 ** 3 / 96 * sin(6 * mu) + 1097 * e1 ** 4 / 512 * sin(8 * mu) as p from (
 select *, y / 0.9996e0 / (6378137.0e0 * (1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256)) as mu from (select p_partkey as id, 400000.0e0 + p_partkey * 37 % 200000 as x, 5400000.0e0 + p_partkey * 101 % 200000 as y,
 1 / 298.257223563e0 * (2 - 1 / 298.257223563e0) as e2, e2 / (1 - e2) as ep2, (1 - sqrt(1 - e2)) / (1 + sqrt(1 - e2)) as e1 from part)))))"""


@query("prj02_utm_to_krovak", f"with {KROVAK_SQL.replace(inputs.PLACES_SQL, UTM_PLACES)} select event_id as id, round(x, 3) as x, round(y, 3) as y from kr")
def prj02_utm(spark, sf_dir):
    """Metres of UTM zone 33 as metres of Krovak, through WGS84."""
    k = F.col("p_partkey")
    m = inputs.table(spark, sf_dir, "part").select(k.alias("id"), (400000.0 + k * 37 % 200000).alias("x"), (5400000.0 + k * 101 % 200000).alias("y"))
    return projection.transform(m, 32633, 5514).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))
