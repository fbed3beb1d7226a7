"""Queries on rasters as tables of blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, grid, projection, rasters, sampling, storage, stored
from . import grids, inputs
from .registry import query

SIZE = 8
PX, PT = f"px as ({inputs.PIXELS_SQL})", f"pt as ({inputs.POINTS_SQL})"
#: A raster of 6 km pixels over the places; its pixels are those made from `part`.
WIDE = grid.TileGrid(-905_000.0, -930_000.0, 8, 6000.0)


def _blocks(spark, sf_dir):
    return blocks.to_blocks(inputs.pixels(spark, sf_dir), SIZE)


def _windows(spark, sf_dir):
    k = F.col("s_suppkey")
    return inputs.table(spark, sf_dir, "supplier").select(
        k.alias("window_id"), (k * 3 % 45).alias("col_min"), (k * 2 % 35).alias("row_min"), (3 + k % 9).alias("width"), (2 + k % 7).alias("height"))


WIN = "w as (select s_suppkey as window_id, s_suppkey * 3 % 45 as c, s_suppkey * 2 % 35 as r, 3 + s_suppkey % 9 as width, 2 + s_suppkey % 7 as height from supplier)"


@query("src07_window_scan", f"with {PX}, {WIN} select window_id, col, row, v from px join w on col >= c and col < c + width and row >= r and row < r + height where v is not null")
def src07(spark, sf_dir):
    return blocks.window_scan(_blocks(spark, sf_dir), _windows(spark, sf_dir), SIZE)


@query("src08_single_pixel", f"""with {PX}, {PT} select event_id, cast(px.v as double) as height from (select event_id, cast(floor(u) as bigint) as c, cast(floor(v) as bigint) as r from pt) p left join px on px.col = c and px.row = r""")
def src08(spark, sf_dir):
    return blocks.pixel_at(inputs.points(spark, sf_dir), _blocks(spark, sf_dir), SIZE).select("event_id", "height")


@query("src09_full_scan", f"with {PX} select col, row, v from px where v is not null")
def src09(spark, sf_dir):
    return blocks.pixels_of(_blocks(spark, sf_dir), SIZE)


@query("src12_masked_window_scan", f"""with {PX}, {WIN} select window_id, count(v) as n_valid, sum(cast(v as double)) as total from (select window_id, case when (col + row) % 3 <> 0 then v end as v
 from px join w on col >= c and col < c + width and row >= r and row < r + height) group by window_id having count(v) > 0""")
def src12(spark, sf_dir):
    """A window's heights where its mask is set (here: two pixels of three)."""
    scanned = blocks.window_scan(_blocks(spark, sf_dir), _windows(spark, sf_dir), SIZE).where("(col + row) % 3 <> 0")
    return scanned.groupBy("window_id").agg(F.count("v").alias("n_valid"), F.sum(F.col("v").cast("double")).alias("total"))


FOUR = f"""{PX}, {PT}, k as (select *, cast(floor(u) as bigint) c0, cast(floor(v) as bigint) r0, u - floor(u) fx, v - floor(v) fy from pt)"""
LERP = "(cast(a.v as double) * (1 - fx) + cast(b.v as double) * fx) * (1 - fy) + (cast(c.v as double) * (1 - fx) + cast(d.v as double) * fx) * fy"
FOUR_JOINS = """left join px a on a.col = c0 and a.row = r0 left join px b on b.col = c0 + 1 and b.row = r0
left join px c on c.col = c0 and c.row = r0 + 1 left join px d on d.col = c0 + 1 and d.row = r0 + 1"""


@query("ras01_height_at_lonlat", f"""with {grids.KROVAK_SQL}, {PX}, k0 as (select event_id, (x + 905000) / 6000 - 0.5e0 as u, (-930000 - y) / 6000 - 0.5e0 as v from kr),
kq as (select *, cast(floor(u) as bigint) c0, cast(floor(v) as bigint) r0, u - floor(u) fx, v - floor(v) fy from k0) select event_id, round({LERP}, 3) as height from kq {FOUR_JOINS}""")
def ras01_lonlat(spark, sf_dir):
    """Heights at places: projected, turned to pixels, read from the declared blocks, interpolated."""
    p = projection.krovak(inputs.places(spark, sf_dir))
    at = WIDE.fractional(F.col("x"), F.col("y"))
    found = blocks.bilinear(p.select("event_id", at["u"].alias("u"), at["v"].alias("v")), ["event_id"], _blocks(spark, sf_dir), SIZE)
    return found.select("event_id", F.round("height", 3).alias("height"))


@query("ras02_batch_sample", f"""with {FOUR}, h as (select event_id, {LERP} as height from k {FOUR_JOINS}), q as (select event_id % 32 as request, event_id, event_id * 7 % 50 as pos from events)
select request, list(height order by q.event_id) as heights, list(height is not null order by q.event_id) as valid from (select * from q union all select request, event_id, pos from q where event_id % 5 = 0) q join h using (event_id) group by request""".replace(
    "list(height order by q.event_id)", "array_to_string(list(coalesce(cast(round(height * 1000) as bigint), -1) order by q.event_id), ',')").replace("list(height is not null order by q.event_id)", "count(height)"))
def ras02(spark, sf_dir):
    """Requests of many points, duplicates included: heights (here whole millimetres, -1 for none) in the order of the points."""
    p = inputs.points(spark, sf_dir)
    twice = F.when(F.col("event_id") % 5 == 0, 2).otherwise(1)
    asked = p.groupBy((F.col("event_id") % 32).alias("request")).agg(F.sort_array(F.collect_list(F.struct("event_id", "u", "v", twice.alias("times")))).alias("points"))
    flat = asked.select("request", F.posexplode(F.flatten(F.transform("points", lambda s: F.array_repeat(s, s["times"])))).alias("pos", "p"))
    found = blocks.bilinear(flat.select("request", "pos", "p.u", "p.v"), ["request", "pos"], _blocks(spark, sf_dir), SIZE)
    whole = F.transform(F.sort_array(F.collect_list(F.struct("pos", "height"))), lambda s: F.coalesce(F.round(s["height"] * 1000).cast("long"), F.lit(-1)).cast("string"))
    return found.groupBy("request").agg(F.array_join(whole, ",").alias("heights"), F.count("height").alias("valid"))


@query("jn01_point_tiles", f"""with {PT}, {PX}, t as (select distinct col // 8 as ix, row // 8 as iy from px where v is not null and (col // 8 + row // 8) % 3 <> 0)
select event_id, p.ix, p.iy, t.ix is not null as readable from (select event_id, cast(floor(u / 8) as bigint) as ix, cast(floor(v / 8) as bigint) as iy from pt) p left join t on p.ix = t.ix and p.iy = t.iy""")
def jn01(spark, sf_dir):
    """Each point's tile and whether it is declared."""
    tile = lambda c: F.floor(F.col(c) / SIZE)
    declared = _blocks(spark, sf_dir).where("(bx + by) % 3 <> 0").select(F.col("bx").alias("ix"), F.col("by").alias("iy"), F.lit(True).alias("known"))
    p = inputs.points(spark, sf_dir).select("event_id", tile("u").alias("ix"), tile("v").alias("iy"))
    return p.join(declared, ["ix", "iy"], "left").select("event_id", "ix", "iy", F.coalesce("known", F.lit(False)).alias("readable"))


@query("jn10_declared_only", f"""with {FOUR.replace("px as (select", "px0 as (select").replace(", pt as", ", px as (select * from px0 where (col // 8 + row // 8) % 3 <> 0), pt as", 1)} select event_id, {LERP} as height from k {FOUR_JOINS}""")
def jn10(spark, sf_dir):
    """Blocks of tiles that the manifest does not declare are not read, though they exist."""
    declared = _blocks(spark, sf_dir).select("bx", "by").where("(bx + by) % 3 <> 0")
    return blocks.bilinear(inputs.points(spark, sf_dir), ["event_id"], _blocks(spark, sf_dir).join(declared, ["bx", "by"], "left_semi"), SIZE)


@query("jn02_point_corners", f"with {FOUR} select event_id, corner, c0 + dc as col, r0 + dr as row from k, (values ('v00', 0, 0), ('v10', 1, 0), ('v01', 0, 1), ('v11', 1, 1)) o(corner, dc, dr)")
def jn02(spark, sf_dir):
    return blocks.corners(inputs.points(spark, sf_dir), ["event_id"])


@query("prj04_pixel_fractions", f"""with p as (select event_id, 10 + (event_id * 37 % 4096) / 64.0e0 as x, 30 - (event_id * 101 % 2048) / 64.0e0 as y from events), f as (select event_id, (x - 0) / 0.5e0 - 0.5e0 as u, (32 - y) / 0.5e0 - 0.5e0 as v from p)
select event_id, cast(floor(u) as bigint) as c0, cast(floor(v) as bigint) as r0, u - floor(u) as fx, v - floor(v) as fy from f""")
def prj04(spark, sf_dir):
    k = F.col("event_id")
    p = inputs.table(spark, sf_dir, "events").select(k, grids.SMALL.fractional(10 + (k * 37 % 4096) / 64, 30 - (k * 101 % 2048) / 64).alias("f"))
    return sampling.split_fraction(p.select("event_id", "f.*")).select("event_id", "c0", "r0", "fx", "fy")


RESAMPLE = f"""with {PX}, w as (select unnest(range(0, 60)) as col), h as (select unnest(range(0, 30)) as row), k0 as (select w.col as tc, h.row as tr, w.col * 0.75e0 + 0.25e0 as u, h.row * 1.25e0 + 0.5e0 as v from w, h),
k as (select *, cast(floor(u) as bigint) c0, cast(floor(v) as bigint) r0, u - floor(u) fx, v - floor(v) fy from k0) select tc as col, tr as row, cast({LERP} as float) as v from k {FOUR_JOINS}"""


def _lattice(spark):
    lattice = spark.range(60).select(F.col("id").alias("col"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(29).cast("long"))).alias("row"))
    return lattice.select("col", "row", (F.col("col") * 0.75 + 0.25).alias("u"), (F.col("row") * 1.25 + 0.5).alias("v"))


@query("ras04_resample", RESAMPLE)
def ras04(spark, sf_dir):
    """Another lattice's pixels (60 by 30, steps of 0.75 and 1.25) sampled at their centres, as 32-bit heights."""
    found = blocks.bilinear(_lattice(spark), ["col", "row"], _blocks(spark, sf_dir), SIZE)
    return found.select("col", "row", F.col("height").cast("float").alias("v"))


@query("ras04_halo_resample", RESAMPLE)
def ras04_halo(spark, sf_dir):
    """The same from blocks with a halo in buckets: one join, in which only the lattice's pixels move."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    halo = stored.write_buckets(stored.with_halo(_blocks(spark, sf_dir), SIZE), storage.scratch(spark, "halo"), buckets)
    return stored.bilinear(_lattice(spark), halo, SIZE).select("col", "row", F.col("height").cast("float").alias("v"))


@query("ras06_stitched_pieces", f"""with {PX}, {WIN}, t as (select window_id, col - c as col, row - r as row, v from px join w on col >= c and col < c + width and row >= r and row < r + height where v is not null) select * from t""")
def ras06(spark, sf_dir):
    """Windows read in pieces of at most 4 pixels a side and put together again."""
    w = _windows(spark, sf_dir)
    pieces = grid.split_windows(w, 4).select(
        F.struct("window_id", "col_min", "row_min").alias("window_id"), (F.col("col_min") + F.col("piece_x")).alias("col_min"),
        (F.col("row_min") + F.col("piece_y")).alias("row_min"), F.col("piece_w").alias("width"), F.col("piece_h").alias("height"))
    read = blocks.window_scan(_blocks(spark, sf_dir), pieces, SIZE)
    return read.select("window_id.window_id", (F.col("col") - F.col("window_id.col_min")).alias("col"), (F.col("row") - F.col("window_id.row_min")).alias("row"), "v")


@query("ras07_filled_mosaic", f"""with {PX}, {WIN}, c as (select window_id, w.c, w.r, width, unnest(range(0, height)) as row from w), d as (select window_id, c, r, row, unnest(range(0, width)) as col from c)
select d.window_id, d.col, d.row, px.v from d left join px on px.col = d.c + d.col and px.row = d.r + d.row""")
def ras07_filled(spark, sf_dir):
    w = _windows(spark, sf_dir)
    return blocks.fill_windows(blocks.window_scan(_blocks(spark, sf_dir), w, SIZE), w)


@query("ras08_nodata", """select l_orderkey, l_linenumber, case when l_quantity <> 7 and l_linenumber not in (3, 4) then l_quantity end as v from lineitem""")
def ras08(spark, sf_dir):
    """A source's own NoData value, NaN and infinities become NULL."""
    n = F.col("l_linenumber")
    v = F.when(n == 3, F.lit(float("nan"))).when(n == 4, F.lit(float("inf"))).otherwise(F.col("l_quantity").cast("double"))
    return inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", n, rasters.valid(v, 7.0).alias("v"))


@query("flt02_nodata_on_read", f"""select p_partkey, case when p_size not in (7, 9) then cast(cast(p_retailprice as float) as double) end as v from part""")
def flt02(spark, sf_dir):
    """Stored 32-bit heights with the sentinel -9999 or NaN, read as 64-bit numbers or NULL."""
    stored = F.when(F.col("p_size") == 7, -9999.0).when(F.col("p_size") == 9, float("nan")).otherwise(F.col("p_retailprice")).cast("float")
    return inputs.table(spark, sf_dir, "part").select("p_partkey", rasters.valid(stored, -9999.0).cast("double").alias("v"))


@query("ras09_placed_window", f"""with {PX} select 3 + col as col, 2 + row as row, v from px where v is not null and 3 + col < 32 and 2 + row < 16""")
def ras09(spark, sf_dir):
    """A window laid into an otherwise empty tile of 32 by 16 pixels, its corner at (3, 2); what lies outside is cut off."""
    return rasters.placed(inputs.pixels(spark, sf_dir), 3, 2, 32, 16).where("v is not null")


@query("ras10_rgba", """with p as (select p_partkey % 50 as col, p_partkey // 50 as row, p_size * 5 as r, p_size * 3 as g, p_size as b, case when p_size % 4 = 0 then 0 when p_size % 4 = 1 then null else p_size * 4 end as a from part)
select col * 2 + dx as col, row * 2 + dy as row, cast(case when coalesce(a, 255) > 0 then r else 0 end as smallint) as r, cast(case when coalesce(a, 255) > 0 then g else 0 end as smallint) as g, cast(case when coalesce(a, 255) > 0 then b else 0 end as smallint) as b, coalesce(a, 255) > 0 as mask
from p, (values (0, 0), (1, 0), (0, 1), (1, 1)) o(dx, dy)""")
def ras10(spark, sf_dir):
    """Missing alpha is opaque, transparent pixels lose their colour, and a window is scaled up by two."""
    k, s = F.col("p_partkey"), F.col("p_size")
    alpha = F.when(s % 4 == 0, 0).when(s % 4 != 1, s * 4)
    p = inputs.table(spark, sf_dir, "part").select((k % 50).alias("col"), F.floor(k / 50).alias("row"), (s * 5).alias("r"), (s * 3).alias("g"), s.alias("b"), alpha.alias("a"))
    return rasters.scaled_up(rasters.masked_rgb(p), 2)


@query("ras11_raster_bounds", f"""select s_suppkey as id, 10.0e0 + s_suppkey as west, 50 - (2 + s_suppkey % 5) * 0.25e0 as south, 10.0e0 + s_suppkey + (3 + s_suppkey % 7) * 0.25e0 as east, 50.0e0 as north from supplier""")
def ras11(spark, sf_dir):
    k = F.col("s_suppkey")
    b = rasters.bounds_of(F.lit(0.25), 10.0 + k, F.lit(-0.25), F.lit(50.0), 3 + k % 7, 2 + k % 5)
    return inputs.table(spark, sf_dir, "supplier").select(k.alias("id"), b.alias("b")).select("id", "b.*")


@query("agg05_block_stats", f"""with {PX}, t as (select col // 16 as ix, row // 16 as iy, col, row, case when row % 11 = 3 then 'NaN'::float else v end as v from px where v is not null) select ix, iy, count(*) filter (not isnan(v)) as n_valid, min(v) filter (not isnan(v)) as min_v,
 max(v) filter (not isnan(v)) as max_v, count(*) filter (isnan(v)) as n_not_finite from t group by ix, iy""")
def agg05_blocks(spark, sf_dir):
    px = inputs.pixels(spark, sf_dir).withColumn("v", F.when(F.col("v").isNotNull() & (F.col("row") % 11 == 3), F.lit(float("nan")).cast("float")).otherwise(F.col("v")))
    s = blocks.block_stats(blocks.to_blocks(px, SIZE), [F.floor(F.col("bx") / 2).alias("ix"), F.floor(F.col("by") / 2).alias("iy")], SIZE)
    return s.drop("n_in_blocks").withColumns({c: F.col(c).cast("long") for c in ("n_valid", "n_not_finite")})


@query("src07_window_on_curve", f"with {PX} select col, row, v from px where col >= 11 and col < 30 and row >= 5 and row < 21 and v is not null")
def src07_curve(spark, sf_dir):
    """Blocks written along the Morton curve; a window read by ranges of it."""
    path, window = storage.scratch(spark, "curve"), (11, 5, 19, 16)
    stored.write_along_curve(_blocks(spark, sf_dir), path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    one = spark.createDataFrame([(0, *window)], "window_id int, col_min long, row_min long, width int, height int")
    return blocks.window_scan(stored.window_on_curve(spark, path, window, SIZE).drop("z"), one, SIZE).drop("window_id")
