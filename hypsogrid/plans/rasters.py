"""Raster queries: masks, statistics, mosaics and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, checks, rasters, sampling
from . import inputs
from .registry import query

PX = f"px as ({inputs.PIXELS_SQL})"
TILE = "t as (select *, col // 8 as ix, row // 8 as iy from px)"


def _tiles(spark, sf_dir):
    return inputs.pixels(spark, sf_dir).withColumns({"ix": F.floor(F.col("col") / 8), "iy": F.floor(F.col("row") / 8)})


@query("ras03_nearest_pixel", f"""with {PX}, pt as ({inputs.POINTS_SQL}) select event_id, cast(px.v as double) as height
from (select event_id, cast(floor(u) as bigint) as c, cast(floor(v) as bigint) as r from pt) p left join px on px.col = c and px.row = r""")
def ras03(spark, sf_dir):
    """One join by block, not by pixel."""
    return blocks.pixel_at(inputs.points(spark, sf_dir), blocks.to_blocks(inputs.pixels(spark, sf_dir), 8), 8).select("event_id", "height")


@query("ras07_mosaic", f"""with {PX}, w as (select s_suppkey as window_id, s_suppkey * 3 % 45 as c, s_suppkey * 2 % 35 as r, 3 + s_suppkey % 9 as width, 2 + s_suppkey % 7 as height from supplier)
select window_id, col - c as col, row - r as row, v from px join w on col >= c and col < c + width and row >= r and row < r + height""")
def ras07(spark, sf_dir):
    k = F.col("s_suppkey")
    w = inputs.table(spark, sf_dir, "supplier").select(
        k.alias("window_id"), (k * 3 % 45).alias("col_min"), (k * 2 % 35).alias("row_min"), (3 + k % 9).alias("width"), (2 + k % 7).alias("height"))
    return rasters.mosaic(inputs.pixels(spark, sf_dir), w, 8)


@query("flt01_valid_mask", """select l_orderkey, l_linenumber, case when l_quantity not in (7, 11) and l_linenumber <> 3 then l_quantity end as v from lineitem""")
def flt01(spark, sf_dir):
    q = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double"))
    return inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", rasters.valid(q, 7.0, 11.0).alias("v"))


@query("agg05_tile_stats", f"""with {PX}, {TILE} select ix, iy, count(*) as n, count(v) as n_valid, min(v) as min_v, max(v) as max_v, (count(*) - count(v)) / count(*)::double as nodata_fraction from t group by ix, iy""")
def agg05(spark, sf_dir):
    return rasters.tile_stats(_tiles(spark, sf_dir), ["ix", "iy"])


@query("agg04_conversion_stats", f"""with {PX}, c as (select cast(v as double) as a, case when col % 5 <> 0 then v + col / 8.0e0 - 2 end as b from px)
select count(*) as total, count(a) as n_valid, count(b - a) as converted, min(b - a) as min_delta, max(b - a) as max_delta, max(abs(b - a)) as max_abs_delta from c""")
def agg04(spark, sf_dir):
    a = F.col("v").cast("double")
    df = inputs.pixels(spark, sf_dir).select(a.alias("a"), F.when(F.col("col") % 5 != 0, a + F.col("col") / 8 - 2).alias("b"))
    return rasters.conversion_stats(df, "a", "b")


@query("val04_plausibility", f"""with {PX}, {TILE}, s as (select ix, iy, count(v) as n, min(v) as lo, max(v) as hi from t group by ix, iy)
select ix, iy, case when n = 0 then 'no valid pixel' when lo = 0 and hi = 0 then 'all zero' when lo < 950 or hi > 1900 then 'implausible' end as warning from s
where n = 0 or (lo = 0 and hi = 0) or lo < 950 or hi > 1900""")
def val04(spark, sf_dir):
    s = rasters.tile_stats(_tiles(spark, sf_dir), ["ix", "iy"])
    warning = (F.when(F.col("n_valid") == 0, "no valid pixel").when((F.col("min_v") == 0) & (F.col("max_v") == 0), "all zero")
               .when((F.col("min_v") < 950) | (F.col("max_v") > 1900), "implausible"))
    return s.select("ix", "iy", warning.alias("warning")).where("warning is not null")


@query("win04_spot_picks", f"""with {PX}, {TILE}, r as (select *, row_number() over (partition by ix, iy order by row, col) - 1 as i, count(*) over (partition by ix, iy) as n from t where v is not null),
k as (select distinct ix, iy, n, unnest(range(0, least(16, n))) as k from r),
w as (select distinct ix, iy, case when least(16, n) = 1 then 0 else cast(floor(k * (n - 1) / cast(least(16, n) - 1 as double)) as bigint) end as i from k)
select col, row, v, ix, iy from r join w using (ix, iy, i)""")
def win04(spark, sf_dir):
    tiles = blocks.to_blocks(inputs.pixels(spark, sf_dir), 8).withColumns({"ix": F.col("bx"), "iy": F.col("by")})
    return blocks.spot_picks(tiles, 8)


@query("win05_first_bad_pixel", f"""with {PX}, {TILE} select ix, iy, min_by(row, row * 1000 + col) as row, min_by(col, row * 1000 + col) as col, count(*) as n_bad from t where v > 1500 group by ix, iy""")
def win05(spark, sf_dir):
    return rasters.first_bad(_tiles(spark, sf_dir), ["ix", "iy"], F.col("v") > 1500)


BOUNDS = """b as (select distinct ix, iy, ix * 16.0e0 as west, 100 - iy * 16.0e0 - 16 as south, ix * 16.0e0 + 16 + case when (ix + iy) % 4 = 0 then 0.5e0 else 0 end as east, 100 - iy * 16.0e0 as north from t)"""


@query("val05_tile_seams", f"""with {PX}, {TILE}, {BOUNDS} select a.ix, a.iy, 'east' as side, b.west - a.east as gap from b a join b on b.ix = a.ix + 1 and b.iy = a.iy where abs(b.west - a.east) > 1e-6
union all select a.ix, a.iy, 'south', a.south - b.north from b a join b on b.ix = a.ix and b.iy = a.iy + 1 where abs(a.south - b.north) > 1e-6""")
def val05(spark, sf_dir):
    ix, iy = F.col("ix"), F.col("iy")
    t = _tiles(spark, sf_dir).select("ix", "iy").distinct().select(
        "ix", "iy", (ix * 16.0).alias("west"), (100 - iy * 16.0 - 16).alias("south"),
        (ix * 16.0 + 16 + F.when((ix + iy) % 4 == 0, 0.5).otherwise(0.0)).alias("east"), (100 - iy * 16.0).alias("north"))
    return rasters.neighbours(t).where(F.abs("gap") > 1e-6)


@query("jn09_missing_and_stray", """with d as (select distinct l_partkey % 97 as ix, l_suppkey % 7 as iy from lineitem where l_quantity > 45), p as (select distinct l_partkey % 97 as ix, l_suppkey % 7 as iy from lineitem where l_linenumber > 5)
select ix, iy, 'missing' as problem from (select * from d except select * from p) union all select ix, iy, 'stray' from (select * from p except select * from d)""")
def jn09(spark, sf_dir):
    key = [(F.col("l_partkey") % 97).alias("ix"), (F.col("l_suppkey") % 7).alias("iy")]
    li = inputs.table(spark, sf_dir, "lineitem")
    return rasters.missing_and_stray(li.where("l_quantity > 45").select(*key), li.where("l_linenumber > 5").select(*key), ["ix", "iy"])


@query("agg15_unavailable_counts", f"""with h as (select event_id, u, v from ({inputs.POINTS_SQL})) select event_id % 16 as request, count(*) as n, count(*) filter (v > 30) as n_unavailable,
 case when count(*) filter (v > 30) = 0 then 'ok' else concat(count(*) filter (v > 30), ' of ', count(*), ' points have no height') end as message from h group by event_id % 16""")
def agg15(spark, sf_dir):
    sampled = inputs.points(spark, sf_dir).select((F.col("event_id") % 16).alias("request"), F.when(F.col("v") <= 30, F.col("v")).alias("height"))
    return checks.unavailable(sampled, ["request"])
