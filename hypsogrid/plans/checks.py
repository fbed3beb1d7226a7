"""Integrity queries, joins and sets they rest on, and the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, catalogue, checks, polygons, rasters, storage, stored
from ..options import SamplerOptions
from ..streaming.sampling import sample_blocks, serve
from . import grids, inputs
from .blocks import FOUR, FOUR_JOINS, LERP, PT, PX, WIN, _blocks, _windows
from .polygons import EDGES, MEETS
from .registry import query

PART = "with d as (select p_partkey as k, p_partkey % 60 as ix, p_partkey // 60 as iy, p_size as s from part)"
NO_DATA = -9999.0


def _part(spark, sf_dir):
    k = F.col("p_partkey")
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), (k % 60).alias("ix"), F.floor(k / 60).alias("iy"), F.col("p_size").alias("s"))


def _facts(spark, sf_dir):
    s, span = F.col("s"), 16.0
    return _part(spark, sf_dir).select(
        "k", "ix", "iy", F.when(s == 1, "EPSG:4326").otherwise("EPSG:5514").alias("crs"), F.when(s == 2, "float64").otherwise("float32").alias("dtype"), F.when(s == 3, 3).otherwise(1).alias("bands"),
        F.when(s != 4, NO_DATA).alias("nodata"), F.lit(0.25).alias("a"), F.when(s == 5, 0.1).otherwise(0.0).alias("b"), (F.col("ix") * span + F.when(s == 6, 0.5).otherwise(1e-9)).alias("c"), F.lit(0.0).alias("d"),
        F.when(s == 7, -0.5).otherwise(-0.25).alias("e"), (100 - F.col("iy") * span).alias("f"), F.when(s == 8, 65).when(s == 9, 60).otherwise(64).alias("width"), F.lit(64).alias("height"), F.when(s == 10, 2).otherwise(0).alias("n_not_finite"))


def _tile_report(spark, sf_dir):
    return checks.tiles(_facts(spark, sf_dir), F.col("k"), "EPSG:5514", NO_DATA, 0.25, 0.0, 100.0, 64)


VAL03 = PART + """ select case s when 9 then 'warning' else 'error' end as severity, case s when 1 then 'crs' when 2 then 'dtype' when 3 then 'bands' when 4 then 'nodata' when 5 then 'north up' when 6 then 'origin' when 7 then 'resolution'
 when 8 then 'size' when 9 then 'clipped' else 'finite' end as "check", cast(k as varchar) as subject from d where s <= 10"""


@query("val03_tile_facts", VAL03)
def val03(spark, sf_dir):
    return _tile_report(spark, sf_dir).select("severity", "check", "subject")


@query("val04_plausible_heights", f"""with {PX}, s as (select col // 8 as ix, row // 8 as iy, count(v) as n, min(v) as lo, max(v) as hi from px group by 1, 2) select 'warning' as severity, case when n = 0 then 'empty' when lo = 0 and hi = 0 then 'zero' else 'range' end as "check", ix || ',' || iy as subject
 from s where n = 0 or lo < 920 or hi > 1900""")
def val04(spark, sf_dir):
    tiles = inputs.pixels(spark, sf_dir).withColumns({"ix": F.floor(F.col("col") / 8), "iy": F.floor(F.col("row") / 8)})
    return checks.plausibility(rasters.tile_stats(tiles, ["ix", "iy"]), F.concat_ws(",", "ix", "iy"), 920.0, 1900.0).drop("message")


RECORD = f"""{FOUR}, h as (select event_id, {LERP} as height from k {FOUR_JOINS}), r as (select event_id, height, case when event_id % 40 = 1 then null when event_id % 40 = 2 then height + 0.5e0 else height end as recorded from h)"""


def _recorded(spark, sf_dir):
    h = blocks.bilinear(inputs.points(spark, sf_dir), ["event_id"], _blocks(spark, sf_dir), 8)
    k = F.col("event_id") % 40
    return h.withColumn("recorded", F.when(k == 1, F.lit(None).cast("double")).when(k == 2, F.col("height") + 0.5).otherwise(F.col("height")))


@query("val07_test_points", f"with {RECORD} select case when recorded is null then 'missing' else 'value' end as \"check\", cast(event_id as varchar) as subject from r where height is not null and event_id % 40 in (1, 2)")
def val07(spark, sf_dir):
    """Recorded heights sampled again."""
    return checks.recomputed(_recorded(spark, sf_dir), F.col("event_id"), "recorded", "height").select("check", "subject")


@query("jn11_recorded_against_recomputed", f"with {RECORD} select event_id, abs(height - recorded) as diff from r where abs(height - recorded) > 1e-6")
def jn11(spark, sf_dir):
    r = _recorded(spark, sf_dir)
    now = r.select("event_id", "height").join(r.select("event_id", "recorded"), "event_id")
    return now.select("event_id", F.abs(F.col("height") - F.col("recorded")).alias("diff")).where(F.col("diff") > checks.POINT_TOLERANCE)


@query("val08_lattice_spots", f"""with {PX}, t as (select *, col // 8 as ix, row // 8 as iy from px), r as (select *, row_number() over (partition by ix, iy order by row, col) - 1 as i, count(*) over (partition by ix, iy) as n from t where v is not null),
q as (select distinct ix, iy, n, unnest(range(0, least(16, n))) as q from r), w as (select distinct ix, iy, case when least(16, n) = 1 then 0 else cast(floor(q * (n - 1) / cast(least(16, n) - 1 as double)) as bigint) end as i from q)
select count(*) as n, count(*) filter (col % 7 = 3) as n_bad from r join w using (ix, iy, i)""")
def val08(spark, sf_dir):
    """Spots of each tile against what the sampler gives there, as 32-bit heights; here every seventh column is off."""
    tiles = _blocks(spark, sf_dir).withColumns({"ix": F.col("bx"), "iy": F.col("by")})
    spots = blocks.spot_picks(tiles, 8)
    again = blocks.bilinear(spots.select("col", "row", F.col("col").cast("double").alias("u"), F.col("row").cast("double").alias("w")), ["col", "row"], blocks.to_blocks(
        inputs.pixels(spark, sf_dir).select("col", "row", "v"), 8), 8, "u", "w")
    # on a pixel's centre only that pixel counts; its neighbours may be missing, so it is read alone
    lone = blocks.pixel_at(spots.select("col", "row", "v", (F.col("col") + 0.5).alias("u"), (F.col("row") + 0.5).alias("w")), _blocks(spark, sf_dir), 8, "u", "w")
    both = lone.join(again.withColumnRenamed("height", "sampled"), ["col", "row"])
    stored = F.when(F.col("col") % 7 == 3, F.col("v") + 1).otherwise(F.col("v"))
    bad = stored.cast("float") != F.coalesce("sampled", "height").cast("float")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"))


COVER = f"{PX}, {WIN}, c as (select window_id, count(px.v) / cast(any_value(width * height) as double) as covered from w left join px on col >= c and col < c + width and row >= r and row < r + height group by window_id)"


def _covered(spark, sf_dir):
    w = _windows(spark, sf_dir)
    n = blocks.window_scan(_blocks(spark, sf_dir), w, 8).groupBy("window_id").agg(F.count("v").alias("n"))
    return w.join(n, "window_id", "left").select("window_id", (F.coalesce("n", F.lit(0)) / (F.col("width") * F.col("height"))).alias("covered"))


@query("agg06_window_coverage", f"with {COVER} select window_id, covered from c")
def agg06(spark, sf_dir):
    return _covered(spark, sf_dir)


@query("val09_low_coverage", f"with {COVER} select 'warning' as severity, cast(window_id as varchar) as subject from c where covered < 0.99")
def val09(spark, sf_dir):
    return checks.coverage(_covered(spark, sf_dir), F.col("window_id")).select("severity", "subject")


MASK = "m as (select p_partkey // 100 as tile, avg(case when p_size % 9 = 0 and p_partkey // 100 % 3 = 0 or p_partkey // 100 % 5 = 1 then 0.0e0 else 1.0e0 end) as covered from part group by 1)"


def _masks(spark, sf_dir):
    k = F.col("p_partkey")
    tile = F.floor(k / 100)
    seen = ~(((F.col("p_size") % 9 == 0) & (tile % 3 == 0)) | (tile % 5 == 1))
    return inputs.table(spark, sf_dir, "part").groupBy(tile.alias("tile")).agg(F.avg(seen.cast("int")).alias("covered"))


@query("agg07_mask_coverage", f"with {MASK} select tile, round(covered, 9) as covered from m")
def agg07(spark, sf_dir):
    return _masks(spark, sf_dir).select("tile", F.round("covered", 9).alias("covered"))


@query("val10_imagery_coverage", f"with {MASK} select case when covered = 0 then 'error' else 'warning' end as severity, cast(tile as varchar) as subject from m where covered < 0.99")
def val10(spark, sf_dir):
    return checks.coverage(_masks(spark, sf_dir), F.col("tile"), empty=checks.ERROR).select("severity", "subject")


@query("val11_catalogue", """with n as (select c_custkey // 6 as world, count(*) filter (c_acctbal > 0) as n from customer group by 1), l as (select distinct c_custkey // 6 as world, c_custkey % 17 as ix from customer), t as (select distinct s_suppkey % 13 as ix from supplier)
select 'vertices' as "check", cast(world as varchar) as subject from n where n < 3 union all select 'link', world || ',' || ix from l where ix not in (select ix from t)""")
def val11(spark, sf_dir):
    """Worlds of fewer than 3 vertices, and links to tiles that are not declared."""
    k = F.col("c_custkey")
    c = inputs.table(spark, sf_dir, "customer").select(F.floor(k / 6).alias("world"), (k % 17).alias("ix"), "c_acctbal")
    t = inputs.table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 13).alias("ix")).distinct()
    lone = c.select("world", "ix").distinct().join(t, "ix", "left_anti")
    return checks.catalogue_rules(catalogue.vertex_counts(c, c.where("c_acctbal > 0")), lone, F.concat_ws(",", "world", "ix")).select("check", "subject")


FILES = """f as (select case p_partkey % 5 when 0 then 'd/tile_' || p_partkey || '_1.tif' when 1 then 'd/tile_x.tif' when 2 then 'd/tile_' || p_partkey || '_2.tif.tmp' when 3 then 'd/tile_-' || p_partkey || '_3.tif' else 'd/notes.txt' end as path, p_partkey as k from part)"""


@query("val13_stray_files", f"""with {FILES} select 'stray' as "check", path as subject from f where k % 5 in (0, 3) and k % 2 = 1 union all select 'leftover', path from f where k % 5 = 2""")
def val13(spark, sf_dir):
    k = F.col("p_partkey")
    path = (F.when(k % 5 == 0, F.concat(F.lit("d/tile_"), k, F.lit("_1.tif"))).when(k % 5 == 1, "d/tile_x.tif").when(k % 5 == 2, F.concat(F.lit("d/tile_"), k, F.lit("_2.tif.tmp")))
            .when(k % 5 == 3, F.concat(F.lit("d/tile_-"), k, F.lit("_3.tif"))).otherwise("d/notes.txt"))
    f = inputs.table(spark, sf_dir, "part").select(path.alias("path"), k.alias("k"))
    return checks.stray(f, f.where("k % 2 = 0")).select("check", "subject")


@query("val12_whole_report", f"""with t as ({VAL03}), m as (select distinct p_partkey % 60 as ix, p_partkey // 60 as iy from part where p_size % 6 = 0)
select (select count(*) from t where severity = 'error') + (select count(*) from m) as n_errors, (select count(*) from t where severity = 'warning') as n_warnings, false as ok""")
def val12(spark, sf_dir):
    """The whole report of a dataset that has to be complete; here a sixth of its tiles is missing."""
    d = _part(spark, sf_dir)
    return checks.verdict(checks.extend(_tile_report(spark, sf_dir), checks.completeness(d, d.where("s % 6 <> 0"), ["ix", "iy"], True)))


@query("set05_joined_reports", f"with t as ({VAL03}) select severity, \"check\", count(*) as n from (select severity, \"check\" from t union all select severity, \"check\" from t where severity = 'warning') group by 1, 2")
def set05(spark, sf_dir):
    r = _tile_report(spark, sf_dir)
    return checks.extend(r, r.where("severity = 'warning'")).groupBy("severity", "check").agg(F.count(F.lit(1)).alias("n"))


BOUNDS = f"with {PX}, b as (select distinct col // 8 as ix, row // 8 as iy from px) "


@query("jn07_tile_neighbours", BOUNDS + "select a.ix, a.iy, 'east' as side from b a join b on b.ix = a.ix + 1 and b.iy = a.iy union all select a.ix, a.iy, 'south' from b a join b on b.ix = a.ix and b.iy = a.iy + 1")
def jn07(spark, sf_dir):
    ix, iy = F.col("ix"), F.col("iy")
    t = inputs.pixels(spark, sf_dir).select(F.floor(F.col("col") / 8).alias("ix"), F.floor(F.col("row") / 8).alias("iy")).distinct()
    t = t.select("ix", "iy", (ix * 2.0).alias("west"), (-iy * 2.0 - 2).alias("south"), (ix * 2.0 + 2).alias("east"), (-iy * 2.0).alias("north"))
    return rasters.neighbours(t).select("ix", "iy", "side")


@query("jn08_window_overlaps", f"""with {PX}, {WIN}, b as (select distinct col // 8 as bx, row // 8 as "by" from px where v is not null)
select window_id, b.bx, b."by" from w join b on bx * 8 < c + width and bx * 8 + 8 > c and b."by" * 8 < r + height and b."by" * 8 + 8 > r""")
def jn08(spark, sf_dir):
    """Blocks that a window overlaps, by equal keys."""
    return blocks.overlaps(_blocks(spark, sf_dir), _windows(spark, sf_dir), 8)


@query("win01_first_wins", "select name, k from (select p_type as name, p_partkey as k, row_number() over (partition by p_type order by p_size desc, p_partkey) as rn from part) where rn = 1")
def win01(spark, sf_dir):
    df = inputs.table(spark, sf_dir, "part").select(F.col("p_type").alias("name"), F.col("p_partkey").alias("k"), "p_size")
    return catalogue.first_wins(df, "name", F.struct((-F.col("p_size")).alias("s"), "k"), "k")


CROSS = f"""{EDGES}, {{b}}, q as (select b.box, ed.*, b.west, b.south, b.east, b.north, x0 - x1 as p1, x0 - west as q1, x1 - x0 as p2, east - x0 as q2, y0 - y1 as p3, y0 - south as q3, y1 - y0 as p4, north - y0 as q4 from b join ed on ed.world = b.box),
z as (select *, (p1 <> 0 or q1 >= 0) and (p2 <> 0 or q2 >= 0) and (p3 <> 0 or q3 >= 0) and (p4 <> 0 or q4 >= 0) and
 greatest(0, case when p1 < 0 then q1 / p1 else 0 end, case when p2 < 0 then q2 / p2 else 0 end, case when p3 < 0 then q3 / p3 else 0 end, case when p4 < 0 then q4 / p4 else 0 end)
 <= least(1, case when p1 > 0 then q1 / p1 else 1 end, case when p2 > 0 then q2 / p2 else 1 end, case when p3 > 0 then q3 / p3 else 1 end, case when p4 > 0 then q4 / p4 else 1 end) as meets,
 (y0 > (south + north) / 2) <> (y1 > (south + north) / 2) and (west + east) / 2 < (x1 - x0) * (((south + north) / 2 - y0) / nullif(y1 - y0, 0)) + x0 as crosses from q)""".replace(
    "{b}", "b as (select world as box, avg(x) - 2 as west, avg(y) - 1 as south, avg(x) + 1 as east, avg(y) + 2 as north from vx group by world)")


def _edges_and_boxes(spark, sf_dir):
    v = inputs.vertices(spark, sf_dir)
    b = v.groupBy("world").agg((F.avg("x") - 2).alias("west"), (F.avg("y") - 1).alias("south"), (F.avg("x") + 1).alias("east"), (F.avg("y") + 2).alias("north"))
    return v, b


@query("flt07_segment_meets_box", f"with {CROSS} select box, seq, meets from z")
def flt07(spark, sf_dir):
    v, b = _edges_and_boxes(spark, sf_dir)
    ends = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
    e = polygons.edges(v).join(b, "world")
    return e.select(F.col("world").alias("box"), "seq", polygons.segment_meets_box(*ends, {n: F.col(n) for n in grids.SIDES}).alias("meets"))


@query("flt08_point_in_polygon", f"with {CROSS} select box, count(*) filter (crosses) % 2 = 1 as inside from z group by box")
def flt08(spark, sf_dir):
    v, b = _edges_and_boxes(spark, sf_dir)
    p = b.select("world", ((F.col("west") + F.col("east")) / 2).alias("px"), ((F.col("south") + F.col("north")) / 2).alias("py"))
    return polygons.points_inside(v, p).select(F.col("world").alias("box"), "inside")


@query("flt09_polygon_meets_box", f"with {CROSS} select box from z group by box having bool_or(meets) or count(*) filter (crosses) % 2 = 1")
def flt09(spark, sf_dir):
    v, b = _edges_and_boxes(spark, sf_dir)
    return polygons.meets_boxes(v, b.withColumn("box", F.col("world"))).select("box")


@query("set02_tiles_of_skipped_worlds", f"with {MEETS} select ix, iy from m where world % 3 <> 1 except select ix, iy from m where world % 30 = 1")
def set02b(spark, sf_dir):
    from .polygons import _plan

    who = _plan(spark, sf_dir).groupBy("ix", "iy").agg(F.bool_or(F.col("world") % 3 != 1).alias("skipped"), F.bool_or(F.col("world") % 30 == 1).alias("kept"))
    return who.where("skipped and not kept").select("ix", "iy")


@query("jn09_tiles_missing_and_stray", """with d as (select distinct l_partkey % 997 as ix, l_suppkey % 7 as iy from lineitem where l_quantity > 49), p as (select distinct l_partkey % 997 as ix, l_suppkey % 7 as iy from lineitem where l_linenumber > 6)
select ix, iy, 'missing' as problem from (select * from d except select * from p) union all select ix, iy, 'stray' from (select * from p except select * from d)""")
def jn09c(spark, sf_dir):
    key = [(F.col("l_partkey") % 997).alias("ix"), (F.col("l_suppkey") % 7).alias("iy")]
    li = inputs.table(spark, sf_dir, "lineitem")
    return rasters.missing_and_stray(li.where("l_quantity > 49").select(*key), li.where("l_linenumber > 6").select(*key), ["ix", "iy"])


@query("win05_first_offending_pixel", f"with {PX}, t as (select *, col // 8 as ix, row // 8 as iy from px) select ix, iy, min_by(row, row * 1000 + col) as row, min_by(col, row * 1000 + col) as col, count(*) as n_bad from t where v > 905 and col % 3 = 1 group by ix, iy")
def win05b(spark, sf_dir):
    tiles = inputs.pixels(spark, sf_dir).withColumns({"ix": F.floor(F.col("col") / 8), "iy": F.floor(F.col("row") / 8)})
    return rasters.first_bad(tiles, ["ix", "iy"], (F.col("v") > 905) & (F.col("col") % 3 == 1))


@query("scl01_math", "select event_id, cast(floor(value / 3) as bigint) as f, cast(ceil(value / 3) as bigint) as c, ((event_id - 500) % 7 + 7) % 7 as m, round_even(event_id / 2.0e0, 0) as h, event_id + (event_id * 3 - event_id) * 0.25e0 as lerp from events")
def scl01(spark, sf_dir):
    k, v = F.col("event_id"), F.col("value")
    return inputs.table(spark, sf_dir, "events").select(
        k, F.floor(v / 3).alias("f"), F.ceil(v / 3).alias("c"), F.pmod(k - 500, F.lit(7)).alias("m"), F.bround(k / 2).alias("h"), (k + (k * 3 - k) * 0.25).alias("lerp"))


@query("scl02_strings", "select p_partkey, upper(trim('  ' || p_brand || ' ')) as u, replace(p_name, ' ', '_') as r, printf('%.6f', p_retailprice) as f, string_split(p_type, ' ')[1] as head from part")
def scl02(spark, sf_dir):
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey", F.upper(F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" ")))).alias("u"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("r"), F.format_string("%.6f", "p_retailprice").alias("f"), F.split("p_type", " ")[0].alias("head"))


@query("scl03_utc_times", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as utc from events")
def scl03(spark, sf_dir):
    return inputs.table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc"))


@query("scl04_arrays", "select vec_id, len(list_filter(embedding, lambda x: x > 0)) as n_positive, cast(list_min(embedding) as float) as low, embedding[1] as first, embedding[-1] as last from embeddings")
def scl04(spark, sf_dir):
    e = F.col("embedding")
    return inputs.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("n_positive"), F.array_min(e).alias("low"), F.element_at(e, 1).alias("first"), F.element_at(e, -1).alias("last"))


@query("scl05_maps", "select p_partkey, p_brand as brand, p_size % 2 = 0 as has_size, 1 + (p_size % 2 = 0)::int as n from part")
def scl05(spark, sf_dir):
    both = F.map_concat(F.create_map(F.lit("brand"), F.col("p_brand")), F.when(F.col("p_size") % 2 == 0, F.create_map(F.lit("size"), F.col("p_size").cast("string"))).otherwise(F.create_map().cast("map<string,string>")))
    df = inputs.table(spark, sf_dir, "part").select("p_partkey", both.alias("m"))
    return df.select("p_partkey", F.col("m")["brand"].alias("brand"), F.map_contains_key("m", "size").alias("has_size"), F.size("m").alias("n"))


@query("scl06_json", "select event_id, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' as doc, event_id * 2 as twice from events")
def scl06(spark, sf_dir):
    df = inputs.table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("doc"))
    return df.select("event_id", "doc", (F.from_json("doc", "id bigint")["id"] * 2).alias("twice"))


@query("scl07_hashes", "select s_suppkey, sha256(s_name) as sha, md5(s_name) as md5 from supplier")
def scl07(spark, sf_dir):
    return inputs.table(spark, sf_dir, "supplier").select("s_suppkey", F.sha2("s_name", 256).alias("sha"), F.md5("s_name").alias("md5"))


@query("scl08_casts", "select l_orderkey, l_linenumber, cast(l_extendedprice as float) as f, cast(trunc(l_extendedprice) as bigint) as i, cast(l_quantity as smallint) as s from lineitem")
def scl08(spark, sf_dir):
    p = F.col("l_extendedprice")
    return inputs.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", p.cast("float").alias("f"), p.cast("bigint").alias("i"), F.col("l_quantity").cast("smallint").alias("s"))


@query("snk02_atomic_replace", "select 'kept' as first_write, count(*) as n from part")
def snk02(spark, sf_dir):
    """A write that fails its validation, and one that may not overwrite, leave what is there; nothing staged stays."""
    path, p = storage.scratch(spark, "atomic"), inputs.table(spark, sf_dir, "part")
    storage.write_atomically(p, path)
    for overwrite in (True, False):
        try:
            storage.write_atomically(p.limit(5), path, overwrite, validate=lambda df: df.where("p_partkey >= 0"))
        except (ValueError, FileExistsError):
            continue
        raise AssertionError("a bad write went through")
    left = storage.clean(spark, path.rpartition("/")[0])
    return spark.read.parquet(path).agg(F.lit("kept" if not left else "left").alias("first_write"), F.count(F.lit(1)).alias("n"))


@query("src22_converted_file", f"with {PX} select col // 8 as bx, row // 8 as by, sum(cast(v as double) + 0.5e0) as total from px where v is not null group by 1, 2")
def src22(spark, sf_dir):
    """A stored raster is read, shifted and written; the copy is read again."""
    a, b = storage.scratch(spark, "from"), storage.scratch(spark, "to")
    storage.write_atomically(_blocks(spark, sf_dir), a)
    shifted = F.transform("values", lambda v: (v.cast("double") + 0.5).cast("float"))
    storage.write_atomically(spark.read.parquet(a).withColumn("values", shifted), b)
    v = blocks.pixels_of(spark.read.parquet(b), 8)
    # a 32-bit height and a half is no longer exact: it is taken back before the sum
    return v.groupBy(F.floor(F.col("col") / 8).alias("bx"), F.floor(F.col("row") / 8).alias("by")).agg(F.sum(F.col("v").cast("double")).alias("total"))


def _halo(spark, sf_dir):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stored.write_buckets(stored.with_halo(_blocks(spark, sf_dir), 8), storage.scratch(spark, "halo"), buckets)


@query("str02_request_answers", f"""with {FOUR}, h as (select event_id, {LERP} as height from k {FOUR_JOINS}), r as (select event_id // 16 as request_id, count(*) as n, count(*) filter (height is null) as n_unavailable from h group by 1)
select request_id, cast(event_id % 16 as int) as seq, height, height is not null as valid, cast(n_unavailable as int) as n_unavailable, true as success, case when n_unavailable = 0 then '' else n_unavailable || ' of ' || n || ' points have no height' end as message from h join r on r.request_id = event_id // 16""")
def str02(spark, sf_dir):
    """Requests of 16 points on a stream, each answered once by its heights in order, valid flags and a message."""
    size = inputs.table(spark, sf_dir, "part").agg(F.floor(F.max("p_partkey") / inputs.WIDTH) + 1).first()[0]
    events = inputs.table(spark, sf_dir, "events")
    last, k = events.agg(F.max("event_id")).first()[0], F.col("event_id")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet*").parquet(sf_dir)
    ids = F.floor(k / 16)
    rows = stream.select(ids.alias("request_id"), F.least(F.lit(16), last + 1 - ids * 16).cast("int").alias("n_points"), (k % 16).cast("int").alias("seq"), F.col("ts").cast("timestamp").alias("time"),
                         (F.pmod(k * 37, F.lit(8 * inputs.WIDTH)) / 8).alias("u"), (F.pmod(k * 101, F.lit(8 * size)) / 8).alias("v"))
    path = storage.scratch(spark, "answers")
    serve(rows, _halo(spark, sf_dir), 8, SamplerOptions(late="3650 days"), f"{path}-state").trigger(availableNow=True).format("parquet").start(path).awaitTermination()
    found = spark.read.parquet(path)
    each = found.select("request_id", F.posexplode(F.arrays_zip("heights", "valid")).alias("seq", "p"), "n_unavailable", "success", "message")
    return each.select("request_id", "seq", F.col("p.heights").alias("height"), F.col("p.valid").alias("valid"), "n_unavailable", "success", "message")


@query("str01_streamed_samples", f"with {FOUR} select event_id, {LERP} as height from k {FOUR_JOINS}")
def str01(spark, sf_dir):
    """The points as a stream, sampled until all there is has been read; equal to the batch."""
    n_rows = inputs.table(spark, sf_dir, "part").agg(F.floor(F.max("p_partkey") / inputs.WIDTH) + 1).first()[0]
    schema = inputs.table(spark, sf_dir, "events").schema
    k = F.col("event_id")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf_dir)
    points = stream.select(k, (F.pmod(k * 37, F.lit(8 * inputs.WIDTH)) / 8).alias("u"), (F.pmod(k * 101, F.lit(8 * n_rows)) / 8).alias("v"))
    path = storage.scratch(spark, "stream")
    sampled = sample_blocks(points, _halo(spark, sf_dir), 8).select("event_id", "height")
    sampled.writeStream.format("parquet").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path).awaitTermination()
    return spark.read.parquet(path)
