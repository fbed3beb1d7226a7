"""Queries on world files, manifests and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rasters
from ..sources import manifest, requests, worlds
from . import inputs
from .registry import query

K = "s_suppkey"
#: Documents of every kind, seven in turn, and what each is good for.
KINDS = """with d as (select s_suppkey as k, 'world_' || case when s_suppkey % 11 = 0 then 'twin' else 'w' || s_suppkey end as name, s_suppkey % 7 as kind from supplier),
r as (select *, substring(name, 7) as short, case kind when 0 then 'not a YAML document' when 1 then 'frame is not latlon_origin' when 2 then 'points are not whole pairs' when 3 then 'a point is not a number' when 4 then 'a vertex is out of range' end as why from d),
j as (select *, case when why is null and row_number() over (partition by short, why is null order by k) > 1 then 'the name is taken' else why end as reason from r)"""


def _documents(spark, sf_dir):
    k = F.col(K)
    lat = (k % 80).cast("double")
    points = F.concat_ws(", ", lat, k % 170, lat + 1, k % 170, lat + 1, F.when(k % 7 == 4, 190.0).otherwise(k % 170 + 0.5))
    points = F.when(k % 7 == 2, F.concat(points, F.lit(", 3"))).when(k % 7 == 3, F.concat(points, F.lit(", x, true"))).otherwise(points)
    frame = F.when(k % 7 == 1, "local_origin").otherwise("latlon_origin")
    text = F.concat(F.lit("mrs_uav_managers:\n  world_origin: {units: latlon, origin_x: "), lat, F.lit(", origin_y: north}\n  safety_area_manager:\n    safety_area:\n      enabled: true\n      horizontal: {frame_name: "),
                    frame, F.lit(", points: ["), points, F.lit("]}\n      vertical: {frame_name: world_origin, min_z: "), k % 5, F.lit(", max_z: .inf}\n"))
    name = F.when(k % 11 == 0, "twin").otherwise(F.concat(F.lit("w"), k.cast("string")))
    return inputs.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/in/world_"), name, F.lit(".yaml")).alias("path"), k.alias("position"), F.when(k % 7 == 0, F.lit("a: [1, 2")).otherwise(text).alias("text"))


@query("src01_world_files", KINDS + " select k as position, short as name, 3 as n_vertices, k % 170 * 1.0e0 as lon, k % 80 * 1.0e0 as lat, k % 5 * 1.0e0 as min_z, cast(null as double) as max_z, false as has_origin from j where reason is null")
def src01(spark, sf_dir):
    w = worlds.load(_documents(spark, sf_dir))[0]
    return w.select("position", "name", F.size("points").alias("n_vertices"), F.col("points")[0]["lon"].alias("lon"), F.col("points")[0]["lat"].alias("lat"), "min_z", "max_z", F.col("origin").isNotNull().alias("has_origin"))


@query("src03_skipped_worlds", KINDS + " select k as position, reason from j where reason is not null")
def src03b(spark, sf_dir):
    return worlds.load(_documents(spark, sf_dir))[1].select("position", "reason")


@query("flt10_frame_filter", KINDS + " select k as position from d where kind > 1")
def flt10(spark, sf_dir):
    return worlds.parse(_documents(spark, sf_dir)).where(F.col("parsed.frame") == worlds.FRAME).select("position")


PATHS = "with p as (select p_partkey as position, '/d' || p_size || '/w' || p_partkey || case p_partkey % 4 when 0 then '.yaml' when 1 then '.YML' when 2 then '.yml.bak' else '.txt' end as path, p_size % 2 = 0 as dir from part)"


@query("src02_world_paths", PATHS + ", q as (select path, case when dir then 0 else position end as place from p where position % 4 < 2) select path, place, row_number() over (partition by place order by path) as nth from q")
def src02(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    end = F.when(k % 4 == 0, ".yaml").when(k % 4 == 1, ".YML").when(k % 4 == 2, ".yml.bak").otherwise(".txt")
    listing = inputs.table(spark, sf_dir, "part").select(F.concat(F.lit("/d"), s, F.lit("/w"), k, end).alias("path"), k.alias("position"), (s % 2 == 0).alias("from_directory"))
    found = worlds.discover(listing)
    nth = F.row_number().over(inputs.Window.partitionBy("place.position").orderBy("place.path")).cast("long")
    return found.select("path", F.col("place.position").alias("place"), nth.alias("nth"))


@query("prj25_latlon_pairs", """with p as (select c_custkey as k, c_custkey % 5 as kind from customer) select k, case kind when 1 then 'fewer than 3 vertices' when 2 then 'a point is not a number' when 3 then 'a point is not finite' end as reason,
 case when kind in (0, 4) then k % 100 * 1.0e0 end as lon, case when kind in (0, 4) then k % 50 * 1.0e0 end as lat from p""")
def prj25(spark, sf_dir):
    k = F.col("c_custkey")
    tail = F.when(k % 5 == 1, F.array()).when(k % 5 == 2, F.array(F.lit("true"), F.lit("1"))).when(k % 5 == 3, F.array(F.lit("NaN"), F.lit("1"))).otherwise(F.array(F.lit("1"), F.lit("2e0")))
    points = F.concat(F.array((k % 50).cast("string"), (k % 100).cast("string"), F.lit("3"), F.lit("-4.5")), tail)
    df = inputs.table(spark, sf_dir, "customer").select(k.alias("k"), points.alias("p"))
    reason, first = worlds.points_problem(F.lit(True), F.col("p")), worlds.lonlat_pairs(F.col("p"))[0]
    df = df.select("k", reason.alias("reason"), first.alias("f"))
    return df.select("k", "reason", *(F.when(F.col("reason").isNull(), F.col(f"f.{c}")).alias(c) for c in ("lon", "lat")))


@query("prj26_origins", """with p as (select p_partkey as k, p_partkey % 6 as kind from part) select k, case when kind in (0, 1) then case kind when 0 then 'LATLON' else 'UTM' end end as units, case when kind < 2 then k % 90 * 1.0e0 end as x, case when kind < 2 then k % 180 * 1.0e0 end as y from p""")
def prj26(spark, sf_dir):
    """Usable, UTM, unknown units, text for a number, a boolean, and a latitude out of range."""
    k = F.col("p_partkey")
    kind = k % 6
    units = F.when(kind == 1, "utm").when(kind == 2, "MILES").otherwise(" latlon ")
    x = F.when(kind == 3, '"7"').when(kind == 4, "true").when(kind == 5, "91").otherwise((k % 90).cast("string"))
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), worlds.origin(units, x, (k % 180).cast("string")).alias("o")).select("k", "o.*")


MANIFESTS = "with d as (select p_partkey as k, p_partkey % 9 as kind, p_size as s from part)"


def _manifests(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    kind = k % 9
    word = lambda n, bad, good: F.when(kind == n, F.lit(bad)).otherwise(F.lit(good))
    text = F.concat(
        F.lit('{"format_version": '), word(1, "3", "2"), F.lit(', "status": "'), word(2, "building", "complete"), F.lit('", "unknown": [1], "heightmap": {"horizontal_crs": "EPSG:5514", "vertical_crs": "EPSG:5773", "unit": "'),
        word(3, "ft", "m"), F.lit('", "dtype": "float32", "nodata": -9999}, "grid": {"origin_x": '), k, F.lit('.5, "origin_y": 0, "resolution_x": '), word(4, "0", "2"), F.lit(', "resolution_y": 2, "tile_width_px": '), s,
        F.lit(', "tile_height_px": 64, "axis_order": "'), word(5, "north_east", "east_north"), F.lit('"}, "storage": {"tile_pattern": "'), word(6, "../{ix}_{iy}.tif", "t_{ix}_{iy}.tif"),
        F.lit('", "block_width_px": 8, "block_height_px": 8}, "tiles": [{"ix": 1, "iy": 2}, {"ix": '), s, F.lit(', "iy": 3}], "worlds": ["a"], "wgs": {"crs": "EPSG:4326", "resolution_m": 1, "resolution_deg": 1e-5, "height_pattern": "'),
        word(7, "t_{ix}_{iy}.tif", "h_{ix}_{iy}.tif"), F.lit('"}}'))
    return manifest.read(inputs.table(spark, sf_dir, "part").select(k.alias("k"), F.when(kind == 8, F.lit("[")).otherwise(text).alias("text")))


@query("src05_manifest_scan", MANIFESTS + " select k, case kind when 1 then 3 else 2 end as format_version, k + 0.5e0 as origin_x, s as tile_width_px, 2 as n_tiles from d where kind < 8")
def src05(spark, sf_dir):
    df = _manifests(spark, sf_dir).where("m is not null and m.grid is not null")
    return df.select("k", "m.format_version", "m.grid.origin_x", "m.grid.tile_width_px", F.size("m.tiles").alias("n_tiles"))


@query("src06_strict_manifests", MANIFESTS + " select k, case kind when 1 then 'unsupported version' when 2 then 'not complete' when 4 then 'sizes' when 5 then 'axis order' when 6 then 'pattern' when 8 then 'unsupported version' end as problem from d")
def src06(spark, sf_dir):
    return _manifests(spark, sf_dir).select("k", manifest.strict_problem(F.col("m")).alias("problem"))


@query("snk05_manifest_write", MANIFESTS + """ select k, case kind when 1 then 3 else 2 end as format_version, '2024-05-06T07:08:09Z' as updated_utc, s::bigint as last_ix from d where kind < 8""")
def snk05(spark, sf_dir):
    """Written with a new time and read again."""
    df = _manifests(spark, sf_dir).where("k % 9 < 8")
    out = manifest.read(manifest.write(df, F.lit("2024-05-06T07:08:09Z")).select("k", "document"), "document")
    return out.select("k", "m.format_version", "m.updated_utc", F.element_at("m.tiles", -1)["ix"].alias("last_ix"))


@query("val01_manifest_checks", MANIFESTS + """ select k, 'error' as severity, case kind when 1 then 'version' when 3 then 'unit' when 4 then 'resolution' when 5 then 'axis order' when 6 then 'pattern' when 7 then 'unique patterns' end as "check" from d where kind in (1, 3, 4, 5, 6, 7)""")
def val01(spark, sf_dir):
    df = _manifests(spark, sf_dir).where("k % 9 < 8")
    return df.select("k", F.explode(manifest.problems(F.col("m"))).alias("p")).select("k", F.lit("error").alias("severity"), "p.check")


@query("set04_unique_patterns", MANIFESTS + " select k, kind = 7 as clash from d where kind < 8")
def set04(spark, sf_dir):
    names = F.filter(F.array("m.storage.tile_pattern", "m.wgs.height_pattern", "m.wgs.rgb_pattern"), lambda p: p.isNotNull())
    return _manifests(spark, sf_dir).where("k % 9 < 8").select("k", (F.size(names) != F.size(F.array_distinct(names))).alias("clash"))


@query("val02_patterns", """select p_partkey as k, case p_partkey % 5 when 1 then 'lacks an index' when 2 then 'malformed' when 3 then 'leaves the dataset' when 4 then 'leaves the dataset' end as problem from part""")
def val02(spark, sf_dir):
    k = F.col("p_partkey")
    p = F.when(k % 5 == 1, "t_{ix}.tif").when(k % 5 == 2, "t_{ix}_{iy}_{k}.tif").when(k % 5 == 3, "/t/{ix}_{iy}.tif").when(k % 5 == 4, "a/../{ix}_{iy}.tif").otherwise("a/t_{ix}_{iy}.tif")
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), manifest.pattern_problem(p).alias("problem"))


@query("prj27_epsg_codes", """select p_partkey as k, case p_partkey % 4 when 0 then 5000 + p_size when 1 then 4326 when 2 then p_size end as code from part""")
def prj27(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    crs = (F.when(k % 4 == 0, F.concat(F.lit("EPSG:"), 5000 + s)).when(k % 4 == 1, 'GEOGCS["x",AUTHORITY["EPSG","7030"],AUTHORITY["EPSG","4326"]]')
           .when(k % 4 == 2, F.concat(F.lit('PROJCRS["y",ID["EPSG",'), s, F.lit("]]"))).otherwise("LOCAL_CS"))
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), manifest.epsg_of(crs).alias("code"))


@query("src10_test_points", """select event_id as line_no, case when event_id % 10 not in (3, 4) then 48 + event_id % 16 / 8.0e0 end as lat, case when event_id % 10 not in (3, 4) then 12 + event_id % 32 / 16.0e0 end as lon, case when event_id % 10 not in (3, 4) then event_id % 64 / 4.0e0 end as height,
 case event_id % 10 when 3 then 'not three fields' when 4 then 'not a number' end as problem from events where event_id % 10 <> 5""")
def src10(spark, sf_dir):
    k = F.col("event_id")
    line = F.concat_ws(",", 48 + k % 16 / 8, 12 + k % 32 / 16, k % 64 / 4)
    line = F.when(k % 10 == 3, F.concat(line, F.lit(",1"))).when(k % 10 == 4, "48,east,3").when(k % 10 == 5, "  ").otherwise(line)
    return rasters.parse_points(inputs.table(spark, sf_dir, "events").select(k.alias("line_no"), line.alias("line")))


BOXED = f"with b as ({inputs.BOXES_SQL})"


@query("src13_elevation_requests", BOXED + """ select box, printf('%.6f,%.6f,%.6f,%.6f', west, south, east, north) as bbox, cast(box % 7 + 2 as varchar) || ',' || cast(box % 5 + 2 as varchar) as size, '-9999' as nodata, 'RSP_BilinearInterpolation' as interpolation, 9 as n from b""")
def src13(spark, sf_dir):
    p = requests.elevation_parameters(*(F.col(c) for c in ("west", "south", "east", "north")), F.col("box") % 7 + 2, F.col("box") % 5 + 2, 5514, -9999.0)
    return inputs.boxes(spark, sf_dir).select("box", p.alias("p")).select("box", *(F.col("p")[a].alias(b) for a, b in (("bbox", "bbox"), ("size", "size"), ("noData", "nodata"), ("interpolation", "interpolation"))), F.size("p").alias("n"))


@query("src14_decode_checks", """select p_partkey as k, case when p_size % 6 = 1 then 'bands' when p_size % 6 = 2 then 'size' when p_size % 6 = 3 then 'crs' when p_size % 6 = 4 then 'pixel size' when p_size % 6 = 5 then 'origin' end as problem from part""")
def src14(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size") % 6
    w = k % 100 + 1
    problem = requests.decode_problem(F.when(n == 1, 3).otherwise(1), F.when(n == 2, w + 1).otherwise(w), F.lit(64), F.when(n != 3, 5514), F.when(n == 4, 2.1).otherwise(2.0), k + F.when((n == 5) & (k % 2 == 0), 1.5).otherwise(0.5), -k + F.when((n == 5) & (k % 2 == 1), -1.5).otherwise(0.5), w, F.lit(64), 5514, 2.0, k.cast("double"), -k.cast("double"))
    return inputs.table(spark, sf_dir, "part").select(k.alias("k"), problem.alias("problem"))


@query("src15_render_replies", BOXED + """ select box, case box % 6 when 1 then 'no link' when 2 then 'size' when 3 then 'extent' when 4 then 'crs' when 5 then 'refused' end as problem from b""")
def src15(spark, sf_dir):
    n, sides = F.col("box") % 6, [F.col(c) for c in ("west", "south", "east", "north")]
    reply = F.to_json(F.struct(F.when(n != 1, "http://x/y.png").alias("href"), F.when(n == 2, 9).otherwise(8).alias("width"), F.lit(8).alias("height"),
                               F.struct((sides[0] + F.when(n == 3, 0.5).otherwise(0.001)).alias("xmin"), sides[1].alias("ymin"), sides[2].alias("xmax"), sides[3].alias("ymax"),
               F.struct(F.when(n == 4, 5514).otherwise(4326).alias("wkid")).alias("spatialReference")).alias("extent"), F.when(n == 5, "busy").alias("error")))
    return inputs.boxes(spark, sf_dir).select("box", requests.extent_problem(reply, F.lit(8), F.lit(8), *sides).alias("problem"))


@query("src16_retries", """select event_id as k, case when event_id % 4 + 1 < 3 and (event_id % 5 = 0 or event_id % 5 = 2 or event_id % 5 = 3) then 0.5e0 * 2 ** (event_id % 4) end as wait_s from events""")
def src16(spark, sf_dir):
    k = F.col("event_id")
    status = F.when(k % 5 == 1, 200).when(k % 5 == 2, 503).when(k % 5 == 3, 429).when(k % 5 == 4, 404)
    return inputs.table(spark, sf_dir, "events").select(k.alias("k"), requests.retry(status, k % 4 + 1, 3, 0.5).alias("wait_s"))


@query("src17_cache_keys", """select s_suppkey as k, sha256('{"params":{"bbox":"' || s_suppkey || ',2","f":"image","size":"8,8"},"url":"http://x/' || s_suppkey % 3 || '"}') as key from supplier""")
def src17(spark, sf_dir):
    k = F.col(K)
    p = F.create_map(F.lit("size"), F.lit("8,8"), F.lit("f"), F.lit("image"), F.lit("bbox"), F.concat(k.cast("string"), F.lit(",2")))
    return inputs.table(spark, sf_dir, "supplier").select(k.alias("k"), requests.cache_key(F.concat(F.lit("http://x/"), (k % 3).cast("string")), p).alias("key"))


@query("prj28_checksums", "select p_partkey as k, md5(p_name) as md5, sha256(p_name) as sha256 from part")
def prj28(spark, sf_dir):
    content = F.encode("p_name", "UTF-8")
    return inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.md5(content).alias("md5"), F.sha2(content, 256).alias("sha256"))


@query("src21_tags", "select p_partkey as k, case when p_size % 3 = 0 then p_brand end as source, case when p_size % 3 = 0 then 2 else 0 end as n from part")
def src21(spark, sf_dir):
    """A tile's tags; those that cannot be read are none."""
    tags = F.when(F.col("p_size") % 3 == 0, F.create_map(F.lit("source"), F.col("p_brand"), F.lit("unit"), F.lit("m")))
    df = inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), rasters.tags_or_none(tags).alias("t"))
    return df.select("k", F.try_element_at("t", F.lit("source")).alias("source"), F.size("t").alias("n"))
