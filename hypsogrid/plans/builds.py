"""Queries on sources that are given to a build, on builds, and on what they leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import dataset
from ..operators import blocks, rasters, storage
from ..options import INTERPOLATIONS, PrepareOptions
from ..sources import requests
from ..sources.heights import BlockSource, FormulaImagery, read_in_pieces, usable_datum
from . import inputs
from .blocks import PX, WIN, _blocks, _windows
from .registry import query


@query("src18_source_in_pieces", f"with {PX}, {WIN} select window_id, col, row, v from px join w on col >= c and col < c + width and row >= r and row < r + height where v is not null")
def src18(spark, sf_dir):
    """A source that serves 3 pixels a side at once, read over larger windows."""
    return read_in_pieces(BlockSource(_blocks(spark, sf_dir), 8), _windows(spark, sf_dir), 3)


@query("src20_imagery_source", f"""with {WIN}, y as (select window_id, c, r, width, unnest(range(0, height)) + r as row from w), x as (select *, unnest(range(0, width)) + c as col from y)
select window_id, col, row, cast(col % 256 as smallint) as r, cast(row * 3 % 256 as smallint) as g, 128::smallint as b, case when (col + row) % 5 <> 0 then 255::smallint else 0::smallint end as a from x""")
def src20(spark, sf_dir):
    col, row = F.col("col"), F.col("row")
    source = FormulaImagery(col % 256, row * 3 % 256, F.lit(128), F.when((col + row) % 5 == 0, 0).otherwise(255))
    return source.read_rgba(_windows(spark, sf_dir))


@query("snk08_world_image", f"""with {PX}, {WIN}, c as (select window_id, w.c, w.r, width, unnest(range(0, height)) as row from w where window_id = 7), d as (select window_id, c, r, row, unnest(range(0, width)) as col from c)
select d.col, d.row, px.v from d left join px on px.col = d.c + d.col and px.row = d.r + d.row""")
def snk08(spark, sf_dir):
    """One world's heights over its whole window, written and read again."""
    w = _windows(spark, sf_dir).where("window_id = 7")
    path = storage.scratch(spark, "image")
    storage.write_atomically(blocks.fill_windows(blocks.window_scan(_blocks(spark, sf_dir), w, 8), w).drop("window_id"), path)
    return spark.read.parquet(path)


@query("snk10_leftovers", "select 2 as n_removed, count(*) as n_kept from part")
def snk10(spark, sf_dir):
    """What two broken writes left beside a dataset is removed, the dataset stays."""
    folder, p = storage.scratch(spark, "folder"), inputs.table(spark, sf_dir, "part")
    for name in ("set", "set.tmp-1", "other.tmp-2"):
        p.write.parquet(f"{folder}/{name}")
    n = storage.clean(spark, folder)
    return spark.read.parquet(f"{folder}/set").agg(F.lit(n).alias("n_removed"), F.count(F.lit(1)).alias("n_kept"))


@query("prj29_provenance", "select s_suppkey as k, 'source-' || s_suppkey % 3 as source_id, 'EPSG:4979' as vertical_crs, 4 as n, true as has_versions from supplier")
def prj29(spark, sf_dir):
    """Each tile's tags: what it was made of and by which versions; versions differ by installation, so they are only there."""
    k = F.col("s_suppkey")
    t = inputs.table(spark, sf_dir, "supplier").select(k.alias("k"), rasters.provenance(spark, {"source_id": F.concat(F.lit("source-"), (k % 3).cast("string")), "vertical_crs": "EPSG:4979"}).alias("t"))
    versions = (F.col("t")["spark_version"] == spark.version) & F.col("t")["python_version"].rlike("^3[.]")
    return t.select("k", F.col("t")["source_id"].alias("source_id"), F.col("t")["vertical_crs"].alias("vertical_crs"), F.size("t").alias("n"), versions.alias("has_versions"))


@query("flt17_source_datum", "select p_partkey as k, p_size % 3 = 0 as usable from part")
def flt17(spark, sf_dir):
    """A build takes heights on the datum that it expects only; an unknown one (here of every fourth size) is not it."""
    datum = F.when(F.col("p_size") % 3 == 0, "egm96").when(F.col("p_size") % 4 != 0, "wgs84-ellipsoid")
    return inputs.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), usable_datum(datum, "egm96").alias("usable"))


@query("udf05_interpolations", """select s_suppkey as k, case s_suppkey % 4 when 0 then 'RSP_NearestNeighbor' when 1 then 'RSP_BilinearInterpolation' when 2 then 'RSP_CubicConvolution' end as rule from supplier""")
def udf05(spark, sf_dir):
    """The server's names of ways to interpolate, none for one that is not known."""
    k = F.col("s_suppkey")
    name = F.get(F.array(*(F.lit(n) for n in (*INTERPOLATIONS, "spline"))), (k % 4).cast("int"))
    return inputs.table(spark, sf_dir, "supplier").select(k.alias("k"), requests.interpolation(name).alias("rule"))


@query("udf03_prepared_dataset")
def udf03(spark, sf_dir):
    """A whole build from an injected source: worlds of three vertices over the raster of 6 km pixels. Its plan rests on
    the projection of each vertex and ends in files, so it is held against a plane in the tests instead of SQL."""
    k = F.col("s_suppkey")
    lon, lat = 12.5 + k % 25 / 10, 49 + k % 11 / 10
    corner = lambda a, b: F.struct((lon + a).alias("lon"), (lat + b).alias("lat"))
    worlds = inputs.table(spark, sf_dir, "supplier").select(F.concat(F.lit("w"), k.cast("string")).alias("name"), F.array(corner(0, 0), corner(0.2, 0), corner(0.1, 0.15)).alias("points"))
    options = PrepareOptions(resolution=6000.0, tile_px=8, block_px=8, origin_x=-905_000.0, origin_y=-930_000.0, datum="egm96", rgb_resolution_m=1000.0, wgs_tile_px=64)
    made = dataset.prepare(worlds, storage.scratch(spark, "built"), options, BlockSource(_blocks(spark, sf_dir), 8))
    return made.kept.withColumn("action", F.lit("written")).unionByName(made.skipped.select("world", F.lit("skipped").alias("action")))
