"""Queries on catalogues, vertical datums and what is written."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, catalogue, checks, rasters, storage
from . import inputs
from .registry import query

V, PX = f"v as ({inputs.VERTICES_SQL})", f"px as ({inputs.PIXELS_SQL})"
TILES = "t as (select distinct s_suppkey % 13 as ix, s_suppkey % 7 as iy from supplier), l as (select distinct c_custkey // 6 as world, c_custkey % 17 as ix, c_custkey % 8 as iy from customer)"


def _vertices(spark, sf_dir):
    return inputs.vertices(spark, sf_dir)


def _tiles(spark, sf_dir):
    k = F.col("s_suppkey")
    return inputs.table(spark, sf_dir, "supplier").select((k % 13).alias("ix"), (k % 7).alias("iy")).distinct()


def _links(spark, sf_dir):
    k = F.col("c_custkey")
    return catalogue.links(inputs.table(spark, sf_dir, "customer").select(F.floor(k / 6).alias("world"), (k % 17).alias("ix"), (k % 8).alias("iy")))


@query("src11_one_world", f"with {V} select seq, x as lon, y as lat from v where world = 3")
def src11(spark, sf_dir):
    """The vertices of one world of the catalogue, in order."""
    return _vertices(spark, sf_dir).where("world = 3").select("seq", F.col("x").alias("lon"), F.col("y").alias("lat")).orderBy("seq")


@query("win03_vertex_numbers", f"with {V} select world, cast(row_number() over (partition by world order by seq) - 1 as int) as seq, y as lat, x as lon from v")
def win03(spark, sf_dir):
    w = _vertices(spark, sf_dir).groupBy(F.col("world").alias("name")).agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "x", "y"))), lambda s: F.struct(s["y"].alias("lat"), s["x"].alias("lon"))).alias("points"))
    return catalogue.vertices_of(w)


@query("srt04_vertex_order", f"with {V} select world, string_agg(cast(x as varchar), ' ' order by seq) as xs from v group by world")
def srt04(spark, sf_dir):
    v = _vertices(spark, sf_dir).groupBy("world").agg(F.sort_array(F.collect_list(F.struct("seq", "x"))).alias("v"))
    return v.select("world", F.array_join(F.transform("v", lambda s: s["x"].cast("string")), " ").alias("xs"))


@query("srt03_name_order", "with n as (select distinct p_brand as name from part) select name, row_number() over (order by name) as nth from n")
def srt03(spark, sf_dir):
    """A dataset's world names in order; they are the rows of one catalogue."""
    names = inputs.table(spark, sf_dir, "part").select(F.col("p_brand").alias("name")).distinct()
    return names.agg(F.sort_array(F.collect_set("name")).alias("n")).select(F.posexplode("n").alias("at", "name")).select("name", (F.col("at") + 1).cast("long").alias("nth"))


@query("srt05_preferred", "select p_brand as datum, min_by(p_partkey, (p_size % 2) * 1000000 + p_partkey) as operation from part where p_size % 3 <> 0 group by p_brand")
def srt05(spark, sf_dir):
    df = inputs.table(spark, sf_dir, "part").where("p_size % 3 <> 0").select(F.col("p_brand").alias("datum"), F.col("p_partkey").alias("operation"), "p_size")
    return catalogue.preferred(df, "datum", F.col("p_size") % 2, "operation")


@query("jn05_world_tiles", f"with {TILES} select world, ix, iy, ix * 2.0e0 as west, 90 - iy * 2.0e0 as north from l join t using (ix, iy)")
def jn05(spark, sf_dir):
    t = _tiles(spark, sf_dir).select("ix", "iy", (F.col("ix") * 2.0).alias("west"), (90 - F.col("iy") * 2.0).alias("north"))
    return catalogue.tiles_of(_links(spark, sf_dir), t).select("world", "ix", "iy", "west", "north")


@query("jn12_catalogue_against_manifest", f"with {TILES}, m as (select distinct ix, iy from l) select coalesce(t.ix, m.ix) as ix, coalesce(t.iy, m.iy) as iy, case when m.ix is null then 'left' else 'right' end as only_in from t full join m on t.ix = m.ix and t.iy = m.iy where t.ix is null or m.ix is null")
def jn12(spark, sf_dir):
    return catalogue.differences(_tiles(spark, sf_dir), _links(spark, sf_dir), ["ix", "iy"])


@query("jn09_links_to_undeclared", f"with {TILES} select world, ix, iy from l where (ix, iy) not in (select (ix, iy) from t)")
def jn09b(spark, sf_dir):
    return catalogue.undeclared(_links(spark, sf_dir), _tiles(spark, sf_dir)).select("world", "ix", "iy")


@query("set03_set_equality", f"with {TILES}, m as (select distinct world % 9 as part, ix, iy from l), a as (select part, ix, iy from m where ix < 15), d as (select part from m except select part from a union all select part from (select * from m except select * from a)) select part, part not in (select part from d) as equal from (select distinct part from m)")
def set03(spark, sf_dir):
    """For each part of a catalogue whether its links and those of the manifest (here: without the last columns) are one set."""
    m = _links(spark, sf_dir).select((F.col("world") % 9).alias("part"), "ix", "iy").distinct()
    off = catalogue.differences(m, m.where("ix < 15"), ["part", "ix", "iy"]).select("part").distinct()
    return m.select("part").distinct().join(off.withColumn("off", F.lit(True)), "part", "left").select("part", F.col("off").isNull().alias("equal"))


@query("set06_both", f"with {TILES} select ix, iy from t intersect select ix, iy from l")
def set06(spark, sf_dir):
    return catalogue.both(_tiles(spark, sf_dir), _links(spark, sf_dir), ["ix", "iy"])


@query("flt12_complete_worlds", f"with {V} select world from v group by world having count(*) filter (x > 60) = 0")
def flt12(spark, sf_dir):
    """Worlds all of whose corners have a height; here those east of 60 have none."""
    return catalogue.complete_worlds(_vertices(spark, sf_dir).select("world", F.when(F.col("x") <= 60, F.col("y")).alias("height")))


@query("flt13_reusable_tiles", "select p_partkey as k, case when p_size % 5 = 1 then 'tags differ' when p_size % 5 = 2 then 'not filled' when p_size % 5 = 3 then 'not valid' end as why, p_size % 5 in (0, 4) as reuse from part")
def flt13(spark, sf_dir):
    n = F.col("p_size") % 5
    tags = lambda unit, version: F.create_map(F.lit("unit"), unit, F.lit("package_version"), F.lit(version))
    rng = lambda c1: F.struct(F.lit(1).alias("col_min"), F.lit(2).alias("row_min"), c1.alias("col_max"), F.lit(9).alias("row_max"))
    t = inputs.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), tags(F.when(n == 1, "ft").otherwise("m"), "1").alias("tags"), tags(F.lit("m"), "2").alias("wanted_tags"),
        rng(F.when(n == 2, 6).otherwise(8)).alias("filled"), rng(F.lit(7)).alias("need"), (n != 3).alias("valid"))
    return catalogue.reusable(t).select("k", "why", "reuse")


@query("snk09_unneeded_tiles", f"with {TILES} select ix, iy from t except select ix, iy from l where world % 40 = 1")
def snk09(spark, sf_dir):
    """Tiles that only skipped worlds needed."""
    return catalogue.unneeded(_tiles(spark, sf_dir), _links(spark, sf_dir).where("world % 40 = 1"))


@query("agg14_outcomes", "select l_shipmode, count(*) filter (l_quantity > 25) as written, count(*) filter (l_quantity <= 25) as reused, count(*) filter (l_tax = 0) as cache_hits from lineitem group by l_shipmode".replace("l_shipmode", "l_returnflag"))
def agg14(spark, sf_dir):
    tiles = inputs.table(spark, sf_dir, "lineitem").select("l_returnflag", F.when(F.col("l_quantity") > 25, "written").otherwise("reused").alias("action"), (F.col("l_tax") == 0).alias("from_store"))
    return catalogue.outcomes(tiles, ["l_returnflag"])


@query("agg16_parity", """with j as (select l_linenumber, case when l_discount <> 0 then l_extendedprice end as a, case when o_orderstatus <> 'F' then o_totalprice end as b from lineitem join orders on l_orderkey = o_orderkey)
select l_linenumber, max(abs(a - b)) as worst, count(*) filter (a is null and b is null) as both_missing, count(*) filter ((a is null) <> (b is null)) as mismatches from j group by l_linenumber""")
def agg16(spark, sf_dir):
    """Two samplers' answers compared: worst difference, missing in both, missing in one."""
    j = inputs.table(spark, sf_dir, "lineitem").join(inputs.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.when(F.col("l_discount") != 0, F.col("l_extendedprice")), F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    return checks.parity(j, ["l_linenumber"], a, b)


@query("snk01_tile_write", f"with {PX} select col // 8 as bx, row // 8 as by, count(v) as n, sum(cast(v as double)) as total from px where v is not null group by 1, 2")
def snk01(spark, sf_dir):
    """Blocks written in folders by layer, validated, put in place, and read again."""
    path = storage.scratch(spark, "tiles")
    made = blocks.to_blocks(inputs.pixels(spark, sf_dir), 8).withColumn("layer", F.lit("height"))
    storage.write_atomically(made, path, validate=lambda df: df.where(F.size("values") != 64), by=("layer",))
    v = blocks.pixels_of(spark.read.parquet(path).where("layer = 'height'"), 8)
    return v.groupBy(F.floor(F.col("col") / 8).alias("bx"), F.floor(F.col("row") / 8).alias("by")).agg(F.count("v").alias("n"), F.sum(F.col("v").cast("double")).alias("total"))


@query("snk03_sparse_window", f"with {PX} select (3 + col) // 8 as bx, (2 + row) // 8 as by, count(*) as n from px where v is not null and 3 + col < 32 and 2 + row < 16 group by 1, 2")
def snk03(spark, sf_dir):
    """A window in an otherwise empty tile: only blocks that hold a height are rows."""
    b = blocks.to_blocks(rasters.placed(inputs.pixels(spark, sf_dir), 3, 2, 32, 16), 8)
    return b.select("bx", "by", F.size(F.filter("values", lambda v: v.isNotNull())).cast("long").alias("n"))


@query("snk04_rgb_window", """select p_partkey % 50 as col, p_partkey // 50 as row, cast(case when p_size % 4 <> 0 then p_size * 5 else 0 end as smallint) as r, p_size % 4 <> 0 as mask from part""")
def snk04(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    p = inputs.table(spark, sf_dir, "part").select((k % 50).alias("col"), F.floor(k / 50).alias("row"), (s * 5).alias("r"), s.alias("g"), s.alias("b"), (s % 4).alias("a"))
    path = storage.scratch(spark, "rgb")
    storage.write_atomically(rasters.masked_rgb(p), path)
    return spark.read.parquet(path).select("col", "row", "r", "mask")


@query("snk06_test_points", "select distinct 48 + event_id % 16 / 8.0e0 as lat, 12 + event_id % 32 / 16.0e0 as lon, event_id % 64 / 4.0e0 as height, cast(null as varchar) as problem from events")
def snk06(spark, sf_dir):
    k = F.col("event_id")
    path = storage.scratch(spark, "points")
    storage.write_test_points(inputs.table(spark, sf_dir, "events").select((48 + k % 16 / 8).alias("lat"), (12 + k % 32 / 16).alias("lon"), (k % 64 / 4).alias("height")), path)
    lines = spark.read.text(path).select(F.lit(0).cast("long").alias("line_no"), F.col("value").alias("line"))
    return rasters.parse_points(lines).drop("line_no")


@query("snk07_catalogue_build", f"with {TILES}, {V} select (select count(distinct world) from v) as worlds, (select count(*) from v) as vertices, (select count(*) from t) as tiles, (select count(*) from l) as links")
def snk07(spark, sf_dir):
    """The catalogue's tables, each sorted by its key, written and counted after reading."""
    v = _vertices(spark, sf_dir)
    tables = {"worlds": (v.select("world").distinct(), ["world"]), "vertices": (v, ["world", "seq"]), "tiles": (_tiles(spark, sf_dir), ["ix", "iy"]), "links": (_links(spark, sf_dir), ["world", "ix", "iy"])}
    path, out = storage.scratch(spark, "catalogue"), None
    for name, (df, key) in tables.items():
        storage.write_atomically(df.repartitionByRange(*key).sortWithinPartitions(*key), f"{path}-{name}")
        n = spark.read.parquet(f"{path}-{name}").agg(F.count(F.lit(1)).alias(name))
        out = n if out is None else out.crossJoin(n)  # one row each
    return out


@query("snk07_equal_catalogues", f"""with {TILES}, {V}, n(name, n) as (select 'worlds', count(distinct world) from v union all select 'vertices', count(*) from v union all select 'tiles', count(*) from t union all select 'links', count(*) from l
 union all select 'lattice', count(distinct ix // 2) from t union all select 'lattice_links', (select count(*) from (select distinct world, ix // 2 from l)) union all select 'test_points', (select count(*) from (select distinct y, x from v)))
select name, n, true as equal from n""")
def snk07_equal(spark, sf_dir):
    """All seven tables of a catalogue built twice, from rows dealt otherwise: as many rows, and equal digests."""
    v, t, l_ = _vertices(spark, sf_dir), _tiles(spark, sf_dir), _links(spark, sf_dir)
    half = F.floor(F.col("ix") / 2).alias("ix")
    tables = {
        "worlds": v.select(F.col("world").alias("name")).distinct(), "vertices": v, "tiles": t, "links": l_, "lattice": t.select(half, F.lit(0).alias("iy")).distinct(),
        "lattice_links": l_.select("world", half, F.lit(0).alias("iy")).distinct(), "test_points": v.select(F.col("y").alias("lat"), F.col("x").alias("lon"), F.lit(0.0).alias("height")).distinct()}
    path, rows = storage.scratch(spark, "catalogue"), []
    for name, df in tables.items():
        for build, parts in ((0, 3), (1, 5)):
            catalogue.write_table(df.repartition(parts, F.rand(build)), f"{path}/{name}/{build}", catalogue.KEYS[name], 100)
        first, second = (spark.read.parquet(f"{path}/{name}/{build}") for build in (0, 1))
        rows.append((name, first.count(), catalogue.digest(first) == catalogue.digest(second)))
    return spark.createDataFrame(rows, "name string, n long, equal boolean")


@query("snk11_dataset_swap", "select count(*) as n from part where p_size > 25")
def snk11(spark, sf_dir):
    """A dataset is rebuilt elsewhere and takes the old one's place."""
    path, p = storage.scratch(spark, "dataset"), inputs.table(spark, sf_dir, "part")
    storage.write_atomically(p.where("p_size <= 25"), path)
    storage.write_atomically(p.where("p_size > 25"), path, overwrite=True)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
