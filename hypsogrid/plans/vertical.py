"""Queries on vertical datums: operations, nested grids of undulations, and what conversions observe."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, projection, vertical
from ..sources import undulations
from . import inputs
from .registry import query

#: A coarse grid made from `supplier`, some of whose nodes have no value, and a finer one within it made from `nation`.
OUTER, INNER = ("outer", 0.0, 0.0, 8.0, 8.0, 10, 6), ("inner", 16.0, 8.0, 2.0, 2.0, 5, 5)
NODES = """n as (select 0 as g, s_suppkey % 10 as col, s_suppkey // 10 % 6 as row, max(40 + s_suppkey % 16 / 4.0e0) as n from supplier where s_suppkey % 29 <> 0 group by 1, 2, 3
 union all select 1, n_nationkey % 5, n_nationkey // 5, 30 + n_nationkey / 4.0e0 from nation)"""
#: From pt (id, lon, lat, z) to s (id, z, shifted).
SHIFTED = f"""{NODES}, pg as (select *, case when lon between 16 and 24 and lat between 8 and 16 then 1 when lon between 0 and 72 and lat between 0 and 40 then 0 end as g from pt),
pu as (select *, case g when 1 then (lon - 16) / 2 else lon / 8 end as u, case g when 1 then (lat - 8) / 2 else lat / 8 end as w, case g when 1 then 3 else 8 end as lc, case g when 1 then 3 else 4 end as lr from pg),
pc as (select *, least(cast(floor(u) as bigint), lc) as c, least(cast(floor(w) as bigint), lr) as r from pu),
s as (select id, z, z + ((a.n * (1 - (u - c)) + b.n * (u - c)) * (1 - (w - r)) + (d.n * (1 - (u - c)) + e.n * (u - c)) * (w - r)) as shifted, pc.g as grid from pc left join n a on a.g = pc.g and a.col = c and a.row = r
 left join n b on b.g = pc.g and b.col = c + 1 and b.row = r left join n d on d.g = pc.g and d.col = c and d.row = r + 1 left join n e on e.g = pc.g and e.col = c + 1 and e.row = r + 1)"""
V = f"v as ({inputs.VERTICES_SQL}), pt as (select world * 8 + seq as id, x as lon, y as lat, x + y as z from v)"
UP = vertical.Operation("made-up", "ellipsoid", (("made-up", 1),))


def grids(spark, sf_dir):
    k, n = F.col("s_suppkey"), F.col("n_nationkey")
    outer = inputs.table(spark, sf_dir, "supplier").where("s_suppkey % 29 <> 0").groupBy((k % 10).alias("col"), (F.floor(k / 10) % 6).alias("row")).agg(F.max(40 + k % 16 / 4).alias("n"))
    inner = inputs.table(spark, sf_dir, "nation").select((n % 5).alias("col"), F.floor(n / 5).alias("row"), (30 + n / 4).alias("n"))
    nodes = outer.select(F.lit("outer").alias("grid"), "*").unionByName(inner.select(F.lit("inner").alias("grid"), "*"))
    frames = spark.createDataFrame([OUTER, INNER], "grid string, west double, south double, dlon double, dlat double, n_cols int, n_rows int")
    return undulations.from_nodes(nodes, frames, 4)


def _points(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    return inputs.vertices(spark, sf_dir).select((F.col("world") * 8 + F.col("seq")).alias("id"), x.alias("lon"), y.alias("lat"), (x + y).alias("z"))


def _shifted(spark, sf_dir):
    return vertical.convert(_points(spark, sf_dir), UP, {"made-up": grids(spark, sf_dir)}, size=4)


@query("prj20_shifted_heights", f"with {V}, {SHIFTED} select id, z, shifted from s")
def prj20(spark, sf_dir):
    """Heights on another datum, by the innermost of two nested grids."""
    return _shifted(spark, sf_dir).select("id", "z", "shifted")


PIXELS = f"pt as (select row * 64 + col as id, cast(col as double) as lon, cast(row % 40 as double) + 0.5e0 as lat, cast(v as double) as z from ({inputs.PIXELS_SQL}) where v is not null)"


@query("prj21_converted_raster", f"with {PIXELS}, {SHIFTED} select id, cast(shifted as float) as v from s")
def prj21(spark, sf_dir):
    """Heights of a raster on another datum, 32 bits; blocks of nodes joined in salted parts, as beyond the broadcast bound."""
    px = inputs.pixels(spark, sf_dir).where("v is not null").select((F.col("row") * 64 + F.col("col")).alias("id"), F.col("col").cast("double").alias("lon"), (F.col("row") % 40 + 0.5).alias("lat"), F.col("v").cast("double").alias("z"))
    met = vertical.undulation(px, grids(spark, sf_dir), 4, broadcast_blocks=1)
    return met.select("id", (F.col("z") + F.col("undulation")).cast("float").alias("v"))


@query("agg17_known_points", f"with {V}, {SHIFTED} select id // 8 as world, max(abs(shifted - z)) as delta, count(*) filter (shifted is null) as n_missing, coalesce(max(abs(shifted - z)) > 43, true) as implausible from s where id % 8 = 0 group by 1")
def agg17(spark, sf_dir):
    """Shifts at chosen points; here more than 43 units is implausible."""
    d = F.max(F.abs(F.col("shifted") - F.col("z")))
    of = F.floor(F.col("id") / 8).alias("world")
    return _shifted(spark, sf_dir).where("id % 8 = 0").groupBy(of).agg(d.alias("delta"), F.count_if(F.col("shifted").isNull()).alias("n_missing"), F.coalesce(d > 43, F.lit(True)).alias("implausible"))


@query("val06_vertical_smoke", f"""with {V}, {SHIFTED} select case when shifted is null then 'error' else 'warning' end as severity, case when shifted is null then 'grid' else 'shift' end as "check", cast(id as varchar) as subject from s where shifted is null or abs(shifted - z) > 42""")
def val06(spark, sf_dir):
    """The operation run at known points: none of its grids there is an error, a large shift (here over 42) a warning."""
    return checks.known_points(_shifted(spark, sf_dir), F.col("id"), "z", "shifted", 42.0).drop("message")


@query("agg13_largest_drift", f"select world, count(*) as n, false as too_far from ({inputs.VERTICES_SQL}) group by world")
def agg13(spark, sf_dir):
    """How far places move that go to Krovak, to UTM and back: nowhere over the bound."""
    v = inputs.vertices(spark, sf_dir).select("world", (12 + F.col("x") / 16).alias("lon"), (48.5 + F.col("y") / 16).alias("lat"))
    there = projection.transform(v, 4326, 5514, "lon", "lat")
    again = projection.transform(projection.transform(there, 5514, 32633, out=("e", "n")), 32633, 5514, "e", "n", ("x1", "y1"))
    return again.groupBy("world").agg(F.count(F.lit(1)).alias("n"), (vertical.drift(("x", "y"), ("x1", "y1")) > vertical.MOST_DRIFT).alias("too_far"))


CAND = """c as (select p_brand as datum, p_partkey as rank, p_size % 5 = 0 as preferred, p_size % 7 = 0 as ballpark, case when p_size % 4 = 0 then 'g' || p_size % 8 end as lacking from part),
b as (select datum, min(case when not ballpark and lacking is null then case when preferred then 0 else 1000000000 end + rank end) as best from c group by datum)"""


@query("prj19_vertical_operation", f"""with {CAND}, m as (select datum, string_agg(distinct lacking, ',' order by lacking) as missing from c join b using (datum) where not ballpark and lacking is not null and (best is null or case when preferred then 0 else 1000000000 end + rank < best) group by datum)
select datum, best % 1000000000 as chosen, coalesce(missing, '') as missing, case when best is null then case when missing is not null then 'grids are missing' else 'only a guess is known' end end as problem from b left join m using (datum)""")
def prj19(spark, sf_dir):
    """Of each datum's candidates the one to convert with, and the grids that better ones lack."""
    s = F.col("p_size")
    own, lost = F.lit("own"), F.concat(F.lit("g"), (s % 8).cast("string"))
    c = inputs.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("datum"), F.col("p_partkey").alias("rank"), F.when(s % 4 == 0, F.array(own, lost)).otherwise(F.array(own)).alias("grids"), F.array(own).alias("present"), (s % 5 == 0).alias("preferred"), (s % 7 == 0).alias("ballpark"))
    return vertical.explain(c, "datum").withColumn("missing", F.array_join("missing", ","))


_NAMES = "['egm96', 'wgs84-ellipsoid', 'bpv', 'sea']"
_OPS = ", ".join(f"({i}, '{o.source}', '{o.target}', {[g for g, _ in o.steps]}::varchar[], {str(o.preferred).lower()}, {str(o.ballpark).lower()})" for i, o in enumerate(vertical.OPERATIONS))


@query("udf04_datums", f"""with o(rank, source, target, grids, preferred, ballpark) as (values {_OPS}), q as (select s_suppkey as k, {_NAMES}[s_suppkey % 4 + 1] as source, {_NAMES}[s_suppkey // 4 % 3 + 1] as target, case when s_suppkey % 5 = 0 then ['egm96'] else ['egm96', 'cr2005'] end as present from supplier),
j as (select *, len(list_filter(grids, lambda g: not list_contains(present, g))) = 0 and not ballpark as usable from q join o using (source, target)) select k, cast(min(rank) filter (usable) as int) as chosen, case when count(*) filter (usable) = 0 then 'grids are missing' end as problem from j group by k""")
def udf04(spark, sf_dir):
    """Conversions asked for, by the registry of datums; an unknown datum has no operation and no row."""
    k = F.col("s_suppkey")
    name = lambda i: F.get(F.array(*map(F.lit, ("egm96", "wgs84-ellipsoid", "bpv", "sea"))), i.cast("int"))
    asked = inputs.table(spark, sf_dir, "supplier").select(
        k.alias("k"), name(k % 4).alias("source"), name(F.floor(k / 4) % 3).alias("target"), F.when(k % 5 == 0, F.array(F.lit("egm96"))).otherwise(F.array(F.lit("egm96"), F.lit("cr2005"))).alias("present"))
    return vertical.explain(asked.join(F.broadcast(vertical.registry(spark)), ["source", "target"]), "k").drop("missing")
