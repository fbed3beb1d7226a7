"""Polygon queries and the planning of tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue, polygons
from ..sources import worlds
from . import inputs
from .registry import query

V = f"vx as ({inputs.VERTICES_SQL})"
EDGES = f"""{V}, ed as (select world, seq, x as x0, y as y0, coalesce(lead(x) over w, first(x) over a) as x1, coalesce(lead(y) over w, first(y) over a) as y1 from vx
 window w as (partition by world order by seq), a as (partition by world order by seq rows between unbounded preceding and unbounded following))"""


@query("win02_polygon_edges", f"with {EDGES} select * from ed")
def win02(spark, sf_dir):
    return polygons.edges(inputs.vertices(spark, sf_dir))


@query("agg01_polygon_bounds", f"with {V} select world, min(x) as west, min(y) as south, max(x) as east, max(y) as north from vx group by world")
def agg01(spark, sf_dir):
    return polygons.bounds(inputs.vertices(spark, sf_dir))


@query("agg09_vertex_centroid", f"with {V} select world, round(avg(x), 6) as x, round(avg(y), 6) as y from vx group by world")
def agg09(spark, sf_dir):
    return polygons.centroid(inputs.vertices(spark, sf_dir)).select("world", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("prj24_polygon_wkt", f"""with {V}, p as (select world, seq, concat(cast(x as varchar), ' ', cast(y as varchar)) as p from vx)
select world, 'POLYGON ((' || string_agg(p, ', ' order by seq) || ', ' || min_by(p, seq) || '))' as wkt from p group by world""")
def prj24(spark, sf_dir):
    return polygons.wkt(inputs.vertices(spark, sf_dir))


MEETS = f"""{EDGES}, bb as (select world, min(x) as w, min(y) as s, max(x) as e, max(y) as n from vx group by world),
ca as (select world, unnest(range(cast(floor(w / 2) as bigint), cast(floor(e / 2) as bigint) + 1)) as ix, s, n from bb),
cb as (select world, ix, unnest(range(cast(floor(s / 2) as bigint), cast(floor(n / 2) as bigint) + 1)) as iy from ca),
bx as (select world, ix, iy, ix * 2.0e0 as west, iy * 2.0e0 as south, ix * 2.0e0 + 2 as east, iy * 2.0e0 + 2 as north from cb),
q as (select bx.*, x0, y0, x1, y1, x0 - x1 as p1, x0 - west as q1, x1 - x0 as p2, east - x0 as q2, y0 - y1 as p3, y0 - south as q3, y1 - y0 as p4, north - y0 as q4 from bx join ed using (world)),
z as (select *, (p1 <> 0 or q1 >= 0) and (p2 <> 0 or q2 >= 0) and (p3 <> 0 or q3 >= 0) and (p4 <> 0 or q4 >= 0) and
 greatest(0, case when p1 < 0 then q1 / p1 else 0 end, case when p2 < 0 then q2 / p2 else 0 end, case when p3 < 0 then q3 / p3 else 0 end, case when p4 < 0 then q4 / p4 else 0 end)
 <= least(1, case when p1 > 0 then q1 / p1 else 1 end, case when p2 > 0 then q2 / p2 else 1 end, case when p3 > 0 then q3 / p3 else 1 end, case when p4 > 0 then q4 / p4 else 1 end) as edge,
 (y0 > (south + north) / 2) <> (y1 > (south + north) / 2) and (west + east) / 2 < (x1 - x0) * (((south + north) / 2 - y0) / nullif(y1 - y0, 0)) + x0 as crosses from q),
m as (select world, ix, iy from z group by world, ix, iy having bool_or(edge) or count(*) filter (crosses) % 2 = 1)"""


def _plan(spark, sf_dir):
    """world and tile (ix, iy) of 2 by 2 units for each tile that a polygon meets."""
    return polygons.tiles_met(inputs.vertices(spark, sf_dir), 2.0)


@query("jn03_polygon_tiles", f"with {MEETS} select * from m")
def jn03(spark, sf_dir):
    return _plan(spark, sf_dir)


@query("set01_needed_tiles", f"with {MEETS} select distinct ix, iy from m")
def set01(spark, sf_dir):
    return _plan(spark, sf_dir).select("ix", "iy").distinct()


@query("set02_unneeded_tiles", f"with {MEETS} select ix, iy from m where world % 3 = 0 except select ix, iy from m where world % 3 <> 0")
def set02(spark, sf_dir):
    who = _plan(spark, sf_dir).groupBy("ix", "iy").agg(F.bool_and(F.col("world") % 3 == 0).alias("only"))
    return who.where("only").select("ix", "iy")


@query("agg02_tile_requirements", f"""with {MEETS}, bb2 as (select world, floor(min(x) * 4 - 0.5e0 - 1e-3) as c0, floor(min(y) * 4 - 0.5e0 - 1e-3) as r0, floor(max(x) * 4 - 0.5e0 + 1e-3) + 1 as c1, floor(max(y) * 4 - 0.5e0 + 1e-3) + 1 as r1 from vx group by world)
select ix, iy, cast(min(greatest(c0, ix * 8)) as bigint) as col_min, cast(min(greatest(r0, iy * 8)) as bigint) as row_min, cast(max(least(c1, ix * 8 + 7)) as bigint) as col_max, cast(max(least(r1, iy * 8 + 7)) as bigint) as row_max
from m join bb2 using (world) where greatest(c0, ix * 8) <= least(c1, ix * 8 + 7) and greatest(r0, iy * 8) <= least(r1, iy * 8 + 7) group by ix, iy""")
def agg02(spark, sf_dir):
    """Per tile of 8 by 8 pixels the box around the pixels that polygons may read."""
    at = lambda c: F.col(c) * 4 - 0.5
    need = inputs.vertices(spark, sf_dir).groupBy("world").agg(
        F.floor(F.min(at("x")) - 1e-3).alias("c0"), F.floor(F.min(at("y")) - 1e-3).alias("r0"),
        (F.floor(F.max(at("x")) + 1e-3) + 1).alias("c1"), (F.floor(F.max(at("y")) + 1e-3) + 1).alias("r1"))
    cut = _plan(spark, sf_dir).join(need, "world").select(
        "ix", "iy", F.greatest("c0", F.col("ix") * 8).alias("c0"), F.greatest("r0", F.col("iy") * 8).alias("r0"),
        F.least("c1", F.col("ix") * 8 + 7).alias("c1"), F.least("r1", F.col("iy") * 8 + 7).alias("r1"))
    return cut.where("c0 <= c1 and r0 <= r1").groupBy("ix", "iy").agg(
        F.min("c0").alias("col_min"), F.min("r0").alias("row_min"), F.max("c1").alias("col_max"), F.max("r1").alias("row_max"))


@query("jn06_vertex_counts", """with w as (select distinct c_custkey // 6 as world from customer), v as (select c_custkey // 6 as world from customer where c_acctbal > 0)
select w.world, count(v.world) as n_vertices, count(v.world) >= 3 as enough from w left join v using (world) group by w.world""")
def jn06(spark, sf_dir):
    c = inputs.table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 6).alias("world"), "c_acctbal")
    return catalogue.vertex_counts(c, c.where("c_acctbal > 0"))


@query("src03_first_wins", """select p_brand as name, p_partkey as position from (select *, row_number() over (partition by p_brand order by p_partkey) as rn from part) where rn = 1""")
def src03(spark, sf_dir):
    p = inputs.table(spark, sf_dir, "part")
    return catalogue.first_wins(p.select(F.col("p_brand").alias("name"), F.col("p_partkey").alias("position")), "name", F.col("position"), "position")


@query("src04_world_names", """with n as (select p_partkey, concat(case p_partkey % 3 when 0 then 'world_' when 1 then 'world-' else '' end, case when p_partkey % 7 = 0 then '' else replace(p_name, ' ', '_') end) as stem from part)
select p_partkey, case when regexp_matches(stem, '^world[_-].') then substring(stem, 7) else stem end as name from n""")
def src04(spark, sf_dir):
    k = F.col("p_partkey")
    head = F.when(k % 3 == 0, "world_").when(k % 3 == 1, "world-").otherwise("")
    stem = F.concat(head, F.when(k % 7 == 0, "").otherwise(F.replace("p_name", F.lit(" "), F.lit("_"))))
    path = F.concat(F.lit("/in/"), stem, F.lit(".yaml"))
    return inputs.table(spark, sf_dir, "part").select(k, worlds.name_of(path).alias("name"))
