"""Sampling queries."""

from __future__ import annotations

from ..operators import blocks
from . import inputs
from .registry import query

BILINEAR_SQL = f"""with px as ({inputs.PIXELS_SQL}), pt as ({inputs.POINTS_SQL}),
k as (select *, cast(floor(u) as bigint) c0, cast(floor(v) as bigint) r0, u - floor(u) fx, v - floor(v) fy from pt)
select event_id, u, v,
  (cast(a.v as double) * (1 - fx) + cast(b.v as double) * fx) * (1 - fy)
  + (cast(c.v as double) * (1 - fx) + cast(d.v as double) * fx) * fy as height
from (select event_id, u, v as v, c0, r0, fx, fy from k) k
left join px a on a.col = c0 and a.row = r0 left join px b on b.col = c0 + 1 and b.row = r0
left join px c on c.col = c0 and c.row = r0 + 1 left join px d on d.col = c0 + 1 and d.row = r0 + 1"""


@query("ras01_bilinear_sample", BILINEAR_SQL.replace("select event_id, u, v,\n", "select event_id, k.u as u, k.v as v,\n"))
def ras01(spark, sf_dir):
    table = blocks.to_blocks(inputs.pixels(spark, sf_dir), 8)
    return blocks.bilinear(inputs.points(spark, sf_dir), ["event_id", "u", "v"], table, 8)
