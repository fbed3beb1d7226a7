"""Vertical datums: choosing an operation, and shifting heights by grids of geoid undulations.

A place takes the innermost grid that holds it: the finest, and among equally fine ones the smaller, then the one whose
name comes first. Grids are found by whole degrees, of which there are at most 64,800; the node block by an equi-join
on grid and block, broadcast while the blocks are few, and beyond that in SALTS parts, as one block of a coarse grid may
hold all places.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import undulations
from .sampling import CORNERS, lerp2

#: How far a point may drift where its place must be kept (metres), and an implausible shift.
MOST_DRIFT, MOST_SHIFT = 1e-3, 200.0
#: Blocks that are broadcast, 17 kB each with 64 cells a side.
BROADCAST_BLOCKS, SALTS = 2_000, 16
DATUMS = ("egm96", "wgs84-ellipsoid", "bpv")


class VerticalError(ValueError):
    """A conversion that cannot be had, or whose result cannot be trusted."""


@dataclass(frozen=True)
class Operation:
    """A way from one datum to another: steps of (grid, sign), the undulation of the grid times sign being added. Where
    heights are above the geoid of a grid, +1 leads to the ellipsoid."""

    source: str
    target: str
    steps: tuple[tuple[str, int], ...]
    accuracy: float | None = None
    preferred: bool = False
    ballpark: bool = False


#: Known operations by the names of their grids. One without steps and between different datums is a guess.
OPERATIONS = (
    Operation("egm96", "wgs84-ellipsoid", (("egm96", 1),), 1.0),
    Operation("bpv", "wgs84-ellipsoid", (("cr2005", 1),), 0.03, preferred=True),
    Operation("bpv", "wgs84-ellipsoid", (), None, ballpark=True),
    Operation("bpv", "egm96", (("cr2005", 1), ("egm96", -1)), 2.03, preferred=True),
    Operation("bpv", "egm96", (), None, ballpark=True),
    *(Operation(d, d, (), 0.0) for d in DATUMS),
)


def choose(candidates: DataFrame, by: str) -> DataFrame:
    """candidates (by, rank, available, preferred, ballpark): of each group the best operation whose grids are there,
    preferred ones first, then by rank; no guess without a grid."""
    usable = candidates.where("available and not ballpark")
    best = usable.groupBy(by).agg(F.min(F.struct((~F.col("preferred")).alias("later"), "rank")).alias("b"))
    return best.select(by, "b.rank")


def registry(spark: SparkSession) -> DataFrame:
    """The known operations: rank, source, target, grids, preferred, ballpark."""
    rows = [(i, o.source, o.target, [g for g, _ in o.steps], o.preferred, o.ballpark) for i, o in enumerate(OPERATIONS)]
    return spark.createDataFrame(rows, "rank int, source string, target string, grids array<string>, preferred boolean, ballpark boolean")


def explain(candidates: DataFrame, by: str) -> DataFrame:
    """candidates (by, rank, grids, present, preferred, ballpark; grids and present are arrays of names) -> for each group
    the rank chosen, the grids that a better operation would have needed, and why none is chosen."""
    order = F.struct((~F.col("preferred")).alias("later"), "rank")
    lacks = candidates.withColumn("lacking", F.array_except("grids", "present")).withColumn("order", order)
    usable = ~F.col("ballpark") & (F.size("lacking") == 0)
    best = lacks.groupBy(by).agg(F.min(F.when(usable, F.col("order"))).alias("best"))
    before = F.col("best").isNull() | (F.col("order") < F.col("best"))
    wanted = lacks.where(~F.col("ballpark") & (F.size("lacking") > 0)).join(best, by).where(before)
    names = wanted.select(by, F.explode("lacking").alias("g")).groupBy(by).agg(F.sort_array(F.collect_set("g")).alias("missing"))
    none = F.coalesce(F.col("missing"), F.array().cast("array<string>"))
    why = F.when(F.col("best").isNull(), F.when(F.size(none) > 0, "grids are missing").otherwise("only a guess is known"))
    return best.join(names, by, "left").select(by, F.col("best.rank").alias("chosen"), none.alias("missing"), why.alias("problem"))


def select(source: str, target: str, present: set[str]) -> Operation:
    """The operation to convert with, given the names of the grids that are there; errors name what lacks."""
    for d in (source, target):
        if d not in DATUMS:
            raise VerticalError(f"{d} is no known vertical datum; known are {', '.join(DATUMS)}")
    known = [o for o in OPERATIONS if (o.source, o.target) == (source, target)]
    usable = [o for o in known if not o.ballpark and all(g in present for g, _ in o.steps)]
    if usable:
        return min(usable, key=lambda o: not o.preferred)
    lacking = sorted({g for o in known if not o.ballpark for g, _ in o.steps if g not in present})
    raise VerticalError(f"{source} cannot be converted to {target}: " + (f"missing grids: {', '.join(lacking)}" if lacking else "no operation is known"))


def _wrapped(lon: Column, west: Column) -> Column:
    """The longitude as counted from a grid's western edge."""
    return west + F.pmod(lon - west, F.lit(360.0))


def _degree(lon: Column, lat: Column) -> Column:
    return F.struct(F.pmod(F.floor(lon), F.lit(360)).cast("int").alias("x"), F.floor(lat).cast("int").alias("y"))


def by_degree(grids: DataFrame) -> DataFrame:
    """For each whole degree the grids that meet it, innermost first; 64,800 rows at most."""
    span = lambda a, d, n: F.sequence(F.floor(F.col(a)).cast("int"), F.floor(F.col(a) + F.col(d) * (F.col(n) - 1)).cast("int"))
    cells = grids.withColumn("x", F.explode(span("west", "dlon", "n_cols"))).withColumn("y", F.explode(span("south", "dlat", "n_rows")))
    area = F.col("dlon") * F.col("dlat")
    inner = F.struct(area.alias("cell"), (area * F.col("n_cols") * F.col("n_rows")).alias("area"), "grid", "west", "south", "dlon", "dlat", "n_cols", "n_rows")
    keyed = cells.select(F.struct(F.pmod("x", F.lit(360)).alias("x"), "y").alias("degree"), inner.alias("g"))
    return keyed.groupBy("degree").agg(F.sort_array(F.collect_set("g")).alias("inner"))


def located(points: DataFrame, grids: DataFrame, size: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """points with `g`: grid, block (bc, br), node (i, j) in it and fractions (fx, fy) in the innermost grid; NULL where
    no grid holds them."""
    holds = lambda g: (
        (_wrapped(F.col(lon), g["west"]) <= g["west"] + g["dlon"] * (g["n_cols"] - 1)) & (F.col(lat) >= g["south"]) & (F.col(lat) <= g["south"] + g["dlat"] * (g["n_rows"] - 1)))
    joined = points.withColumn("_degree", _degree(F.col(lon), F.col(lat))).join(F.broadcast(by_degree(grids)), F.col("_degree") == F.col("degree"), "left")
    found = joined.withColumn("_g", F.get(F.filter("inner", holds), F.lit(0))).drop("_degree", "degree", "inner")
    g = F.col("_g")
    found = found.withColumns({"_u": (_wrapped(F.col(lon), g["west"]) - g["west"]) / g["dlon"], "_v": (F.col(lat) - g["south"]) / g["dlat"]})
    # the last node's cell is the one before it
    found = found.withColumns({"_c": F.least(F.floor("_u"), g["n_cols"] - 2).cast("int"), "_r": F.least(F.floor("_v"), g["n_rows"] - 2).cast("int")})
    place = F.struct(
        g["grid"].alias("grid"), F.floor(F.col("_c") / size).cast("int").alias("bc"), F.floor(F.col("_r") / size).cast("int").alias("br"), (F.col("_c") % size).alias("i"), (F.col("_r") % size).alias("j"),
        (F.col("_u") - F.col("_c")).alias("fx"), (F.col("_v") - F.col("_r")).alias("fy"))
    return found.withColumn("g", F.when(g.isNotNull(), place)).drop("_g", "_u", "_v", "_c", "_r")


def undulation(points: DataFrame, blocks: DataFrame, size: int = undulations.BLOCK, lon: str = "lon", lat: str = "lat", out: str = "undulation", broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """points with the bilinear undulation of the innermost grid, NULL outside all grids or beside a node without value."""
    placed = located(points, undulations.grids(blocks), size, lon, lat)
    nodes = blocks.select(F.struct("grid", "bc", "br").alias("_block"), "width", "nodes")
    key = F.struct("g.grid", "g.bc", "g.br")
    few = blocks.select("grid").limit(broadcast_blocks + 1).count() <= broadcast_blocks
    if few:
        met = placed.withColumn("_key", F.when(F.col("g").isNotNull(), key)).join(F.broadcast(nodes), F.col("_key") == F.col("_block"), "left")
    else:
        salted = placed.withColumns({"_key": F.when(F.col("g").isNotNull(), key), "_salt": F.pmod(F.xxhash64(lon, lat), F.lit(SALTS)).cast("int")})
        copies = nodes.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(copies, (F.col("_key") == F.col("_block")) & (F.col("_salt") == F.col("_copy")), "left").drop("_salt", "_copy")
    node = lambda dc, dr: F.get("nodes", (F.col("g.j") + dr) * F.col("width") + F.col("g.i") + dc).cast("double")
    value = lerp2(*(node(*c) for c in CORNERS.values()), F.col("g.fx"), F.col("g.fy"))
    return met.withColumn(out, value).drop("g", "_key", "_block", "width", "nodes")


def convert(points: DataFrame, operation: Operation, blocks: dict[str, DataFrame], z: str = "z", out: str = "shifted", lon: str = "lon", lat: str = "lat", size: int = undulations.BLOCK) -> DataFrame:
    """points with z on the operation's target; a join for each step."""
    df = points.withColumn(out, F.col(z).cast("double"))
    for name, sign in operation.steps:
        df = undulation(df, blocks[name], size, lon, lat, "_n").withColumn(out, F.col(out) + sign * F.col("_n")).drop("_n")
    return df


class Guard:
    """What a conversion did, observed while its result is written: no pass of its own. `check` raises afterwards."""

    def __init__(self, name: str, keeps_place: bool = True) -> None:
        self.seen, self.keeps_place = Observation(name), keeps_place

    def watch(self, df: DataFrame, before: str, after: str, drift: Column) -> DataFrame:
        d = F.col(after) - F.col(before)
        usable = F.col(before).isNotNull() & ~F.isnan(before)
        self.asked = df, (
            F.count(F.lit(1)).alias("total"), F.count_if(usable).alias("n_valid"), F.count(d).alias("converted"), F.min(d).alias("min_delta"), F.max(d).alias("max_delta"),
            F.count_if(usable & F.coalesce(F.isnan(after) | (F.abs(after) == float("inf")), F.lit(True))).alias("n_not_finite"), F.max(drift).alias("drift"))
        return df.observe(self.seen, *self.asked[1])

    def check(self) -> dict:
        try:
            s = self.seen.get
        except Py4JJavaError:  # a plan that turned out to be empty was replaced, and nothing was observed
            s = self.asked[0].agg(*self.asked[1]).first().asDict()
        if s["n_not_finite"]:
            raise VerticalError(f"the conversion has no finite height for {s['n_not_finite']} of {s['n_valid']} pixels: they lie outside its grids")
        if self.keeps_place and (s["drift"] or 0) > MOST_DRIFT:
            raise VerticalError(f"the conversion moved places by {s['drift']:.6f} m, more than {MOST_DRIFT} m")
        return s


def drift(before: tuple[str, str], after: tuple[str, str]) -> Column:
    """The largest move along an axis."""
    return F.max(F.greatest(*(F.abs(F.col(b) - F.col(a)) for a, b in zip(before, after))))
