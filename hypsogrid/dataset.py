"""Building, reading and validating a dataset.

A dataset is a folder of tiles and a folder of state. Tiles of heights, of the geographic lattice and of imagery are
blocks below heights/, lattice/ and imagery/, each build in a folder of its own (build=.../ix=.../iy=...), which is
never changed. The state is a set of small tables, which say of each declared tile which build made it, and the
manifest. A build writes its tiles and a new state beside the old one, validates both together, and then puts the state
in place by one move: until then readers see the old dataset, and a build that fails takes away what it wrote. Tiles
whose tags and filled pixels still serve stay as they are, files and all. Only declared tiles are read.
"""

from __future__ import annotations

import json
import platform
import uuid
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import blocks, catalogue, checks, grid, lattice, projection, rasters, storage, stored, vertical
from .options import OptionError, PrepareOptions
from .sources import manifest, undulations
from .sources.heights import HeightSource, ImagerySource, read_in_pieces, read_rgba_in_pieces, require_datum

PROCESSING_VERSION, CATALOGUE_VERSION = "2", 1
BLOCKS = "bx long, by long, values array<{}>, build string, ix long, iy long"
KINDS = {"heights": "float", "lattice": "float", "imagery": "int"}
WINDOW = "struct<col_min: bigint, row_min: bigint, width: bigint, height: bigint>"
STATE = {
    "tiles": "ix long, iy long, build string, n_blocks long, tags map<string, string>, filled " + WINDOW,
    "lattice": "ix long, iy long, build string, n_blocks long, filled " + WINDOW,
    "imagery": "ix long, iy long, build string, n_blocks long, filled " + WINDOW,
    "links": "world string, ix long, iy long",
    "lattice_links": "world string, ix long, iy long",
    "worlds": "name string, n_vertices long, col_min long, row_min long, width long, height long",
    "vertices": "world string, seq int, lat double, lon double",
    "test_points": "lat double, lon double, height double",
}
#: Declared tiles up to this number are broadcast; beyond it they are joined.
BROADCAST_TILES = 200_000


class BuildError(RuntimeError):
    """A build whose result is not valid; nothing of it is left."""

    def __init__(self, problems: list) -> None:
        super().__init__("; ".join(f"{p['check']}: {p['subject']}: {p['message']}" for p in problems))


class WorldNotFoundError(KeyError):
    """A world that the dataset does not have."""


@dataclass
class Prepared:
    """What a build made: worlds kept and skipped, what became of each tile, counts and its report."""

    path: str
    kept: DataFrame
    skipped: DataFrame
    report: DataFrame
    outcomes: DataFrame
    stats: dict


def _grid(o: PrepareOptions) -> grid.TileGrid:
    return grid.TileGrid(o.origin_x, o.origin_y, o.tile_px, o.resolution)


def _degrees(o: PrepareOptions) -> float:
    """Degrees of a pixel of the lattice of heights; of imagery it is this by the factor."""
    return o.rgb_resolution_m * o.wgs_height_factor / lattice.METRES_PER_DEGREE


def _lattice_px(o: PrepareOptions) -> int:
    return o.wgs_tile_px // o.wgs_height_factor


def _window_struct() -> Column:
    return F.struct(*(F.col(c).cast("long").alias(c) for c in ("col_min", "row_min", "width", "height")))


def plan(vertices: DataFrame, options: PrepareOptions) -> DataFrame:
    """The window of pixels that sampling in each world may read: window_id (the world), col_min, row_min, width, height."""
    need = _grid(options).sampling_pixels(projection.krovak(vertices), ["world"])
    return need.select(F.col("world").alias("window_id"), "col_min", "row_min", (F.col("col_max") - F.col("col_min") + 1).alias("width"), (F.col("row_max") - F.col("row_min") + 1).alias("height"))


def plan_lattice(vertices: DataFrame, options: PrepareOptions) -> DataFrame:
    """The window of the geographic lattice that covers each world: window_id and a window."""
    box = vertices.groupBy("world").agg(F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north"))
    return box.select(F.col("world").alias("window_id"), grid.snap_window(*(F.col(c) for c in ("west", "south", "east", "north")), F.lit(_degrees(options))).alias("w")).select("window_id", "w.*")


def sample(places: DataFrame, key: list[str], table: DataFrame, options: PrepareOptions) -> DataFrame:
    """key and height of places (key, lon, lat) from blocks."""
    at = _grid(options).fractional(F.col("x"), F.col("y"))
    points = projection.krovak(places).select(*key, at["u"].alias("u"), at["v"].alias("v"))
    return blocks.bilinear(points, key, table, options.block_px)


def sample_halo(places: DataFrame, halo: DataFrame, options: PrepareOptions) -> DataFrame:
    """places (lon, lat, and more) with their height from blocks with a halo: only places move."""
    at = _grid(options).fractional(F.col("_x"), F.col("_y"))
    points = projection.krovak(places, out=("_x", "_y")).withColumns({"_u": at["u"], "_v": at["v"]})
    return stored.bilinear(points, halo, options.block_px, "_u", "_v").drop("_x", "_y", "_u", "_v")


# state


def _state(spark: SparkSession, at: str, name: str) -> DataFrame:
    if storage.exists(spark, f"{at}/{name}"):
        return spark.read.schema(STATE[name]).parquet(f"{at}/{name}")
    return spark.createDataFrame([], STATE[name])


def _declared(spark: SparkSession, path: str, kind: str, tiles: DataFrame) -> DataFrame:
    """Blocks of declared tiles (ix, iy, build), those of other builds left out; reading prunes to their folders."""
    schema = BLOCKS.format(KINDS[kind])
    if not storage.exists(spark, f"{path}/{kind}"):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).parquet(f"{path}/{kind}")
    keys = tiles.select("build", "ix", "iy")
    few = keys.limit(BROADCAST_TILES + 1).count() <= BROADCAST_TILES
    return found.join(F.broadcast(keys) if few else keys, ["build", "ix", "iy"], "left_semi")


def read_heights(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of heights of a dataset's declared tiles: ix, iy, bx, by, values."""
    return _declared(spark, path, "heights", _state(spark, f"{path}/state", "tiles")).drop("build")


def _write_tiles(made: DataFrame, path: str, kind: str, build: str) -> None:
    made.write.partitionBy("ix", "iy").option("compression", "zstd").parquet(f"{path}/{kind}/build={build}")


def _counted(tiles: DataFrame, path: str, kind: str, keep: str | None = None) -> DataFrame:
    """tiles (ix, iy, build) with n_blocks as written, 0 for a tile without any value; `keep` names counts known before.
    Only folder names and footers are read."""
    spark = tiles.sparkSession
    n = _declared(spark, path, kind, tiles).groupBy("build", "ix", "iy").agg(F.count(F.lit(1)).alias("_n"))
    known = F.col(keep) if keep else F.lit(None)
    return tiles.join(n, ["build", "ix", "iy"], "left").withColumn("n_blocks", F.coalesce(known, F.col("_n"), F.lit(0))).drop("_n", *([keep] if keep else []))


def _tiled(table: DataFrame, tile_px: int, block_px: int) -> DataFrame:
    per = tile_px // block_px
    return table.withColumns({"ix": F.floor(F.col("bx") / per), "iy": F.floor(F.col("by") / per)})


def lattice_block(o: PrepareOptions) -> int:
    """Pixels of a side of the lattice's blocks: the largest up to block_px that a tile is a whole number of."""
    px = _lattice_px(o)
    return max(n for n in range(1, min(o.block_px, px) + 1) if px % n == 0)


# building


def _tags(source: HeightSource, options: PrepareOptions) -> dict[str, str]:
    return {"source_id": source.source_id, "vertical_datum": options.datum, "resolution": repr(options.resolution), "processing_version": PROCESSING_VERSION,
            "origin": f"{options.origin_x!r},{options.origin_y!r}", "block_px": str(options.block_px)}


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for k in sorted(d) for x in (k, d[k])))


def _within(box: Column, coverage: tuple[float, float, float, float]) -> Column:
    west, south, east, north = coverage
    return (box["west"] >= west) & (box["south"] >= south) & (box["east"] <= east) & (box["north"] <= north)


def decide(needs: DataFrame, old: DataFrame, tags: dict[str, str], options: PrepareOptions) -> DataFrame:
    """For each needed tile (ix, iy, window) in one join: action (reused, written or conflict), why, the build that has it."""
    range_of = lambda w: F.struct(w["col_min"].alias("col_min"), w["row_min"].alias("row_min"), (w["col_min"] + w["width"] - 1).alias("col_max"), (w["row_min"] + w["height"] - 1).alias("row_max"))
    had = old.select("ix", "iy", "build", "tags", F.col("n_blocks").alias("had_blocks"), F.col("filled").alias("had"))
    joined = needs.select("ix", "iy", _window_struct().alias("window")).join(had, ["ix", "iy"], "left").withColumns({
        "wanted_tags": _literal_map(tags), "filled": range_of(F.col("had")), "need": range_of(F.col("window")), "valid": F.lit(True)})
    judged = catalogue.reusable(joined)
    new = F.col("build").isNull()
    replace = F.lit(options.overwrite or options.rebuild)
    action = F.when(new, "written").when(F.col("reuse") & ~F.lit(options.rebuild), "reused").when(replace, "written").otherwise("conflict")
    return judged.select("ix", "iy", "window", "build", "tags", "had", "had_blocks", action.alias("action"), F.when(~new, F.coalesce("why", F.lit("rebuilt"))).alias("why")).withColumn(
        "why", F.when(F.col("action") == "reused", None).otherwise(F.col("why")))


def _converted(read: DataFrame, options: PrepareOptions, operation: vertical.Operation, grids: dict[str, DataFrame], guard: vertical.Guard) -> DataFrame:
    """Pixels (col, row, v) on the options' datum; places are carried along and compared."""
    c = _grid(options).pixel_center(F.col("col"), F.col("row"))
    v = rasters.valid(F.col("v").cast("double"), options.nodata)
    px = read.select("col", "row", v.alias("z"))
    if not operation.steps:
        moved, drift = px.withColumn("shifted", F.col("z")), F.lit(0.0)
    else:
        px = px.where("z is not null").withColumns({"x": c["x"], "y": c["y"]})
        moved = vertical.convert(projection.krovak_to_lonlat(px), operation, grids)
        moved = projection.krovak(moved, out=("x1", "y1"))
        drift = F.greatest(F.abs(F.col("x1") - F.col("x")), F.abs(F.col("y1") - F.col("y")))
    return guard.watch(moved, "z", "shifted", drift).select("col", "row", F.col("shifted").cast("float").alias("v"))


def prepare(worlds: DataFrame, path: str, options: PrepareOptions, source: HeightSource, imagery: ImagerySource | None = None, grids: dict[str, DataFrame] | None = None) -> Prepared:
    """worlds: name and points (structs of lon and lat). Heights that any world needs are read once, put on the options'
    datum by the undulation grids (name -> node blocks), and written by tile; the geographic lattice and, if there is a
    source, imagery are written for the worlds whose corners all have heights. Other worlds are skipped with a reason,
    and tiles that only they need are not declared. Raises BuildError if the result is not valid."""
    spark = worlds.sparkSession
    require_datum(source, options.source_datum)
    grids = {**({} if options.undulations is None else _grids_in(spark, options.undulations)), **(grids or {})}
    operation = vertical.select(source.datum, options.datum, set(grids))
    g, build, temporary = _grid(options), uuid.uuid4().hex, []
    staged = f"{path}/state.tmp-{build}"

    def once(df: DataFrame, name: str) -> DataFrame:
        at = storage.scratch(spark, name)
        temporary.append(at)
        df.write.parquet(at)
        return spark.read.schema(df.schema).parquet(at)

    try:
        vertices = once(catalogue.vertices_of(worlds), "vertices")
        windows = plan(vertices, options)
        w = lambda c: F.col(c).cast("double")
        sides = F.struct((g.origin_x + w("col_min") * g.resolution).alias("west"), (g.origin_y - (w("row_min") + w("height")) * g.resolution).alias("south"),
                         (g.origin_x + (w("col_min") + w("width")) * g.resolution).alias("east"), (g.origin_y - w("row_min") * g.resolution).alias("north"))
        far = plan_lattice(vertices, options).select("window_id", F.struct(*(F.col(c).alias(c) for c in lattice.NAMES)).alias("geo"))
        reason = F.when(~_within(F.col("sides"), source.coverage), f"outside the coverage of {source.source_id}")
        if imagery is not None and options.include_rgb:
            reason = reason.when(~_within(lattice.window_bounds(F.col("geo"), _degrees(options)), imagery.coverage), f"outside the coverage of {imagery.source_id}")
        planned = once(windows.withColumn("sides", sides).join(far, "window_id").withColumn("reason", reason), "plan")
        usable = planned.where("reason is null")
        decided = once(decide(lattice.tile_needs(usable.select("window_id", *lattice.NAMES), options.tile_px), _state(spark, f"{path}/state", "tiles"), _tags(source, options), options), "tiles")
        clash = decided.where("action = 'conflict'").take(1)
        if clash:
            raise FileExistsError(f"tile {clash[0]['ix']}, {clash[0]['iy']} is there and cannot be used ({clash[0]['why']}); overwrite replaces it")
        new = decided.where("action = 'written'").select(F.struct("ix", "iy").alias("window_id"), "window.*")
        stats = {"written": new.count(), "reused": decided.where("action = 'reused'").count()}
        if stats["written"]:
            guard = vertical.Guard(f"convert-{build}")
            read = read_in_pieces(source, new, options.most_request_px)
            table = blocks.to_blocks(_converted(read, options, operation, grids, guard), options.block_px)
            _write_tiles(_tiled(table, options.tile_px, options.block_px), path, "heights", build)
            stats |= {k: v for k, v in guard.check().items() if k != "n_not_finite"}
        filled = F.when(F.col("action") == "reused", F.col("had")).otherwise(F.col("window"))
        tiles = decided.select("ix", "iy", F.when(F.col("action") == "reused", F.col("build")).otherwise(F.lit(build)).alias("build"),
                               F.when(F.col("action") == "reused", F.col("tags")).otherwise(_literal_map({**_tags(source, options), "package_version": _version()})).alias("tags"), filled.alias("filled"), F.when(F.col("action") == "reused", F.col("had_blocks")).alias("_kept"))
        tiles = once(_counted(tiles, path, "heights", "_kept"), "declared")
        at = storage.scratch(spark, "halo")
        temporary.append(at)
        halo = stored.write_buckets(stored.with_halo(_declared(spark, path, "heights", tiles).select("bx", "by", "values"), options.block_px), at, int(spark.conf.get("spark.sql.shuffle.partitions")))
        corners = once(sample_halo(vertices.join(usable.select(F.col("window_id").alias("world")), "world", "left_semi"), halo, options), "corners")
        kept = once(catalogue.complete_worlds(corners), "kept")
        lost = usable.select(F.col("window_id").alias("world")).join(kept, "world", "left_anti").withColumn("reason", F.lit("a corner has no height"))
        skipped = planned.where("reason is not null").select(F.col("window_id").alias("world"), "reason").unionByName(lost)
        own = usable.join(kept.withColumnRenamed("world", "window_id"), "window_id", "left_semi")
        links = once(catalogue.links(lattice.tiles_of_windows(own.select("window_id", *lattice.NAMES), options.tile_px).withColumnRenamed("window_id", "world")), "links")
        geo = own.select("window_id", "geo.*")
        geo_tiles = once(lattice.tile_needs(geo, _lattice_px(options)).withColumns({"build": F.lit(build), "filled": _window_struct()}).select("ix", "iy", "build", "filled"), "geo")
        if geo_tiles.take(1):
            _write_tiles(_tiled(_lattice_blocks(geo_tiles, halo, options), _lattice_px(options), lattice_block(options)), path, "lattice", build)
        geo_tiles = _counted(geo_tiles, path, "lattice")
        rgb = imagery is not None and options.include_rgb and bool(geo_tiles.take(1))
        scale = lambda s: F.struct(*((s[c] * options.wgs_height_factor).alias(c) for c in lattice.NAMES))
        rgb_tiles = geo_tiles.drop("n_blocks").withColumn("filled", scale(F.col("filled"))) if rgb else spark.createDataFrame([], STATE["imagery"])
        if rgb:
            seen = read_rgba_in_pieces(imagery, rgb_tiles.select(F.struct("ix", "iy").alias("window_id"), "filled.*"), options.most_request_px)
            packed = rasters.masked_rgb(seen).select("col", "row", F.when(F.col("mask"), F.shiftleft(F.col("r").cast("int"), 16) + F.shiftleft(F.col("g").cast("int"), 8) + F.col("b").cast("int")).alias("v"))
            _write_tiles(_tiled(blocks.to_blocks(packed, options.block_px), options.wgs_tile_px, options.block_px), path, "imagery", build)
            rgb_tiles = _counted(rgb_tiles, path, "imagery")
        kept_points = corners.join(kept, "world", "left_semi").select("lat", "lon", "height").distinct()
        tables = {
            "tiles": tiles.join(links, ["ix", "iy"], "left_semi"), "lattice": geo_tiles, "imagery": rgb_tiles, "links": links, "test_points": kept_points,
            "lattice_links": lattice.tiles_of_windows(geo, _lattice_px(options)).select(F.col("window_id").alias("world"), "ix", "iy").distinct(),
            "worlds": vertices.groupBy(F.col("world").alias("name")).agg(F.count(F.lit(1)).alias("n_vertices")).join(geo.withColumnRenamed("window_id", "name"), "name"),
            "vertices": vertices.join(kept, "world", "left_semi"),
        }
        for name, df in tables.items():
            catalogue.write_table(df.select(*(c.split()[0] for c in _columns(STATE[name]))), f"{staged}/{name}", catalogue.KEYS[name])
        checksums = {name: _checksum(b) for name, b in grids.items() if name in dict(operation.steps)}
        _write_manifest(spark, path, staged, options, source, imagery if rgb else None, operation, checksums)
        found = once(validate_state(spark, path, staged, options, halo), "report") if options.validate_tiles else spark.createDataFrame([], "severity string, check string, subject string, message string")
        problems = found.where(F.col("severity") == checks.ERROR).take(20)
        if problems:
            raise BuildError(problems)
        results = [spark.createDataFrame(df.collect(), df.schema) for df in (kept, skipped, found)]  # a row for each world or problem
        outcomes = spark.createDataFrame(decided.select("ix", "iy", "action", "why").collect(), "ix long, iy long, action string, why string")
        storage.swap(spark, staged, f"{path}/state")
        return Prepared(path, results[0], results[1], results[2], outcomes, stats)
    except BaseException:
        for kind in KINDS:
            storage.remove(spark, f"{path}/{kind}/build={build}")
        storage.remove(spark, staged)
        raise
    finally:
        for at in temporary:
            stored.close_buckets(spark, at)
            storage.remove(spark, at)


def _columns(schema: str) -> list[str]:
    """The top-level fields of a schema's text."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[at:i].strip())
            at = i + 1
    return [*out, schema[at:].strip()]


def _lattice_blocks(geo_tiles: DataFrame, halo: DataFrame, options: PrepareOptions) -> DataFrame:
    """Heights at the centres of the lattice's pixels in each tile's window, as 32-bit blocks."""
    deg, f = _degrees(options), F.col("filled")
    rows = geo_tiles.withColumn("row", F.explode(F.sequence(f["row_min"], f["row_min"] + f["height"] - 1)))
    px = rows.withColumn("col", F.explode(F.sequence(f["col_min"], f["col_min"] + f["width"] - 1))).select("col", "row")
    centres = px.withColumns({"lon": grid.LATTICE_WEST + (F.col("col") + 0.5) * deg, "lat": grid.LATTICE_NORTH - (F.col("row") + 0.5) * deg})
    return blocks.to_blocks(sample_halo(centres, halo, options).select("col", "row", F.col("height").cast("float").alias("v")), lattice_block(options))


def _grids_in(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = {s for o in vertical.OPERATIONS for s, _ in o.steps}
    return {n: undulations.read(spark, f"{folder}/{n}") for n in sorted(names) if storage.exists(spark, f"{folder}/{n}")}


def _checksum(nodes: DataFrame) -> str:
    """A digest of a grid's nodes that does not hang on their order."""
    one = nodes.select(F.xxhash64(F.col("grid"), F.col("bc"), F.col("br"), F.col("nodes")).cast("decimal(38,0)").alias("h"))
    r = one.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s")).first()
    return f"{r['n']}:{r['s'] or 0}"


def _version() -> str:
    from importlib.metadata import PackageNotFoundError, version

    try:
        return version("hypsogrid")
    except PackageNotFoundError:
        return "source"


def _write_manifest(spark: SparkSession, path: str, staged: str, o: PrepareOptions, source: HeightSource, imagery: ImagerySource | None, operation: vertical.Operation, checksums: dict[str, str]) -> None:
    """The manifest of the staged state; sections that it does not know are kept from the one that it replaces."""
    rows = lambda name, *cols: [tuple(r) for r in _state(spark, staged, name).select(*cols).orderBy(*cols).toLocalIterator()]
    pair = lambda name: [{"ix": a, "iy": b} for a, b in rows(name, "ix", "iy")]
    text = json.dumps({
        "format_version": manifest.FORMAT_VERSION, "status": "complete",
        "heightmap": {"horizontal_crs": "EPSG:5514", "vertical_crs": o.datum, "vertical_datum": o.datum, "unit": "m", "dtype": "float32", "nodata": o.nodata},
        "grid": {"origin_x": o.origin_x, "origin_y": o.origin_y, "resolution_x": o.resolution, "resolution_y": o.resolution, "tile_width_px": o.tile_px, "tile_height_px": o.tile_px, "axis_order": "east_north"},
        "storage": {"format": "parquet", "compression": "zstd", "tile_pattern": "heights/ix={ix}/iy={iy}", "block_width_px": o.block_px, "block_height_px": o.block_px},
        "source": {"source_id": source.source_id, "vertical_datum": source.datum, "rgb_source_id": imagery.source_id if imagery else None},
        "transform": {"method": "undulation grids" if operation.steps else "none", "steps": [{"grid": n, "sign": s} for n, s in operation.steps], "accuracy_m": operation.accuracy, "checksums": checksums},
        "tiles": pair("tiles"), "worlds": [r[0] for r in rows("worlds", "name")],
        "test_points": {"path": "test_points", "count": _state(spark, staged, "test_points").count(), "columns": ["lat", "lon", "height"]},
        "wgs": {"crs": "EPSG:4326", "resolution_m": o.rgb_resolution_m, "resolution_deg": _degrees(o), "height_factor": o.wgs_height_factor, "tile_px": o.wgs_tile_px, "height_pattern": "lattice/ix={ix}/iy={iy}",
                "rgb_pattern": "imagery/ix={ix}/iy={iy}" if imagery else None, "tiles": pair("lattice")},
        "worlds_db": {"path": ".", "schema_version": CATALOGUE_VERSION}, "software": {"spark": spark.version, "python": platform.python_version(), "hypsogrid": _version()},
    })
    read = manifest.read(spark.createDataFrame([(text,)], "text string")).drop("more")
    old = f"{path}/state/manifest"
    more = manifest.read(spark.read.text(old).withColumnRenamed("value", "text")).select("more", F.col("m.created_utc").alias("created")) if storage.exists(spark, old) else spark.createDataFrame([], "more map<string, variant>, created string")
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    both = read.join(more, F.lit(True), "left")  # one row and at most one
    manifest.write(both.withColumn("m", F.col("m").withField("created_utc", F.coalesce("created", now))), now).select("document").coalesce(1).write.text(f"{staged}/manifest")


# validating


def _facts(table: DataFrame, tile_px: int, size: int) -> DataFrame:
    """All that checks of tiles ask of their blocks, from one grouped scan."""
    per = tile_px // size
    some = F.filter("values", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    s = table.select(
        "ix", "iy", F.size(some).alias("n"), F.array_min(some).cast("double").alias("lo"), F.array_max(some).cast("double").alias("hi"), (F.size(F.filter("values", lambda v: v.isNotNull())) - F.size(some)).alias("bad"),
        (F.size("values") != size * size).alias("odd"), ((F.floor(F.col("bx") / per) != F.col("ix")) | (F.floor(F.col("by") / per) != F.col("iy"))).alias("strange"), F.struct("bx", "by").alias("b"))
    return s.groupBy("ix", "iy").agg(
        F.sum("n").alias("n_valid"), F.min("lo").alias("min_v"), F.max("hi").alias("max_v"), F.sum("bad").alias("n_not_finite"), F.count_if("odd").alias("n_odd"), F.count_if("strange").alias("n_strange"),
        F.count(F.lit(1)).alias("found"), (F.count(F.lit(1)) - F.count_distinct("b")).alias("n_twice"))


def _tile_report(tiles: DataFrame, facts: DataFrame, kind: str, px: int, plausible: tuple[float, float] | None = None) -> DataFrame:
    """All rules of declared tiles and their facts in one pass: blocks as they were written, in their place and of their
    size, a filled window inside the tile, finite values, and if asked plausible ones."""
    f, some = F.col("filled"), F.coalesce(F.col("n_valid"), F.lit(0)) > 0
    out = (f["col_min"] < F.col("ix") * px) | (f["row_min"] < F.col("iy") * px) | (f["col_min"] + f["width"] > (F.col("ix") + 1) * px) | (f["row_min"] + f["height"] > (F.col("iy") + 1) * px)
    rules = [
        (checks.ERROR, "finite", F.col("n_not_finite") > 0, "heights that are not finite"), (checks.ERROR, "size", F.col("n_odd") > 0, "blocks of another size"),
        (checks.ERROR, "place", F.col("n_strange") > 0, "blocks that belong to another tile"), (checks.ERROR, "twice", F.col("n_twice") > 0, "a block is there twice"),
        (checks.ERROR, "missing tile", F.coalesce("found", F.lit(0)) != F.coalesce("n_blocks", F.lit(-1)), "blocks that were written are not there"),
        (checks.ERROR, "filled", f.isNull(), "no filled window"), (checks.ERROR, "filled", out, "the filled window leaves the tile"), (checks.WARNING, "empty", ~some, "no valid pixel"),
    ]
    if plausible:
        zero = some & (F.col("min_v") == 0) & (F.col("max_v") == 0)
        rules += [(checks.WARNING, "zero", zero, "all heights are 0"), (checks.WARNING, "range", some & ~zero & ((F.col("min_v") < plausible[0]) | (F.col("max_v") > plausible[1])), "implausible heights")]
    return checks.report(tiles.join(facts, ["ix", "iy"], "left"), F.concat_ws(" ", F.lit(kind), F.concat_ws(",", "ix", "iy")), rules)


def _covered(table: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """window_id and the part of each window's pixels that have a value; blocks are cut by windows, pixels stay in arrays."""
    last = lambda a, n: F.floor((F.col(a) + F.col(n) - 1) / size)
    cut = windows.withColumn("bx", F.explode(F.sequence(F.floor(F.col("col_min") / size), last("col_min", "width"))))
    cut = cut.withColumn("by", F.explode(F.sequence(F.floor(F.col("row_min") / size), last("row_min", "height"))))
    met = cut.join(table.select("bx", "by", "values"), ["bx", "by"], "left")
    x, y = (lambda i: F.col("bx") * size + i % size), (lambda i: F.col("by") * size + F.floor(i / size))
    inside = lambda v, i: v.isNotNull() & (x(i) >= F.col("col_min")) & (x(i) < F.col("col_min") + F.col("width")) & (y(i) >= F.col("row_min")) & (y(i) < F.col("row_min") + F.col("height"))
    n = met.select("window_id", (F.col("width") * F.col("height")).alias("all"), F.coalesce(F.size(F.filter("values", inside)), F.lit(0)).alias("n"))
    return n.groupBy("window_id").agg((F.sum("n") / F.first("all")).alias("covered"))


def validate_state(spark: SparkSession, path: str, at: str, options: PrepareOptions, halo: DataFrame | None = None) -> DataFrame:
    """The report of a state and the tiles that it declares. Errors of the manifest end it. Heights are read once for
    all facts of tiles, and once for the blocks with a halo (unless given) that places are sampled from; the lattice is
    read for facts, for coverage and for spot picks, imagery for facts and for coverage."""
    if not storage.exists(spark, f"{at}/manifest"):
        return spark.createDataFrame([(checks.ERROR, "manifest", at, "there is no manifest")], "severity string, check string, subject string, message string")
    document = manifest.read(spark.read.text(f"{at}/manifest").withColumnRenamed("value", "text"))
    problem = F.coalesce(F.when(F.col("m").isNull(), F.array(F.struct(F.lit("manifest").alias("check"), F.lit("not a manifest").alias("message")))), manifest.problems(F.col("m")))
    bad = document.select(F.explode(problem).alias("p")).select(F.lit(checks.ERROR).alias("severity"), "p.check", F.lit("manifest").alias("subject"), "p.message")
    if bad.take(1):
        return bad
    m = document.first()["m"]
    size, geo_px, geo_size, rgb_px = options.block_px, _lattice_px(options), lattice_block(options), options.wgs_tile_px
    subject = F.concat_ws(",", "ix", "iy")
    tiles, geo_tiles, rgb_tiles = (_state(spark, at, n) for n in ("tiles", "lattice", "imagery"))
    heights, geo, rgb = (_declared(spark, path, k, t) for k, t in (("heights", tiles), ("lattice", geo_tiles), ("imagery", rgb_tiles)))
    found = []
    # VAL03, VAL04
    found.append(_tile_report(tiles, _facts(heights, options.tile_px, size), "tile", options.tile_px, options.plausible if options.plausibility else None))
    # VAL05: neighbours meet
    b = _grid(options).tile_bounds(F.col("ix"), F.col("iy"))
    seams = rasters.neighbours(tiles.select("ix", "iy", *(b[s].alias(s) for s in ("west", "south", "east", "north"))))
    found.append(checks.report(seams, F.concat_ws(",", "ix", "iy", "side"), [(checks.ERROR, "seam", F.abs(F.col("gap")) > checks.EDGE_TOLERANCE, "neighbours do not meet")]))
    # VAL07
    points = _state(spark, at, "test_points")
    if halo is None:
        halo = stored.with_halo(heights.select("bx", "by", "values"), size)
    again = sample_halo(points.withColumnRenamed("height", "recorded"), halo, options)
    found.append(checks.recomputed(again, F.concat_ws(",", "lat", "lon"), "recorded", "height"))
    said = m["test_points"]["count"] if m["test_points"] else None
    found.append(checks.report(points.agg(F.count(F.lit(1)).alias("n")), F.lit("test points"), [(checks.ERROR, "test points", F.lit(said is None), "not declared"), (checks.ERROR, "test points", F.col("n") != F.lit(said), "another number than declared")]))
    # VAL08, VAL09: the lattice holds what a sample gives
    picks = blocks.spot_picks(geo.drop("build"), geo_size).withColumns({"lon": grid.LATTICE_WEST + (F.col("col") + 0.5) * _degrees(options), "lat": grid.LATTICE_NORTH - (F.col("row") + 0.5) * _degrees(options)})
    now = sample_halo(picks, halo, options).select("ix", "iy", "col", "row", F.col("v").cast("double").alias("recorded"), F.col("height").cast("float").cast("double").alias("height"))
    windows = _state(spark, at, "worlds").select(F.col("name").alias("window_id"), *lattice.NAMES)
    found += [
        _tile_report(geo_tiles, _facts(geo, geo_px, geo_size), "lattice", geo_px),
        checks.recomputed(now, F.concat_ws(",", "ix", "iy", "col", "row"), "recorded", "height"), checks.coverage(_covered(geo, windows, geo_size), F.col("window_id")),
    ]
    # VAL10
    if m["wgs"]["rgb_pattern"]:
        scaled = windows.select("window_id", *((F.col(c) * options.wgs_height_factor).alias(c) for c in lattice.NAMES))
        found += [_tile_report(rgb_tiles, _facts(rgb, rgb_px, size), "imagery", rgb_px), checks.coverage(_covered(rgb, scaled, size), F.concat_ws(" ", F.lit("imagery"), "window_id"))]
    # VAL11
    declared = lambda pairs: spark.createDataFrame([(t["ix"], t["iy"]) for t in pairs or []], "ix long, iy long")
    named = spark.createDataFrame([(w,) for w in m["worlds"] or []], "name string")
    for name, a, z, keys in (("tiles", tiles, declared(m["tiles"]), ["ix", "iy"]), ("lattice", geo_tiles, declared(m["wgs"]["tiles"]), ["ix", "iy"]), ("worlds", _state(spark, at, "worlds"), named, ["name"])):
        off = catalogue.differences(a, z, keys)
        found.append(checks.report(off, F.concat_ws(" ", F.lit(name), F.concat_ws(",", *keys)), [(checks.ERROR, "catalogue", F.lit(True), "only in the catalogue or only in the manifest")]))
    for links, known in (("links", tiles), ("lattice_links", geo_tiles)):
        lone = _state(spark, at, links).join(known, ["ix", "iy"], "left_anti")
        found.append(checks.report(lone, F.concat_ws(" ", "world", subject), [(checks.ERROR, "link", F.lit(True), "to a tile that is not declared")]))
    version = m["worlds_db"]["schema_version"] if m["worlds_db"] else None
    if version != CATALOGUE_VERSION:
        found.append(spark.createDataFrame([(checks.ERROR, "catalogue", "version", f"{version}, not {CATALOGUE_VERSION}")], "severity string, check string, subject string, message string"))
    return checks.extend(*found)


def stray(spark: SparkSession, path: str) -> DataFrame:
    """Warnings for folders of tiles that no declared tile is in, and for what unfinished builds left (VAL13)."""
    found = [(p,) for p in storage.listed(spark, path)]
    rows = [spark.createDataFrame(found, "path string").where(F.col("path").contains(".tmp-")).select(F.lit(checks.WARNING).alias("severity"), F.lit("leftover").alias("check"), F.col("path").alias("subject"), F.lit("left by a write").alias("message"))]
    for kind, name in (("heights", "tiles"), ("lattice", "lattice"), ("imagery", "imagery")):
        there = spark.createDataFrame(storage.partitions(spark, f"{path}/{kind}"), "build string, ix long, iy long")
        lone = there.join(_state(spark, f"{path}/state", name), ["build", "ix", "iy"], "left_anti")
        rows.append(checks.report(lone, F.concat_ws(" ", F.lit(kind), F.concat_ws(",", "build", "ix", "iy")), [(checks.WARNING, "stray", F.lit(True), "not declared")]))
    return checks.extend(*rows)


def collect_garbage(spark: SparkSession, path: str) -> int:
    """Deletes tiles that the state does not declare, and leftovers; how many tiles. Readers of an older state lose them."""
    n = 0
    for kind, name in (("heights", "tiles"), ("lattice", "lattice"), ("imagery", "imagery")):
        there = spark.createDataFrame(storage.partitions(spark, f"{path}/{kind}"), "build string, ix long, iy long")
        for r in there.join(_state(spark, f"{path}/state", name), ["build", "ix", "iy"], "left_anti").toLocalIterator():
            storage.remove(spark, f"{path}/{kind}/build={r['build']}/ix={r['ix']}/iy={r['iy']}")
            n += 1
    storage.clean(spark, path)
    return n


def described(spark: SparkSession, path: str, options: PrepareOptions | None = None) -> PrepareOptions:
    """options with the grids and datum that a dataset's manifest tells, as far as it does."""
    o, at = options or PrepareOptions(), f"{path}/state/manifest"
    m = manifest.read(spark.read.text(at).withColumnRenamed("value", "text")).first()["m"] if storage.exists(spark, at) else None
    if m is None:
        return o
    h, g, s, w = (m[k] or {} for k in ("heightmap", "grid", "storage", "wgs"))
    told = {
        "datum": h and h["vertical_datum"], "nodata": h and h["nodata"], "resolution": g and g["resolution_x"], "origin_x": g and g["origin_x"], "origin_y": g and g["origin_y"], "tile_px": g and g["tile_width_px"],
        "block_px": s and s["block_width_px"], "rgb_resolution_m": w and w["resolution_m"], "wgs_height_factor": w and w["height_factor"], "wgs_tile_px": w and w["tile_px"]}
    try:
        return replace(o, **{k: v for k, v in told.items() if v is not None and v != {}})
    except OptionError:  # validation says what is wrong with the manifest
        return o


def validate(spark: SparkSession, path: str, options: PrepareOptions | None = None) -> DataFrame:
    """The whole report of a dataset: all checks of its state, strays and leftovers."""
    options = described(spark, path, options)
    found = validate_state(spark, path, f"{path}/state", options)
    return found if not storage.exists(spark, f"{path}/state/manifest") else checks.extend(found, stray(spark, path))


# reading


@dataclass(frozen=True)
class WorldDataset:
    """A finished dataset, read by world."""

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        if not storage.exists(self.spark, f"{self.path}/state/manifest"):
            raise FileNotFoundError(f"{self.path} is no dataset")
        problem = manifest.read(self.spark.read.text(f"{self.path}/state/manifest").withColumnRenamed("value", "text")).select(manifest.strict_problem(F.col("m")).alias("p")).first()["p"]
        if problem:
            raise ValueError(f"{self.path} cannot be read: {problem}")

    def _table(self, name: str) -> DataFrame:
        return _state(self.spark, f"{self.path}/state", name)

    @cached_property
    def options(self) -> PrepareOptions:
        return described(self.spark, self.path)

    @cached_property
    def info(self) -> dict:
        """The manifest."""
        return json.loads(self.spark.read.text(f"{self.path}/state/manifest").first()[0])

    def worlds(self) -> DataFrame:
        return self._table("worlds")

    def world_names(self) -> list[str]:
        return [r["name"] for r in self.worlds().select("name").orderBy("name").toLocalIterator()]

    def world(self, name: str) -> dict:
        found = self.worlds().where(F.col("name") == name).take(1)
        if not found:
            raise WorldNotFoundError(name)
        return found[0].asDict()

    def safety_area(self, name: str) -> list[tuple[float, float]]:
        """The polygon of a world as longitudes and latitudes, in order."""
        self.world(name)
        return [(r["lon"], r["lat"]) for r in self._table("vertices").where(F.col("world") == name).orderBy("seq").toLocalIterator()]

    @property
    def wgs(self) -> dict:
        return self.info["wgs"]

    @property
    def has_rgb(self) -> bool:
        return bool(self.wgs.get("rgb_pattern"))

    def wgs_tiles(self, name: str) -> DataFrame:
        """ix, iy and filled window of the lattice's tiles that a world meets."""
        self.world(name)
        return catalogue.tiles_of(self._table("lattice_links").where(F.col("world") == name), self._table("lattice")).select("ix", "iy", "filled")

    def fill_window(self, name: str) -> dict:
        """The world's window of the lattice."""
        w = self.world(name)
        return {c: w[c] for c in lattice.NAMES}

    def _window(self, name: str, k: int = 1) -> DataFrame:
        return self.spark.createDataFrame([(0, *(v * k for v in self.fill_window(name).values()))], "window_id int, col_min long, row_min long, width long, height long")

    def read_height(self, name: str) -> DataFrame:
        """col, row, v of the world's window of the lattice, counted from its corner, NULL where there is no height."""
        window = self._window(name)
        table = _declared(self.spark, self.path, "lattice", self.wgs_tiles(name).join(self._table("lattice"), ["ix", "iy"]).select("build", "ix", "iy"))
        return blocks.fill_windows(blocks.window_scan(table, window, lattice_block(self.options)), window).drop("window_id")

    def read_rgb(self, name: str) -> DataFrame:
        """col, row, r, g, b, mask of the same window in imagery; colours are 0 where nothing was seen."""
        if not self.has_rgb:
            raise ValueError(f"{self.path} has no imagery")
        window = self._window(name, self.options.wgs_height_factor)
        table = _declared(self.spark, self.path, "imagery", self.wgs_tiles(name).join(self._table("imagery"), ["ix", "iy"]).select("build", "ix", "iy"))
        px = blocks.fill_windows(blocks.window_scan(table, window, self.options.block_px), window)
        band = lambda k: F.coalesce(F.shiftright("v", k).bitwiseAND(F.lit(255)), F.lit(0)).cast("short")
        return px.select("col", "row", band(16).alias("r"), band(8).alias("g"), band(0).alias("b"), F.col("v").isNotNull().alias("mask"))

    def sample(self, places: DataFrame, key: list[str]) -> DataFrame:
        """key and height of places (key, lon, lat), NULL where a pixel around them has none."""
        return sample(places, key, read_heights(self.spark, self.path), self.options)


def world_heights(spark: SparkSession, path: str, world: str, windows: DataFrame, options: PrepareOptions) -> DataFrame:
    """col, row and v of a world's window of the tile grid, counted from its corner, NULL where there is no height."""
    own = windows.where(F.col("window_id") == world)
    scanned = blocks.window_scan(read_heights(spark, path), own, options.block_px)
    return blocks.fill_windows(scanned, own).drop("window_id")
