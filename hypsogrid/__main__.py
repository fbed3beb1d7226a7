"""Command line.

prepare WORLD_FILE... --output FOLDER   builds a dataset; heights come from a map server, or from blocks (--heights)
validate FOLDER                         prints the report
sample LON LAT [FOLDER]                 prints a height with 17 digits, or nan

Exit codes: 0 done, 1 errors in a report or a failed build, 2 wrong options, 130 interrupted.
"""

from __future__ import annotations

import argparse
import os
import sys
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import dataset
from .operators import checks, storage
from .operators.grid import TileGrid
from .options import INTERPOLATIONS, OptionError, PrepareOptions, default_dataset
from .sources import worlds
from .sources.heights import BlockSource
from .sources.replies import ReplyStore
from .sources.services import Client, HttpTransport, ServiceSource, height_service, imagery_service

FLAGS = {"overwrite": "replace tiles that cannot be used again", "rebuild": "replace all tiles", "include_rgb": "write imagery, too"}
HELP = {
    "resolution": "metres of a pixel", "tile_px": "pixels of a tile's side", "block_px": "pixels of a block's side", "origin_x": "western edge of tile 0, 0", "origin_y": "northern edge of tile 0, 0",
    "datum": "vertical datum of the dataset", "source_datum": "vertical datum of the source", "interpolation": f"of the server: {', '.join(INTERPOLATIONS)}", "most_request_px": "pixels of a request's side, at most",
    "timeout_s": "seconds that a request may take", "retries": "attempts of a request", "rgb_resolution_m": "metres of a pixel of imagery, north to south", "wgs_tile_px": "pixels of imagery of a geographic tile's side",
    "wgs_height_factor": "pixels of imagery of a pixel of heights", "nodata": "value of pixels without height", "undulations": "folder of undulation grids", "replies": "folder of the store of replies",
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hypsogrid")
    p.add_argument("--version", action="version", version=f"hypsogrid {dataset._version()}")
    p.add_argument("--log-level", default="WARN", choices=("DEBUG", "INFO", "WARN", "ERROR"))
    p.add_argument("--no-plausibility-checks", action="store_true")
    p.add_argument("--no-validation", action="store_true", help="do not check the tiles that a build wrote")
    p.add_argument("--origin", type=float, nargs=2, metavar=("X", "Y"), help="the same as --origin-x and --origin-y")
    kinds = {f.name: f.default for f in fields(PrepareOptions)}
    for name, text in HELP.items():
        kind = str if kinds[name] is None else type(kinds[name])
        p.add_argument("--" + name.replace("_", "-"), type=kind, default=kinds[name], help=f"{text} (default {kinds[name]})")
    for name, text in FLAGS.items():
        p.add_argument("--" + name.replace("_", "-"), action="store_true", help=text)
    commands = p.add_subparsers(dest="command", required=True)
    b = commands.add_parser("prepare")
    b.add_argument("inputs", nargs="+", help="world files, or one folder of them")
    b.add_argument("--output", required=True)
    b.add_argument("--heights", help="a folder of blocks (bx, by, values) in place of a server")
    b.add_argument("--url", help="address of the server of heights")
    b.add_argument("--rgb-url", help="address of the server of imagery")
    s = commands.add_parser("sample")
    s.add_argument("lon", type=float)
    s.add_argument("lat", type=float)
    s.add_argument("dataset", nargs="?", default=None)
    v = commands.add_parser("validate")
    v.add_argument("dataset")
    return p


def options_of(a: argparse.Namespace) -> PrepareOptions:
    given = {n: getattr(a, n) for n in (*HELP, *FLAGS)}
    if a.origin:
        given |= {"origin_x": a.origin[0], "origin_y": a.origin[1]}
    return PrepareOptions(**given, plausibility=not a.no_plausibility_checks, validate_tiles=not a.no_validation)


def _prepare(spark: SparkSession, a: argparse.Namespace, o: PrepareOptions) -> int:
    try:
        listing = worlds.named(spark, a.inputs)
    except worlds.InputError as e:
        print(e, file=sys.stderr)
        return 2
    kept, skipped = worlds.load(worlds.read_listed(spark, listing))
    client = Client(HttpTransport(), o.retries, o.timeout_s)
    store = ReplyStore(o.replies or storage.scratch(spark, "replies"))
    if a.heights:
        source = BlockSource(spark.read.parquet(a.heights), o.block_px, o.source_datum)
    elif a.url:
        grid = TileGrid(o.origin_x, o.origin_y, o.tile_px, o.resolution)
        source = ServiceSource(height_service(client, a.url, grid, nodata=o.nodata, interpolation=o.interpolation), store, o.source_datum)
    else:
        print("prepare needs --url or --heights", file=sys.stderr)
        return 2
    imagery = ServiceSource(imagery_service(client, a.rgb_url, o.rgb_resolution_m / dataset.lattice.METRES_PER_DEGREE), store) if a.rgb_url else None
    try:
        made = dataset.prepare(kept.select("name", "points"), a.output, o, source, imagery)
    except (dataset.BuildError, FileExistsError, ValueError) as e:
        print(f"not built: {e}", file=sys.stderr)
        return 1
    for r in skipped.select(F.col("path").alias("w"), "reason").unionByName(made.skipped.select(F.col("world").alias("w"), "reason")).orderBy("w").toLocalIterator():
        print(f"skipped {r['w']}: {r['reason']}", file=sys.stderr)
    for r in made.report.orderBy("severity", "check", "subject").toLocalIterator():
        print(f"{r['severity']}: {r['check']}: {r['subject']}: {r['message']}", file=sys.stderr)
    print(f"{made.kept.count()} worlds, {made.stats['written']} tiles written, {made.stats['reused']} used again")
    return 0


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        o = options_of(a)
    except OptionError as e:
        print(e, file=sys.stderr)
        return 2
    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel(a.log_level)
    try:
        if a.command == "prepare":
            return _prepare(spark, a, o)
        if a.command == "sample":
            where = a.dataset or default_dataset()
            o, table = dataset.described(spark, where, o), dataset.read_heights(spark, where)
            place = spark.createDataFrame([(0, a.lon, a.lat)], "id int, lon double, lat double")
            height = dataset.sample(place, ["id"], table, o).first()["height"]
            print("nan" if height is None else f"{height:.17g}")
            return 0
        found = dataset.validate(spark, a.dataset, o)
        for r in found.orderBy("severity", "check", "subject").toLocalIterator():
            print(f"{r['severity']}: {r['check']}: {r['subject']}: {r['message']}")
        return 0 if checks.verdict(found).first()["ok"] else 1
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    # the interpreter's own shutdown may wait for threads of the JVM
    code = main()
    sys.stdout.flush()
    os._exit(code) if code == 130 else sys.exit(code)
