"""Queries on sources that fetch: a transport that answers by a formula, and fails the first time for most requests."""

from __future__ import annotations

import json
import zlib

import numpy as np
from pyspark.sql import functions as F

from ..operators import storage
from ..operators.grid import TileGrid
from ..sources import images
from ..sources.heights import read_in_pieces
from ..sources.replies import ReplyStore
from ..sources.services import Client, Reply, ServiceSource, height_service, imagery_service, read_service
from . import inputs
from .blocks import WIN, _windows
from .registry import query

GRID = TileGrid(-900_000.0, -930_000.0, 64, 2.0)
#: Degrees of a pixel of the imagery; a power of 2, so that bounds are exact.
DEGREES = 1 / 1024


class FormulaTransport:
    """Answers a request as its numbers say: heights are a plane with holes, images have a colour for each pixel."""

    def __init__(self) -> None:
        self.tried: dict[str, int] = {}

    def get(self, url, params, timeout_s):
        if params is None:  # the link of an image: its name holds the window
            col, row, w, h = map(int, url.rpartition("/")[2].split(".")[0].split("_"))
            r, c = np.mgrid[row : row + h, col : col + w]
            return Reply(200, "image/png", images.encode_png(np.stack([c % 256, r * 3 % 256, c * 0 + 128, np.where((c + r) % 5 == 0, 0, 255)], 2)))
        box = params["bbox"]
        self.tried[box] = self.tried.get(box, 0) + 1
        how = zlib.crc32(box.encode()) % 4
        if self.tried[box] == 1 and how:
            if how == 1:
                raise TimeoutError("slow")
            return Reply(503 if how == 2 else 200, "image/tiff", b"")
        del self.tried[box]  # a task remembers what it is to be asked again, not all it was asked
        west, south, east, north = map(float, box.split(","))
        w, h = map(int, params["size"].split(","))
        if params["f"] == "json":
            col, row = round((west + 180) / DEGREES), round((90 - north) / DEGREES)
            return Reply(200, "application/json", json.dumps({"href": f"http://made.up/{col}_{row}_{w}_{h}.png", "width": w, "height": h, "extent": {"xmin": west, "ymin": south, "xmax": east, "ymax": north, "spatialReference": {"wkid": 4326}}}).encode())
        col, row = round((west - GRID.origin_x) / GRID.resolution), round((GRID.origin_y - north) / GRID.resolution)
        r, c = np.mgrid[row : row + h, col : col + w]
        v = np.where((c + r) % 7 == 0, np.nan, 0.25 * c - 0.125 * r + 100)
        return Reply(200, "image/tiff", images.encode_tiff(v, west, north, GRID.resolution, 5514, -9999.0, deflate=w % 2 == 0))


def client() -> Client:
    return Client(FormulaTransport(), retries=2, backoff_s=0.0)


EACH = f"{WIN}, y as (select window_id, c, r, width, unnest(range(0, height)) + r as row from w), x as (select *, unnest(range(0, width)) + c as col from y)"
V = "cast(0.25e0 * col - 0.125e0 * row + 100 as float)"


@query("src13_fetched_heights", f"with {EACH} select window_id, col, row, {V} as v from x where (col + row) % 7 <> 0")
def src13_fetched(spark, sf_dir):
    """Windows read from a server of heights, 4 pixels a side at once, most of its requests made twice."""
    source = ServiceSource(height_service(client(), "http://made.up/heights", GRID), ReplyStore(storage.scratch(spark, "replies")))
    return read_in_pieces(source, _windows(spark, sf_dir), 4).select("window_id", "col", "row", "v")


@query("src15_fetched_imagery", f"with {EACH} select window_id, col, row, cast(col % 256 as smallint) as r, cast(row * 3 % 256 as smallint) as g, 128::smallint as b, case when (col + row) % 5 = 0 then 0::smallint else 255::smallint end as a from x")
def src15_fetched(spark, sf_dir):
    """Windows drawn by a server of imagery: asked for, checked by its answer, and fetched."""
    source = ServiceSource(imagery_service(client(), "http://made.up/images", DEGREES), ReplyStore(storage.scratch(spark, "replies")))
    return source.read_rgba(_windows(spark, sf_dir)).select("window_id", "col", "row", "r", "g", "b", "a")


@query("src13_data_source", f"""with e as (select max(p_partkey) // 50 + 1 as n from part), r as (select unnest(range(4, n)) as row from e), p as (select row, unnest(range(7, 30)) as col from r) select col, row, {V} as v from p where (col + row) % 7 <> 0""")
def src13_source(spark, sf_dir):
    """The data source read over as many rows of pixels as `part` fills, a request a partition."""
    rows = inputs.table(spark, sf_dir, "part").agg(F.floor(F.max("p_partkey") / 50) + 1).first()[0]
    service = height_service(client(), "http://made.up/heights", GRID)
    return read_service(spark, service, (0, 0, 50, rows), 16).where("col >= 7 and col < 30 and row > 3")


@query("src17_reply_store", """select s_suppkey as window_id, s_suppkey % 3 <> 0 or s_suppkey % 5 = 0 as fetched, s_suppkey % 3 = 0 and s_suppkey % 5 = 0 as was_corrupt from supplier""")
def src17_store(spark, sf_dir):
    """A second build fetches what the first one did not, and what has been damaged since; here every third window is
    there, and of these every fifth was spoilt."""
    k = F.col("s_suppkey")
    windows = inputs.table(spark, sf_dir, "supplier").select(k.alias("window_id"), (k * 3).alias("col_min"), (k * 2).alias("row_min"), F.lit(4).alias("width"), F.lit(3).alias("height"))
    first = ReplyStore(storage.scratch(spark, "replies"))
    source = ServiceSource(height_service(client(), "http://made.up/heights", GRID), first)
    source.read(windows.where("window_id % 3 = 0")).count()
    store = ReplyStore(storage.scratch(spark, "replies"))
    keys = source.keys(windows)
    spoilt = first.entries(spark).join(keys, "key").withColumn("body", F.when(F.col("window_id") % 5 == 0, F.unhex(F.lit("00"))).otherwise(F.col("body")))
    spoilt.select("key", "body", "sha256").write.parquet(f"{store.path}/batch=0")
    again = ServiceSource(source.service, store)
    again.read(windows).count()
    new = store.entries(spark).where("batch <> '0'").select("key", F.lit(True).alias("new"))
    bad = store.corrupt(spark).select("key", F.lit(True).alias("bad"))
    out = keys.join(new, "key", "left").join(bad, "key", "left")
    return out.select("window_id", F.coalesce("new", F.lit(False)).alias("fetched"), F.coalesce("bad", F.lit(False)).alias("was_corrupt"))
