"""Map servers as sources: requests with retries inside tasks, replies checked, a Python data source, and a source for builds.

A transport is an object with `get(url, params, timeout_s) -> Reply`; it is pickled to the tasks. `HttpTransport` speaks
HTTP. A status of RETRIED, a timeout, a broken connection and an empty body are tried again, each wait twice as long as
the one before; any other status, and JSON in place of an image, are refusals and end the read.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from ..operators.grid import LATTICE_NORTH, LATTICE_WEST, TileGrid
from . import images, requests
from .replies import ReplyStore

#: How far, in pixels, the extent of an answer may be off.
EXTENT_TOLERANCE_PX = 0.25
#: Bytes of replies, or of what has been decoded, that a task gathers before it hands them on.
HELD_BYTES = 4 << 20


class ServiceError(OSError):
    """A server that does not answer, or refuses."""


class Reply(NamedTuple):
    status: int
    content_type: str
    body: bytes


class Transport(Protocol):
    def get(self, url: str, params: dict[str, str] | None, timeout_s: float) -> Reply: ...


class HttpTransport:
    """GET by HTTP."""

    def __init__(self, user_agent: str = "hypsogrid") -> None:
        self.user_agent = user_agent

    def get(self, url: str, params: dict[str, str] | None, timeout_s: float) -> Reply:
        import urllib.error
        import urllib.parse
        import urllib.request

        full = url + ("?" + urllib.parse.urlencode(params) if params else "")
        try:
            with urllib.request.urlopen(urllib.request.Request(full, headers={"User-Agent": self.user_agent}), timeout=timeout_s) as r:
                return Reply(r.status, r.headers.get("Content-Type", ""), r.read())
        except urllib.error.HTTPError as e:
            return Reply(e.code, e.headers.get("Content-Type", ""), e.read())


@dataclass(frozen=True)
class Client:
    """A transport and how often and how long it is tried."""

    transport: Transport
    retries: int = 3
    timeout_s: float = 120.0
    backoff_s: float = 1.5
    sleep: Callable[[float], None] = time.sleep

    def fetch(self, url: str, params: dict[str, str] | None, expect_json: bool = False) -> bytes:
        what = f"{url} for {params.get('bbox', params)}" if params else url
        why = "no attempt"
        for attempt in range(max(1, self.retries)):
            if attempt:
                self.sleep(self.backoff_s * 2 ** (attempt - 1))
            try:
                reply = self.transport.get(url, params, self.timeout_s)
            except OSError as e:  # timeouts and broken connections
                why = repr(e)
                continue
            if reply.status in requests.RETRIED:
                why = f"status {reply.status}"
            elif reply.status != 200:
                raise ServiceError(f"{what}: status {reply.status}: {reply.body[:200]!r}")
            elif not expect_json and "json" in reply.content_type.lower():
                raise ServiceError(f"{what} was refused: {reply.body[:200]!r}")
            elif reply.body:
                return reply.body
            else:
                why = "an empty body"
        raise ServiceError(f"{what} failed {max(1, self.retries)} times, the last time with {why}")


Bounds = tuple[float, float, float, float]


def checked_heights(body: bytes, bounds: Bounds, width: int, height: int, epsg: int) -> np.ndarray:
    """The pixels of an elevation reply that is what was asked for, NaN where there is none."""
    r, (west, south, east, north) = images.decode_tiff(body), bounds
    want_x, want_y = (east - west) / width, (north - south) / height
    shape = (r.values.shape[1], r.values.shape[0])
    problem = (
        f"{r.bands} bands" if r.bands != 1 else f"{shape} pixels, not {(width, height)}" if shape != (width, height) else f"EPSG:{r.epsg}, not {epsg}" if r.epsg != epsg
        else f"pixels of {r.pixel_x} by {r.pixel_y}" if max(abs(r.pixel_x - want_x), abs(r.pixel_y - want_y)) > 1e-6 * max(want_x, want_y, 1.0)
        else f"a corner at {r.west}, {r.north}" if not (abs(r.west - west) <= want_x / 2 and abs(r.north - north) <= want_x / 2) else None)
    if problem:
        raise images.ImageError(f"the reply for {bounds} has {problem}")
    return r.values


def checked_pixels(body: bytes, width: int, height: int) -> np.ndarray:
    pixels = images.decode_png(body)
    if pixels.shape[:2] != (height, width):
        raise images.ImageError(f"the image has {pixels.shape[1]} by {pixels.shape[0]} pixels, not {width} by {height}")
    return pixels


def render(client: Client, url: str, params: dict[str, str], bounds: Bounds, width: int, height: int) -> bytes:
    """Asks a server to draw, checks where what it drew lies, and fetches the image."""
    body = client.fetch(url, params, expect_json=True)
    try:
        reply = json.loads(body)
    except ValueError as e:
        raise ServiceError(f"{url} answered with no JSON: {body[:200]!r}") from e
    if not isinstance(reply, dict) or "error" in reply or not isinstance(reply.get("extent"), dict) or not reply.get("href"):
        raise ServiceError(f"{url} drew nothing: {str(reply)[:200]}")
    extent = reply["extent"]
    if reply.get("width", width) != width or reply.get("height", height) != height:
        raise images.ImageError(f"{url} drew {reply.get('width')} by {reply.get('height')} pixels, not {width} by {height}")
    if (extent.get("spatialReference") or {}).get("wkid") not in (None, 4326):
        raise images.ImageError(f"{url} drew in another coordinate system")
    try:
        got = [float(extent[k]) for k in ("xmin", "ymin", "xmax", "ymax")]
    except (KeyError, TypeError, ValueError) as e:
        raise images.ImageError(f"{url} gave no readable extent") from e
    if any(abs(a - b) > EXTENT_TOLERANCE_PX * (bounds[2] - bounds[0]) / width for a, b in zip(got, bounds)):
        raise images.ImageError(f"{url} drew {got}, not {bounds}")
    return client.fetch(str(reply["href"]), None)


# the data source


@dataclass
class Piece(InputPartition):
    """One request."""

    col_min: int
    row_min: int
    width: int
    height: int


@dataclass(frozen=True)
class Service:
    """A server's layer over a grid of pixels: heights (EPSG:5514 metres) or imagery (EPSG:4326 degrees)."""

    client: Client
    url: str
    origin: tuple[float, float]
    resolution: float
    kind: str = "heights"
    epsg: int = 5514
    nodata: float = -9999.0
    interpolation: str = "bilinear"

    def bounds(self, col: int, row: int, width: int, height: int) -> Bounds:
        (x, y), r = self.origin, self.resolution
        return x + col * r, y - (row + height) * r, x + (col + width) * r, y - row * r

    def params(self, bounds: Bounds, width: int, height: int) -> dict[str, str]:
        """The same as the columns of `requests`."""
        if self.kind == "heights":
            return {"bbox": ",".join(f"{b:.6f}" for b in bounds), "bboxSR": str(self.epsg), "imageSR": str(self.epsg), "size": f"{width},{height}", "format": "tiff", "pixelType": "F32",
                    "noData": f"{self.nodata:g}", "interpolation": requests.INTERPOLATIONS[self.interpolation], "f": "image"}
        return {"bbox": ",".join(f"{b:.12f}" for b in bounds), "bboxSR": "4326", "imageSR": "4326", "size": f"{width},{height}", "format": "png32", "transparent": "true", "f": "json"}

    def body(self, col: int, row: int, width: int, height: int) -> bytes:
        """A reply that has been checked."""
        bounds = self.bounds(col, row, width, height)
        params = self.params(bounds, width, height)
        if self.kind == "heights":
            body = self.client.fetch(self.url + "/exportImage", params)
            checked_heights(body, bounds, width, height, self.epsg)
        else:
            body = render(self.client, self.url + "/export", params, bounds, width, height)
            checked_pixels(body, width, height)
        return body

    def values(self, body: bytes, col: int, row: int, width: int, height: int) -> np.ndarray:
        """Heights, or pixels packed as 0xRRGGBBAA, in reading order."""
        if self.kind == "heights":
            return checked_heights(body, self.bounds(col, row, width, height), width, height, self.epsg).ravel()
        p = checked_pixels(body, width, height).reshape(-1, 4).astype(np.int64)
        return p[:, 0] << 24 | p[:, 1] << 16 | p[:, 2] << 8 | p[:, 3]


SCHEMAS = {"heights": "col bigint, row bigint, v float", "imagery": "col bigint, row bigint, r smallint, g smallint, b smallint, a smallint"}


class MapServiceSource(DataSource):
    """`spark.read.format("map_service")` with the options service (see `option`), window (col, row, width, height),
    most_px and pushdown: pixels of a server, a partition for each request. Comparisons of col and row narrow the window, so that only
    requests are made that they need."""

    @classmethod
    def name(cls) -> str:
        return "map_service"

    def _service(self) -> Service:
        import base64
        import pickle

        return pickle.loads(base64.b64decode(self.options["service"]))

    def schema(self) -> str:
        return SCHEMAS[self._service().kind]

    def reader(self, schema) -> DataSourceReader:
        kind = PushingReader if self.options.get("pushdown") == "true" else MapServiceReader
        return kind(self._service(), tuple(int(x) for x in self.options["window"].split(",")), int(self.options.get("most_px", "2048")))


class MapServiceReader(DataSourceReader):
    def __init__(self, service: Service, window: tuple[int, int, int, int], most_px: int) -> None:
        self.service, self.most = service, most_px
        self.low = {"col": window[0], "row": window[1]}
        self.high = {"col": window[0] + window[2], "row": window[1] + window[3]}

    def narrow(self, filters):
        """Takes comparisons of col and row into the window; yields the filters that are left to do."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in self.low or not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or not isinstance(f.value, int):
                yield f
                continue
            if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                self.low[name] = max(self.low[name], f.value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                self.high[name] = min(self.high[name], f.value + (not isinstance(f, LessThan)))

    def partitions(self):
        steps = lambda n: range(self.low[n], self.high[n], self.most)
        return [Piece(c, r, min(self.most, self.high["col"] - c), min(self.most, self.high["row"] - r)) for r in steps("row") for c in steps("col")]

    def read(self, piece: Piece | None) -> Iterator:
        import pyarrow as pa

        if piece is None:  # what Spark gives where there are no partitions
            return
        at = (piece.col_min, piece.row_min, piece.width, piece.height)
        values = self.service.values(self.service.body(*at), *at)
        col = np.tile(np.arange(piece.width) + piece.col_min, piece.height)
        row = np.repeat(np.arange(piece.height) + piece.row_min, piece.width)
        if self.service.kind == "heights":
            keep = ~np.isnan(values)
            yield pa.RecordBatch.from_arrays([pa.array(col[keep]), pa.array(row[keep]), pa.array(values[keep], pa.float32())], ["col", "row", "v"])
        else:
            bands = [pa.array((values >> s & 255).astype(np.int16)) for s in (24, 16, 8, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(col), pa.array(row), *bands], ["col", "row", "r", "g", "b", "a"])


class PushingReader(MapServiceReader):
    """Spark refuses a reader with this method where pushdown is not enabled."""

    def pushFilters(self, filters):
        return self.narrow(filters)


def option(service: Service) -> str:
    """A service as the text of an option."""
    import base64

    from pyspark import cloudpickle

    return base64.b64encode(cloudpickle.dumps(service)).decode()


def read_service(spark: SparkSession, service: Service, window: tuple[int, int, int, int], most_px: int = 2048) -> DataFrame:
    """The pixels of a window. Filters of col and row are pushed down where spark.sql.python.filterPushdown.enabled is set."""
    spark.dataSource.register(MapServiceSource)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    return spark.read.format("map_service").option("pushdown", pushdown).option("service", option(service)).option("window", ",".join(map(str, window))).option("most_px", most_px).load()


# sources for builds


def _parts(found: Iterator, size: Callable, most: int) -> Iterator[list]:
    """What is found, in lists that end as soon as they reach `most`."""
    part, held = [], 0
    for x in found:
        part.append(x)
        held += size(x)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def _bounds(windows: DataFrame, s: Service) -> list[Column]:
    col, row, w, h = (F.col(c).cast("double") for c in ("col_min", "row_min", "width", "height"))
    (x, y), r = s.origin, s.resolution
    return [x + col * r, y - (row + h) * r, x + (col + w) * r, y - row * r]


@dataclass
class ServiceSource:
    """Heights or imagery of a server for windows that are rows: each window is a request, answered from the store of
    replies where that has it. Windows have to be as small as the server allows."""

    service: Service
    store: ReplyStore
    datum: str = "egm96"
    coverage: Bounds = (-float("inf"), -float("inf"), float("inf"), float("inf"))
    source_id: str = "map-service"
    native_origin: tuple[float, float] | None = None

    def keys(self, windows: DataFrame) -> DataFrame:
        """windows with the key of their request."""
        s, sides = self.service, _bounds(windows, self.service)
        if s.kind == "heights":
            params, path = requests.elevation_parameters(*sides, F.col("width"), F.col("height"), s.epsg, s.nodata, s.interpolation), "/exportImage"
        else:
            params, path = requests.render_parameters(*sides, F.col("width"), F.col("height")), "/export"
        return windows.withColumn("key", requests.cache_key(F.lit(s.url + path), params))

    def _decoded(self, windows: DataFrame) -> DataFrame:
        s, asked = self.service, self.keys(windows)
        at = ("col_min", "row_min", "width", "height")

        def bodies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = ((row.key, s.body(*(int(getattr(row, n)) for n in at))) for row in batch.itertuples(index=False))
                for part in _parts(found, lambda x: len(x[1]), HELD_BYTES):
                    yield pd.DataFrame(part, columns=["key", "body"])

        held = self.store.complete(asked.select("key", *at), bodies)
        kind = "array<float>" if s.kind == "heights" else "array<bigint>"

        @F.pandas_udf(kind)
        def decode(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for batch in batches:
                found = (s.values(b, *(int(x) for x in place)) for b, *place in zip(*batch))
                for part in _parts(found, lambda x: x.nbytes, HELD_BYTES):
                    yield pd.Series(part)

        met = asked.join(held, "key").select("window_id", *at, decode("body", *at).alias("p")).select("window_id", *at, F.posexplode("p").alias("i", "p"))
        return met.select("window_id", (F.col("col_min") + F.col("i") % F.col("width")).alias("col"), (F.col("row_min") + F.expr("i div width")).alias("row"), "p")

    def read(self, windows: DataFrame) -> DataFrame:
        return self._decoded(windows).where("not isnan(p)").withColumnRenamed("p", "v")

    def read_rgba(self, windows: DataFrame) -> DataFrame:
        band = lambda k: F.shiftright("p", k).bitwiseAND(F.lit(255)).cast("short")
        return self._decoded(windows).select("window_id", "col", "row", band(24).alias("r"), band(16).alias("g"), band(8).alias("b"), band(0).alias("a"))


def height_service(client: Client, url: str, grid: TileGrid, **more) -> Service:
    return Service(client, url, (grid.origin_x, grid.origin_y), grid.resolution, **more)


def imagery_service(client: Client, url: str, resolution_deg: float) -> Service:
    return Service(client, url, (LATTICE_WEST, LATTICE_NORTH), resolution_deg, "imagery", 4326)
