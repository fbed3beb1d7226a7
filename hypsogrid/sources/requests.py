"""Requests to map servers as columns: parameters, cache keys, retries, and checks of what comes back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Replies after which a request is made again, and names of a server's ways to interpolate.
RETRIED = (408, 425, 429, 500, 502, 503, 504)
INTERPOLATIONS = {"nearest": "RSP_NearestNeighbor", "bilinear": "RSP_BilinearInterpolation", "cubic": "RSP_CubicConvolution"}


def elevation_parameters(west: Column, south: Column, east: Column, north: Column, width: Column, height: Column, epsg: int, nodata: float, how: str = "bilinear") -> Column:
    """Parameters of an image export of 32-bit heights."""
    if how not in INTERPOLATIONS:
        raise ValueError(f"interpolation is one of {', '.join(INTERPOLATIONS)}")
    pairs = {
        "bbox": F.array_join(F.array(*(F.format_string("%.6f", c) for c in (west, south, east, north))), ","), "bboxSR": F.lit(str(epsg)), "imageSR": F.lit(str(epsg)),
        "size": F.concat_ws(",", width.cast("string"), height.cast("string")), "format": F.lit("tiff"), "pixelType": F.lit("F32"),
        "noData": F.lit(f"{nodata:g}"), "interpolation": F.lit(INTERPOLATIONS[how]), "f": F.lit("image"),
    }
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v)))


def render_parameters(west: Column, south: Column, east: Column, north: Column, width: Column, height: Column) -> Column:
    """Parameters of a drawing in degrees, answered by JSON."""
    pairs = {
        "bbox": F.array_join(F.array(*(F.format_string("%.12f", c) for c in (west, south, east, north))), ","), "bboxSR": F.lit("4326"), "imageSR": F.lit("4326"),
        "size": F.concat_ws(",", width.cast("string"), height.cast("string")), "format": F.lit("png32"), "transparent": F.lit("true"), "f": F.lit("json"),
    }
    return F.create_map(*(x for k, v in pairs.items() for x in (F.lit(k), v)))


def interpolation(name: Column) -> Column:
    """A server's name for a way to interpolate, NULL if it is not known."""
    rules = F.create_map(*(F.lit(x) for pair in INTERPOLATIONS.items() for x in pair))
    return F.try_element_at(rules, name)


def cache_key(url: Column, parameters: Column) -> Column:
    """SHA-256 of the canonical JSON of a request: its URL and its parameters in the order of their names."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(parameters)))
    return F.sha2(F.to_json(F.struct(ordered.alias("params"), url.alias("url"))), 256)


def retry(status: Column, attempt: Column, attempts: int, base_s: float) -> Column:
    """Seconds to wait before the next attempt (doubling), or NULL: done, refused for good, or out of attempts. A NULL
    status is a timeout or an empty body."""
    again = status.isNull() | status.isin(*RETRIED)
    return F.when(again & (attempt < attempts), base_s * F.pow(F.lit(2.0), attempt - 1))


def decode_problem(bands: Column, width: Column, height: Column, epsg: Column, pixel: Column, left: Column, top: Column, want_width: Column, want_height: Column, want_epsg: int, want_pixel: float, want_left: Column, want_top: Column) -> Column:
    """Why a returned raster is not what was asked for: bands, size, system, pixel size, or a corner off by half a pixel."""
    return (
        F.when(bands != 1, "bands").when((width != want_width) | (height != want_height), "size").when(~epsg.eqNullSafe(F.lit(want_epsg)), "crs")
        .when(F.abs(pixel - want_pixel) > 1e-6 * want_pixel, "pixel size").when((F.abs(left - want_left) > want_pixel / 2) | (F.abs(top - want_top) > want_pixel / 2), "origin")
    )


def extent_problem(reply: Column, width: Column, height: Column, west: Column, south: Column, east: Column, north: Column, tolerance_px: float = 0.25) -> Column:
    """Why a render's JSON reply does not match its request: no link, another size, or an extent off by more than the tolerance."""
    r = F.from_json(reply, "href string, width int, height int, extent struct<xmin: double, ymin: double, xmax: double, ymax: double, spatialReference: struct<wkid: int>>, error string")
    e, px, py = r["extent"], (east - west) / width * tolerance_px, (north - south) / height * tolerance_px
    off = (F.abs(e["xmin"] - west) > px) | (F.abs(e["xmax"] - east) > px) | (F.abs(e["ymin"] - south) > py) | (F.abs(e["ymax"] - north) > py)
    wkid = F.coalesce(e["spatialReference"]["wkid"], F.lit(4326))
    return F.when(r["error"].isNotNull(), "refused").when(r["href"].isNull(), "no link").when(wkid != 4326, "crs").when((r["width"] != width) | (r["height"] != height), "size").when(F.coalesce(off, F.lit(True)), "extent")
