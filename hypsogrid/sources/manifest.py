"""Dataset manifests: JSON documents with a fixed schema, read leniently or strictly, checked and written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FORMAT_VERSION = 2
SCHEMA = (
    "format_version int, status string, created_utc string, updated_utc string, "
    "heightmap struct<horizontal_crs: string, vertical_crs: string, vertical_datum: string, unit: string, dtype: string, nodata: double>, "
    "grid struct<origin_x: double, origin_y: double, resolution_x: double, resolution_y: double, tile_width_px: int, tile_height_px: int, axis_order: string>, "
    "storage struct<format: string, compression: string, tile_pattern: string, block_width_px: int, block_height_px: int>, "
    "source struct<source_id: string, vertical_datum: string, rgb_source_id: string>, "
    "transform struct<method: string, steps: array<struct<grid: string, sign: int>>, accuracy_m: double, checksums: map<string, string>>, "
    "tiles array<struct<ix: bigint, iy: bigint>>, worlds array<string>, test_points struct<path: string, `count`: bigint, columns: array<string>>, "
    "wgs struct<crs: string, resolution_m: double, resolution_deg: double, height_factor: int, tile_px: int, height_pattern: string, rgb_pattern: string, tiles: array<struct<ix: bigint, iy: bigint>>>, "
    "worlds_db struct<path: string, schema_version: int>, software map<string, string>"
)
KNOWN = ("format_version", "status", "created_utc", "updated_utc", "heightmap", "grid", "storage", "source", "transform", "tiles", "worlds", "test_points", "wgs", "worlds_db", "software")


def read(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with `m`, missing keys NULL, and `more`, the sections that the schema does not know; both are NULL if the
    text is no JSON object."""
    whole = F.try_parse_json(text)
    return documents.withColumns({"m": F.from_json(text, SCHEMA), "more": F.map_filter(whole.try_cast("map<string, variant>"), lambda k, _: ~k.isin(*KNOWN))})


def write(manifests: DataFrame, now: Column) -> DataFrame:
    """manifests (with `m`, and `more` if it is there) with `document`: keys in the order of the schema, updated_utc set,
    then the sections that the schema does not know, as they were."""
    known = F.to_json(F.col("m").withField("updated_utc", now))
    if "more" not in manifests.columns:
        return manifests.withColumn("document", known)
    key = lambda k: F.regexp_replace(F.to_json(F.array(k)), r"^\[|\]$", "")
    pairs = F.transform(F.map_entries("more"), lambda e: F.concat(key(e["key"]), F.lit(":"), F.to_json(e["value"])))
    more = F.when(F.size(pairs) > 0, F.concat(F.when(known != "{}", ",").otherwise(""), F.array_join(pairs, ",")))
    return manifests.withColumn("document", F.concat(F.regexp_replace(known, r"\}$", ""), F.coalesce(more, F.lit("")), F.lit("}")))


def strict_problem(m: Column) -> Column:
    """Why a manifest cannot be sampled from, or NULL."""
    g, s = m["grid"], m["storage"]
    return (
        F.when(m.isNull(), "not a manifest").when(~F.coalesce(m["format_version"] == FORMAT_VERSION, F.lit(False)), "unsupported version")
        .when(~F.coalesce(m["status"] == "complete", F.lit(False)), "not complete").when(~F.coalesce(g["axis_order"] == "east_north", F.lit(False)), "axis order")
        .when(~F.coalesce((g["resolution_x"] > 0) & (g["resolution_y"] > 0) & (g["tile_width_px"] > 0) & (g["tile_height_px"] > 0), F.lit(False)), "sizes")
        .when(pattern_problem(s["tile_pattern"]).isNotNull(), "pattern")
    )


def pattern_problem(pattern: Column) -> Column:
    """A tile pattern names both indices and a path that stays inside the dataset."""
    inner = F.replace(F.replace(pattern, F.lit("{ix}"), F.lit("0")), F.lit("{iy}"), F.lit("0"))
    return (
        F.when(pattern.isNull(), "missing").when(~pattern.contains("{ix}") | ~pattern.contains("{iy}"), "lacks an index").when(inner.rlike("[{}]"), "malformed")
        .when(inner.startswith("/") | inner.rlike(r"(^|/)[.][.](/|$)"), "leaves the dataset")
    )


def problems(m: Column) -> Column:
    """All errors of a manifest, as an array of (check, message)."""
    h, g, s, w = m["heightmap"], m["grid"], m["storage"], m["wgs"]
    absent = lambda c: F.coalesce(c, F.lit("")) == ""
    never = lambda c: ~F.coalesce(c, F.lit(False))
    patterns = F.filter(F.array(s["tile_pattern"], w["height_pattern"], w["rgb_pattern"]), lambda p: p.isNotNull())
    rules = [
        ("version", never(m["format_version"] == FORMAT_VERSION), "unsupported format_version"),
        ("crs", epsg_of(h["horizontal_crs"]).isNull(), "horizontal_crs is missing or not resolvable"), ("vertical", absent(h["vertical_crs"]), "vertical_crs is missing"),
        ("unit", never(h["unit"] == "m"), "unit must be m"), ("dtype", never(h["dtype"] == "float32"), "dtype must be float32"),
        ("nodata", never(F.abs(h["nodata"]) < float("inf")), "nodata must be finite"),
        ("resolution", never((g["resolution_x"] > 0) & (g["resolution_y"] > 0)), "resolution must be positive"),
        ("tile size", never((g["tile_width_px"] > 0) & (g["tile_height_px"] > 0)), "tile dimensions must be positive"),
        ("origin", never((F.abs(g["origin_x"]) < float("inf")) & (F.abs(g["origin_y"]) < float("inf"))), "origin must be finite"),
        ("axis order", never(g["axis_order"] == "east_north"), "axis_order must be east_north"),
        ("pattern", pattern_problem(s["tile_pattern"]).isNotNull(), "tile_pattern is unusable"),
        ("block size", never((s["block_width_px"] > 0) & (s["block_height_px"] > 0)), "block dimensions must be positive"),
        ("wgs crs", w.isNotNull() & never(epsg_of(w["crs"]) == 4326), "wgs crs must be EPSG:4326"),
        ("wgs resolution", w.isNotNull() & never((w["resolution_m"] > 0) & (w["resolution_deg"] > 0)), "wgs resolution must be positive"),
        *((f"{n} pattern", w[f"{n}_pattern"].isNotNull() & pattern_problem(w[f"{n}_pattern"]).isNotNull(), f"{n}_pattern is unusable") for n in ("height", "rgb")),
        ("unique patterns", F.size(patterns) != F.size(F.array_distinct(patterns)), "tile patterns must differ"),
    ]
    found = F.array(*(F.when(bad, F.struct(F.lit(check).alias("check"), F.lit(text).alias("message"))) for check, bad, text in rules))
    return F.filter(found, lambda r: r.isNotNull())


def epsg_of(crs: Column) -> Column:
    """The EPSG code that a CRS text names last (`EPSG:5514`, or an ID or AUTHORITY of WKT), NULL if none."""
    codes = F.regexp_extract_all(crs, F.lit(r'(?i)EPSG(?::|"\s*,\s*"?)([0-9]+)'), 1)
    return F.try_element_at(codes, F.lit(-1)).try_cast("int")
