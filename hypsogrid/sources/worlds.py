"""World files: YAML documents that describe a polygon. Parsing leaves the JVM once a file; every rule is a column."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The frame in which polygons are usable, and units of an origin.
FRAME, ORIGIN_UNITS, LEAST_VERTICES = "latlon_origin", ("LATLON", "UTM"), 3
#: Brackets, and characters of indentation on a line, beyond which a document may nest deeply.
_NESTED, _INDENTED = 200, re.compile(r"(?m)^[ ?:-]{200}")
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_PARSED = (
    "error string, frame string, is_list boolean, points array<string>, units string, origin_x string, origin_y string, "
    "vertical_frame string, min_z string, max_z string"
)


def discover(listing: DataFrame) -> DataFrame:
    """listing: path, position, from_directory. World files by their ending; those of a directory in the order of
    their paths, those named one by one as given. Adds `place`, by which to order."""
    yaml = F.lower("path").rlike(r"[.]ya?ml$")
    return listing.where(yaml).withColumn("place", F.when(F.col("from_directory"), F.struct(F.lit(0).cast("long").alias("position"), F.col("path"))).otherwise(F.struct("position", "path")))


class InputError(ValueError):
    """Inputs that name no world files, or mix a folder with files."""


def named(spark: SparkSession, inputs: list[str]) -> DataFrame:
    """The listing (path, position, from_directory) of inputs: one folder, or files one by one; a mixture, an input that is
    not there, and a folder without world files are errors."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    rows, folders = [], 0
    for i, name in enumerate(inputs):
        at = jvm.org.apache.hadoop.fs.Path(name)
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            raise InputError(f"{name} is not there")
        if fs.getFileStatus(at).isDirectory():
            folders += 1
            rows += [(str(s.getPath()), i, True) for s in fs.listStatus(at) if s.isFile()]
        else:
            rows.append((str(fs.makeQualified(at)), i, False))
    if folders and len(inputs) > 1:
        raise InputError("inputs are one folder or files, not both")
    found = spark.createDataFrame(rows, "path string, position int, from_directory boolean")
    if not discover(found).take(1):
        raise InputError(f"no world files in {', '.join(inputs)}")
    return found


def read_listed(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Documents (path, position, text) of a listing's world files, positions by the order of discovery."""
    paths = [r["path"] for r in discover(listing).orderBy("place").select("path").collect()]  # names that a user gave, or of one folder
    order = spark.createDataFrame(list(enumerate(paths)), "position long, path string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return read_documents(spark, paths).withColumn("_p", plain(F.col("path"))).join(F.broadcast(order.select("position", plain(F.col("path")).alias("_p"))), "_p").drop("_p")


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path and text of each file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    import json

    import yaml

    names = [x.split()[0] for x in _PARSED.split(", ")]
    token = lambda v: None if v is None else json.dumps(v, default=str)

    def section(d, *path):
        for key in path:
            d = d.get(key) if isinstance(d, dict) else None
        return d

    def read(text: str):
        """By libyaml where it is there, the text has no tab, which it takes where the plain parser does not, and cannot nest
        so deeply that it overflows its stack; what that refuses,
        the plain parser judges."""
        if hasattr(yaml, "CSafeLoader") and "\t" not in text and text.count("[") + text.count("{") < _NESTED and not _INDENTED.search(text):
            try:
                return yaml.load(text, yaml.CSafeLoader)
            except yaml.YAMLError:
                pass
        return yaml.safe_load(text)

    def one(text: str | None) -> dict:
        try:
            doc = read(text or "")
        except yaml.YAMLError:
            return {"error": "not a YAML document"}
        area, origin = section(doc, "mrs_uav_managers", "safety_area_manager", "safety_area"), section(doc, "mrs_uav_managers", "world_origin")
        points, frame = section(area, "horizontal", "points"), section(area, "horizontal", "frame_name")
        return {
            "error": None if isinstance(area, dict) else "no safety area", "frame": None if frame is None else str(frame), "is_list": isinstance(points, list),
            "points": [json.dumps(v, default=str) for v in points] if isinstance(points, list) else None,
            "units": None if section(origin, "units") is None else str(section(origin, "units")),
            "origin_x": token(section(origin, "origin_x")), "origin_y": token(section(origin, "origin_y")), "vertical_frame": section(area, "vertical", "frame_name"),
            "min_z": token(section(area, "vertical", "min_z")), "max_z": token(section(area, "vertical", "max_z")),
        }

    for batch in batches:
        rows = [one(t) for t in batch]
        yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})


def parse(documents: DataFrame) -> DataFrame:
    """documents with `parsed`; numbers come as JSON tokens, so that text, booleans and numbers stay apart. Documents are
    dealt to as many tasks as there are shuffle partitions, as many of them may come from one file."""
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return documents.repartition(tasks).withColumn("parsed", F.pandas_udf(_parse, _PARSED)("text"))


def optional_number(token: Column) -> Column:
    """A finite number, else NULL, whatever the token is."""
    n = F.when(token.rlike(_NUMBER), token.try_cast("double"))
    return F.when(F.abs(n) < float("inf"), n)


def points_problem(is_list: Column, points: Column) -> Column:
    """Why a flat list of latitudes and longitudes is no polygon, or NULL."""
    n = F.size(points)
    value = lambda p: optional_number(p)
    outside = lambda p, i: F.abs(value(p)) > F.when(i % 2 == 0, 90.0).otherwise(180.0)
    bad = F.exists(F.transform(points, lambda p, i: F.coalesce(outside(p, i), F.lit(False))), lambda b: b)
    return (
        F.when(~F.coalesce(is_list, F.lit(False)), "points are not a list").when(n % 2 == 1, "points are not whole pairs")
        .when(F.exists(points, lambda p: ~p.rlike(_NUMBER) & ~p.isin("NaN", "Infinity", "-Infinity")), "a point is not a number")
        .when(F.exists(points, lambda p: value(p).isNull()), "a point is not finite")
        .when(n < 2 * LEAST_VERTICES, "fewer than 3 vertices").when(bad, "a vertex is out of range")
    )


def lonlat_pairs(points: Column) -> Column:
    """The list as structs of lon and lat, in order."""
    at = lambda i: optional_number(F.get(points, i.cast("int")))
    return F.transform(F.sequence(F.lit(0), F.expr("1") * 0 + F.floor(F.size(points) / 2).cast("int") - 1), lambda k: F.struct(at(2 * k + 1).alias("lon"), at(2 * k).alias("lat")))


def origin(units: Column, x: Column, y: Column) -> Column:
    """A usable origin, or NULL: it describes a world only, so nothing hangs on it."""
    u, a, b = F.upper(F.trim(units)), optional_number(x), optional_number(y)
    good = u.isin(*ORIGIN_UNITS) & a.isNotNull() & b.isNotNull() & ((u != "LATLON") | ((F.abs(a) <= 90) & (F.abs(b) <= 180)))
    return F.when(good, F.struct(u.alias("units"), a.alias("x"), b.alias("y")))


def name_of(path: Column) -> Column:
    """World name from a file's name, without its ending and a leading world_ or world-."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/|[.][^./]*$", ""), "^world[_-](?=.)", "")


def load(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(worlds, skipped) of documents (path, position, text): of worlds that share a name the first stays; every other
    document is skipped with its reason."""
    p = F.col("parsed")
    frame = F.when(F.coalesce(p["frame"], F.lit("")) != FRAME, F.concat(F.lit("frame is not "), F.lit(FRAME)))
    reason = F.coalesce(p["error"], frame, points_problem(p["is_list"], p["points"]))
    read = parse(documents).select("path", "position", name_of(F.col("path")).alias("name"), reason.alias("reason"), "parsed")
    first = read.where("reason is null").groupBy("name").agg(F.min("position").alias("first"))
    judged = read.join(first, "name", "left").withColumn("reason", F.when(F.col("reason").isNull() & (F.col("position") != F.col("first")), "the name is taken").otherwise(F.col("reason")))
    worlds = judged.where("reason is null").select(
        "name", "path", "position", lonlat_pairs(p["points"]).alias("points"), origin(p["units"], p["origin_x"], p["origin_y"]).alias("origin"),
        p["vertical_frame"].alias("vertical_frame"), optional_number(p["min_z"]).alias("min_z"), optional_number(p["max_z"]).alias("max_z"))
    return worlds, judged.where("reason is not null").select("path", "position", "reason")
