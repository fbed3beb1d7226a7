"""Writing datasets: staged, validated, then put in place of what was there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that a cluster shares (spark.checkpoint.dir); of this machine if the session runs in one process."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not base:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp()}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _files(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _files(spark, path)
    fs.delete(at, True)


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a finished folder in the place of another one, which comes back if the move fails."""
    new, fs = _files(spark, staged)
    at, old = _files(spark, target)[0], _files(spark, f"{target}.old-{uuid.uuid4().hex}")[0]
    had = fs.exists(at)
    if had and not fs.rename(at, old):
        raise OSError(f"{target} cannot be moved aside")
    if not fs.rename(new, at):
        if had:
            fs.rename(old, at)
        raise OSError(f"{staged} cannot be moved to {target}")
    if had:
        fs.delete(old, True)


def write_atomically(df: DataFrame, target: str, overwrite: bool = False, validate: Callable[[DataFrame], DataFrame] | None = None, by: tuple[str, ...] = ()) -> None:
    """Writes next to the target, validates what was written (a DataFrame of problems, none if good), and moves it there.
    A failure leaves the target as it was and no staged files."""
    spark = df.sparkSession
    if not overwrite and exists(spark, target):
        raise FileExistsError(target)
    staged = f"{target}.tmp-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(*by).option("compression", "zstd").parquet(staged)
        bad = validate(spark.read.parquet(staged)).take(1) if validate else []
        if bad:
            raise ValueError(f"not written: {bad[0]}")
        swap(spark, staged, target)
    finally:
        remove(spark, staged)


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    at, fs = _files(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def partitions(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(build, ix, iy) of the folders of tiles below a folder."""
    out, at = [], lambda name: name.partition("=")[2]
    for b in (n for n in listed(spark, folder) if n.startswith("build=")):
        for x in (n for n in listed(spark, f"{folder}/{b}") if n.startswith("ix=")):
            out += [(at(b), int(at(x)), int(at(y))) for y in listed(spark, f"{folder}/{b}/{x}") if y.startswith("iy=")]
    return out


def clean(spark: SparkSession, folder: str) -> int:
    """Deletes what unfinished writes left in a folder; how many there were."""
    at, fs = _files(spark, folder)
    left = [s.getPath() for s in fs.listStatus(at) if ".tmp-" in s.getPath().getName()]
    for p in left:
        fs.delete(p, True)
    return len(left)


def write_test_points(points: DataFrame, target: str) -> None:
    """Reference points as headerless lines, each once, in order."""
    once = points.select("lat", "lon", "height").distinct().orderBy("lat", "lon")
    once.select(F.concat_ws(",", "lat", "lon", "height").alias("value")).write.text(target)
