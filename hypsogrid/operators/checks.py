"""Integrity checks: each gives rows of a report (severity, check, subject, message), and a report is their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Plausible heights, tolerances of tile edges and test points (metres), least coverage of a window.
PLAUSIBLE, EDGE_TOLERANCE, POINT_TOLERANCE, LEAST_COVERAGE = (-100.0, 2100.0), 1e-6, 1e-6, 0.99
ERROR, WARNING = "error", "warning"


def report(df: DataFrame, subject: Column, rules: list[tuple[str, str, Column, str]]) -> DataFrame:
    """A row for each rule (severity, check, condition, message) that a row of df breaks; NULL conditions do not."""
    found = F.array(*(F.when(bad, F.struct(F.lit(s).alias("severity"), F.lit(c).alias("check"), F.lit(m).alias("message"))) for s, c, bad, m in rules))
    broken = df.select(subject.cast("string").alias("subject"), F.explode(F.filter(found, lambda r: r.isNotNull())).alias("r"))
    return broken.select("r.severity", "r.check", "subject", "r.message")


def extend(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def verdict(whole: DataFrame) -> DataFrame:
    """One row: errors, warnings, and ok if there are no errors."""
    n = lambda s: F.count_if(F.col("severity") == s)
    return whole.agg(n(ERROR).alias("n_errors"), n(WARNING).alias("n_warnings"), (n(ERROR) == 0).alias("ok"))


def plausibility(stats: DataFrame, subject: Column, low: float = PLAUSIBLE[0], high: float = PLAUSIBLE[1]) -> DataFrame:
    """Warnings on tile statistics (n_valid, min_v, max_v): nothing valid, all zero, or out of the plausible range."""
    some = F.col("n_valid") > 0
    zero = some & (F.col("min_v") == 0) & (F.col("max_v") == 0)
    return report(stats, subject, [
        (WARNING, "empty", ~some, "no valid pixel"), (WARNING, "zero", zero, "all heights are 0"),
        (WARNING, "range", some & ~zero & ((F.col("min_v") < low) | (F.col("max_v") > high)), "implausible heights"),
    ])


def tiles(df: DataFrame, subject: Column, crs: str, nodata: float, resolution: float, origin_x: float, origin_y: float, size: int) -> DataFrame:
    """Facts of tiles (ix, iy, crs, dtype, bands, nodata, a, b, c, d, e, f, width, height, n_not_finite) against their grid."""
    near = lambda x, want: F.abs(F.col(x) - want) <= EDGE_TOLERANCE
    span = size * resolution
    return report(df, subject, [
        (ERROR, "crs", ~F.col("crs").eqNullSafe(F.lit(crs)), "another coordinate system"), (ERROR, "dtype", ~F.col("dtype").eqNullSafe(F.lit("float32")), "heights are not 32-bit numbers"),
        (ERROR, "bands", F.col("bands") != 1, "not one band"), (ERROR, "nodata", ~F.col("nodata").eqNullSafe(F.lit(nodata)), "another NoData value"),
        (ERROR, "north up", (F.col("b") != 0) | (F.col("d") != 0) | (F.col("e") >= 0), "not north up"),
        (ERROR, "resolution", ~(near("a", resolution) & near("e", -resolution)), "another resolution"),
        (ERROR, "origin", ~(near("c", origin_x + F.col("ix") * span) & near("f", origin_y - F.col("iy") * span)), "not on the grid"),
        (ERROR, "size", (F.col("width") > size) | (F.col("height") > size), "larger than a tile"),
        (WARNING, "clipped", (F.col("width") < size) & (F.col("height") <= size) | (F.col("height") < size) & (F.col("width") <= size), "smaller than a tile"),
        (ERROR, "finite", F.col("n_not_finite") > 0, "heights that are not finite"),
    ])


def coverage(covered: DataFrame, subject: Column, least: float = LEAST_COVERAGE, empty: str | None = None) -> DataFrame:
    """Warnings where a fraction `covered` is below `least`; where it is 0, of severity `empty` if given."""
    none = F.col("covered") == 0
    rules = [(WARNING, "coverage", (F.col("covered") < least) & (~none if empty else F.lit(True)), "heights are missing")]
    return report(covered, subject, rules + ([(empty, "coverage", none, "nothing is covered")] if empty else []))


def recomputed(df: DataFrame, subject: Column, recorded: str, now: str, tolerance: float = POINT_TOLERANCE) -> DataFrame:
    """Errors where a recorded value and the one computed now differ: missing on one side, or off by more than the tolerance."""
    a, b = F.col(recorded), F.col(now)
    return report(df, subject, [
        (ERROR, "missing", a.isNull() != b.isNull(), "only one of the values is there"), (ERROR, "value", F.abs(a - b) > tolerance, "the values differ"),
    ])


def parity(pairs: DataFrame, by: list[str], first: Column, second: Column) -> DataFrame:
    """Two samplers' answers to the same points: the worst difference, how many both lack, and how many only one lacks."""
    lacks = lambda c: c.isNull() | F.isnan(c)
    return pairs.groupBy(*by).agg(
        F.max(F.when(~lacks(first) & ~lacks(second), F.abs(first - second))).alias("worst"), F.count_if(lacks(first) & lacks(second)).alias("both_missing"),
        F.count_if(lacks(first) != lacks(second)).alias("mismatches"))


def unavailable(sampled: DataFrame, by: list[str], height: str = "height") -> DataFrame:
    """Points and points without a height of each request, and the message that says so."""
    g = sampled.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(height).isNull()).alias("n_unavailable"))
    return g.withColumn("message", F.when(F.col("n_unavailable") == 0, "ok").otherwise(F.format_string("%d of %d points have no height", "n_unavailable", "n")))


def catalogue_rules(counts: DataFrame, lone_links: DataFrame, subject: Column) -> DataFrame:
    """Errors for worlds (world, n_vertices, enough) without enough vertices and for links to undeclared tiles."""
    few = report(counts, F.col("world"), [(ERROR, "vertices", ~F.col("enough"), "fewer than 3 vertices")])
    return extend(few, report(lone_links, subject, [(ERROR, "link", F.lit(True), "not declared")]))


def known_points(converted: DataFrame, subject: Column, before: str, after: str, most: float) -> DataFrame:
    """A conversion tried at known points: an error where it has no finite result, a warning where it moves by more than `most`."""
    d = F.col(after) - F.col(before)
    lost = F.coalesce(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(True))
    return report(converted, subject, [(ERROR, "grid", lost, "no finite height"), (WARNING, "shift", ~lost & (F.abs(d) > most), "implausible shift")])


def stray(files: DataFrame, declared: DataFrame) -> DataFrame:
    """Warnings for files (path) that are tiles by their name but not declared (path), and for leftovers of writes."""
    names = files.withColumn("tile", F.col("path").rlike(r"(^|/)tile_-?\d+_-?\d+\.tif$"))
    lone = names.where("tile").join(declared.select("path"), "path", "left_anti")
    return extend(report(lone, F.col("path"), [(WARNING, "stray", F.lit(True), "not declared")]), report(files, F.col("path"), [(WARNING, "leftover", F.col("path").endswith(".tmp"), "left by a write")]))


def completeness(expected: DataFrame, present: DataFrame, keys: list[str], required: bool) -> DataFrame:
    """Expected tiles that are not there: errors where a complete dataset is required, else warnings."""
    lone = expected.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")
    return report(lone, F.concat_ws(",", *keys), [(ERROR if required else WARNING, "missing tile", F.lit(True), "declared but not there")])
