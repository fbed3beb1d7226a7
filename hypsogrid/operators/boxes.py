"""Algebra of boxes: real boxes (open where they meet), inclusive pixel ranges and half-open lattice windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("west", "south", "east", "north")
RANGE = ("col_min", "row_min", "col_max", "row_max")


def _meet(a: Column, b: Column, names: tuple[str, ...], strict: bool) -> Column:
    lo = [F.greatest(a[n], b[n]) for n in names[:2]]
    hi = [F.least(a[n], b[n]) for n in names[2:]]
    some = (lo[0] < hi[0]) & (lo[1] < hi[1]) if strict else (lo[0] <= hi[0]) & (lo[1] <= hi[1])
    return F.when(some, F.struct(*(c.alias(n) for c, n in zip((*lo, *hi), names))))


def intersection(a: Column, b: Column) -> Column:
    """NULL where the boxes only touch."""
    return _meet(a, b, SIDES, True)


def contains(a: Column, b: Column) -> Column:
    return (a["west"] <= b["west"]) & (a["south"] <= b["south"]) & (a["east"] >= b["east"]) & (a["north"] >= b["north"])


def buffered(a: Column, by: float) -> Column:
    return F.struct((a["west"] - by).alias("west"), (a["south"] - by).alias("south"), (a["east"] + by).alias("east"), (a["north"] + by).alias("north"))


def range_intersection(a: Column, b: Column) -> Column:
    """Ranges hold both ends: one column in common is enough."""
    return _meet(a, b, RANGE, False)


def range_union(a: Column, b: Column) -> Column:
    lo = [F.least(a[n], b[n]).alias(n) for n in RANGE[:2]]
    return F.struct(*lo, *(F.greatest(a[n], b[n]).alias(n) for n in RANGE[2:]))


def range_contains(a: Column, b: Column) -> Column:
    return (a["col_min"] <= b["col_min"]) & (a["row_min"] <= b["row_min"]) & (a["col_max"] >= b["col_max"]) & (a["row_max"] >= b["row_max"])


def close(a: Column, b: Column, absolute: float = 0.0, relative: float = 0.0) -> Column:
    """Equal but for a tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(absolute), relative * F.greatest(F.abs(a), F.abs(b)))
