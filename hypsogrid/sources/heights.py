"""Sources of heights and imagery, given as functions of a table of windows; builds take any object of this form."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import blocks, grid


EVERYWHERE = (-float("inf"), -float("inf"), float("inf"), float("inf"))


@runtime_checkable
class HeightSource(Protocol):
    """datum, coverage (west, south, east, north, in metres) and an id; `read` gives (window_id, col, row, v) for windows of the grid, and
    is called with windows of at most the size that the source can serve at once."""

    datum: str
    coverage: tuple[float, float, float, float]
    source_id: str

    def read(self, windows: DataFrame) -> DataFrame: ...


@runtime_checkable
class ImagerySource(Protocol):
    """coverage (west, south, east, north, in degrees) and an id; `read_rgba` gives (window_id, col, row, r, g, b, a),
    alpha NULL where a source has none."""

    coverage: tuple[float, float, float, float]
    source_id: str

    def read_rgba(self, windows: DataFrame) -> DataFrame: ...


@dataclass
class BlockSource:
    """Heights that are there as a table of blocks."""

    table: DataFrame
    size: int
    datum: str = "egm96"
    coverage: tuple[float, float, float, float] = EVERYWHERE
    source_id: str = "blocks"
    native_origin: tuple[float, float] | None = None

    def read(self, windows: DataFrame) -> DataFrame:
        return blocks.window_scan(self.table, windows, self.size)


def _pieces(windows: DataFrame, most: int) -> DataFrame:
    return grid.split_windows(windows, most).select(
        F.struct("window_id", "piece_x", "piece_y").alias("window_id"), (F.col("col_min") + F.col("piece_x")).alias("col_min"),
        (F.col("row_min") + F.col("piece_y")).alias("row_min"), F.col("piece_w").alias("width"), F.col("piece_h").alias("height"))


def read_rgba_in_pieces(source: ImagerySource, windows: DataFrame, most: int) -> DataFrame:
    return source.read_rgba(_pieces(windows, most)).select("window_id.window_id", "col", "row", "r", "g", "b", "a")


def read_in_pieces(source: HeightSource, windows: DataFrame, most: int) -> DataFrame:
    """A read of windows of any size: cut into pieces of at most `most` pixels a side, read, and put together by place."""
    return source.read(_pieces(windows, most)).select("window_id.window_id", "col", "row", "v")


def usable_datum(datum: Column, expected: str) -> Column:
    """Whether a source on a datum (NULL: unknown) may be used where another is expected."""
    return datum.eqNullSafe(F.lit(expected))


def require_datum(source: HeightSource, expected: str) -> None:
    if source.datum != expected:
        raise ValueError(f"the source has heights on {source.datum}, not on {expected}")


@dataclass
class FormulaImagery:
    """Imagery given by expressions of col and row."""

    r: Column
    g: Column
    b: Column
    a: Column
    coverage: tuple[float, float, float, float] = EVERYWHERE
    source_id: str = "formula"

    def read_rgba(self, windows: DataFrame) -> DataFrame:
        rows = windows.withColumn("row", F.explode(F.sequence(F.col("row_min"), F.col("row_min") + F.col("height") - 1)))
        each = rows.withColumn("col", F.explode(F.sequence(F.col("col_min"), F.col("col_min") + F.col("width") - 1)))
        return each.select("window_id", "col", "row", *(getattr(self, n).cast("short").alias(n) for n in "rgba"))
