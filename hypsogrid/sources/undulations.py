"""Undulation grids: binary files of geoid heights over a grid of longitudes and latitudes, as tables of node blocks.

A file has a header of 40 bytes, big-endian: latitude and longitude of the south-western node, steps of latitude and
longitude (doubles), rows, columns (32-bit integers); then rows of 32-bit floats from south to north, NODATA where
there is no value. A file is parsed by one task and leaves it block by block. Blocks overlap by one node, so that the
four nodes around any place lie in one block.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
HEADER, NODATA = ">ddddii", -88.8888
#: Cells of a block, a side.
BLOCK = 64
NODES = "grid string, west double, south double, dlon double, dlat double, n_cols int, n_rows int, bc int, br int, width int, nodes array<float>"


def header(content: bytes, name: str) -> tuple[float, float, float, float, int, int]:
    """(south, west, dlat, dlon, rows, columns), or an error that names the file."""
    size = struct.calcsize(HEADER)
    if len(content) < size:
        raise ValueError(f"{name} is no undulation grid: {len(content)} bytes")
    south, west, dlat, dlon, rows, cols = struct.unpack(HEADER, content[:size])
    if not (rows > 1 and cols > 1 and 0 < dlat <= 90 and 0 < dlon <= 180 and abs(south) <= 90 and abs(west) <= 360):
        raise ValueError(f"{name} is no undulation grid: its header has {rows} rows and {cols} columns, steps {dlat} and {dlon}")
    if len(content) != size + 4 * rows * cols:
        raise ValueError(f"{name} has {len(content)} bytes, its header asks for {size + 4 * rows * cols}")
    return south, west, dlat, dlon, rows, cols


def encode(south: float, west: float, dlat: float, dlon: float, values: np.ndarray) -> bytes:
    """The content of a file; values: rows from south to north, NaN where there is none."""
    filled = np.where(np.isnan(values), NODATA, values).astype(">f4")
    return struct.pack(HEADER, south, west, dlat, dlon, *values.shape) + filled.tobytes()


def _blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in NODES.split(", ")]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            name = path.rpartition("/")[2]
            south, west, dlat, dlon, rows, cols = header(content, name)
            values = np.frombuffer(content, ">f4", offset=struct.calcsize(HEADER)).reshape(rows, cols)
            for br in range(-(-(rows - 1) // size)):
                out = []
                for bc in range(-(-(cols - 1) // size)):
                    part = values[br * size : br * size + size + 1, bc * size : bc * size + size + 1].astype(float)
                    part = np.where(np.isfinite(part) & (np.abs(part - NODATA) > 1e-4), part, np.nan)
                    out.append((name, west, south, dlon, dlat, cols, rows, bc, br, part.shape[1], [None if np.isnan(v) else v for v in part.ravel().tolist()]))
                yield pd.DataFrame(out, columns=names)


def read(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Blocks of the grids in a folder or of a file: their grid, its frame, (bc, br), nodes in a row, and nodes."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lambda batches: _blocks(batches, block), NODES)


def grids(blocks: DataFrame) -> DataFrame:
    """One row for each grid with its frame."""
    frame = ("west", "south", "dlon", "dlat", "n_cols", "n_rows")
    return blocks.groupBy("grid").agg(*(F.first(c).alias(c) for c in frame))


def from_nodes(nodes: DataFrame, frames: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of grids given as tables: nodes (grid, col, row, n) from the south-west, frames as `grids` gives them."""
    own = lambda c: F.floor(F.col(c) / block).cast("int")
    both = lambda c, n: F.array_compact(F.array(
        F.when(F.col(c) < F.greatest(F.col(n) - 1, F.lit(1)), own(c)), F.when((F.col(c) % block == 0) & (F.col(c) > 0), own(c) - 1), F.when((F.col(c) == F.col(n) - 1) & (F.col(c) % block != 0), own(c))))
    keyed = nodes.join(frames, "grid").where("col >= 0 and row >= 0 and col < n_cols and row < n_rows")
    keyed = keyed.withColumn("bc", F.explode(both("col", "n_cols"))).withColumn("br", F.explode(both("row", "n_rows")))
    size = lambda b, n: F.least(F.lit(block), F.col(n) - 1 - F.col(b) * block) + 1
    keyed = keyed.withColumns({"width": size("bc", "n_cols").cast("int"), "height": size("br", "n_rows").cast("int")})
    at = ((F.col("row") - F.col("br") * block) * F.col("width") + F.col("col") - F.col("bc") * block).cast("int")
    frame = ["grid", "west", "south", "dlon", "dlat", "n_cols", "n_rows", "bc", "br", "width"]
    maps = keyed.groupBy(*frame, "height").agg(F.map_from_entries(F.collect_list(F.struct(at.alias("at"), F.col("n").cast("float").alias("n")))).alias("m"))
    nodes_ = F.transform(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1), lambda i: F.try_element_at("m", i))
    return maps.select(*frame, nodes_.alias("nodes"))
