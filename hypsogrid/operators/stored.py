"""Blocks as they are stored: with a border of one pixel, in buckets that joins need not shuffle, or along a curve.

* A block with a halo has its own pixels and the first ones of its eastern, southern and south-eastern neighbours, so
  the four pixels around a place lie in one block: a sample is one join, without regrouping.
* Buckets by (bx, by) are kept in the files, so a join with places moves the places alone.
* Along the Morton curve, blocks that lie together are written together; a window is a few ranges of the curve, which
  reach the Parquet reader as filters and skip row groups that hold none of it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sampling import CORNERS, lerp2, split_fraction

KEYS = ("bx", "by")


def with_halo(blocks: DataFrame, size: int) -> DataFrame:
    """blocks with (size + 1) ** 2 values each; one exchange, in which a block sends its edges and itself."""
    v, none = F.col("values"), F.lit(None)
    column = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda r: F.get(v, r * size))
    part = lambda dx, dy, kind, values: F.struct((F.col("bx") + dx).alias("bx"), (F.col("by") + dy).alias("by"), F.lit(kind).alias("kind"), values.alias("part"))
    sent = blocks.select(F.explode(F.array(
        part(0, 0, "own", v), part(-1, 0, "east", column), part(0, -1, "south", F.slice(v, 1, size)), part(-1, -1, "corner", F.slice(v, 1, 1)))).alias("s")).select("s.*")
    of = lambda kind: F.first(F.when(F.col("kind") == kind, F.col("part")), ignorenulls=True).alias(kind)
    met = sent.groupBy("bx", "by").agg(*(of(k) for k in ("own", "east", "south", "corner"))).where("own is not null")
    line = lambda r: F.concat(F.slice("own", r * size + 1, F.lit(size)), F.array(F.get("east", r)))
    lines = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), line))
    last = F.coalesce(F.col("south"), F.array_repeat(none, size).cast("array<float>"))
    return met.select("bx", "by", F.concat(lines, last, F.array(F.get("corner", F.lit(0)))).alias("values"))


def bilinear(points: DataFrame, halo: DataFrame, size: int, u: str = "u", v: str = "v", out: str = "height") -> DataFrame:
    """points with their height: one left join by block, any corner without height gives NULL."""
    p = split_fraction(points, u, v).withColumns({"bx": F.floor(F.col("c0") / size), "by": F.floor(F.col("r0") / size)})
    at = lambda dc, dr: F.get("values", ((F.col("r0") - F.col("by") * size + dr) * (size + 1) + F.col("c0") - F.col("bx") * size + dc).cast("int")).cast("double")
    met = p.join(halo, list(KEYS), "left")
    return met.withColumn(out, lerp2(*(at(*c) for c in CORNERS.values()), F.col("fx"), F.col("fy"))).drop("c0", "r0", "fx", "fy", "bx", "by", "values")


def _table(path: str) -> str:
    return "hypsogrid_" + hashlib.md5(path.encode()).hexdigest()


def write_buckets(df: DataFrame, path: str, buckets: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Writes df in buckets, a file each, and opens it."""
    name = _table(path)
    df.sparkSession.sql(f"drop table if exists {name}")
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def open_buckets(spark: SparkSession, path: str, schema: str, buckets: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """What `write_buckets` wrote, in a session that does not know it yet."""
    name, columns = _table(path), ", ".join(keys)
    spark.sql(f"create table if not exists {name} ({schema}) using parquet clustered by ({columns}) sorted by ({columns}) into {buckets} buckets location '{path}'")
    return spark.table(name)


def close_buckets(spark: SparkSession, path: str) -> None:
    """Forgets the table; its files stay."""
    spark.sql(f"drop table if exists {_table(path)}")


#: Bits of a block's number along an axis, and the number of the first block, so that those west and north of the
#: origin come before it.
BITS, FIRST = 31, -(1 << 30)
#: Ranges of the curve that a window becomes at most; the more, the fewer blocks beside it are read.
MOST_RANGES = 32


def _spread(c: Column) -> Column:
    """The bits of a number of BITS bits, with a gap after each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def morton(bx: Column, by: Column) -> Column:
    return _spread((bx - FIRST).cast("long")).bitwiseOR(F.shiftleft(_spread((by - FIRST).cast("long")), 1))


def write_along_curve(blocks: DataFrame, path: str, files: int, row_group_bytes: int = 8 << 20) -> None:
    """Writes blocks with `z`, their place on the curve, in `files` ranges of it, sorted."""
    placed = blocks.withColumn("z", morton(F.col("bx"), F.col("by")))
    placed.repartitionByRange(files, "z").sortWithinPartitions("z").write.option("parquet.block.size", row_group_bytes).parquet(path)


def curve_ranges(bx0: int, by0: int, bx1: int, by1: int, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """Closed ranges of the curve that hold all blocks of a closed box, `most` at most. Squares of the curve are cut
    while they stick out of the box; then the narrowest gaps between ranges are closed."""
    x0, y0, x1, y1 = (n - FIRST for n in (bx0, by0, bx1, by1))
    level, squares = BITS, [(0, 0)]  # corners, in squares of 2**level
    done: list[tuple[int, int]] = []

    def interleave(x: int, y: int) -> int:
        return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(BITS))

    while squares and len(squares) + len(done) <= 4 * most and level:
        level -= 1
        nearer = []
        for sx, sy in squares:
            for x, y in ((2 * sx, 2 * sy), (2 * sx + 1, 2 * sy), (2 * sx, 2 * sy + 1), (2 * sx + 1, 2 * sy + 1)):
                left, top, right, bottom = x << level, y << level, (x + 1 << level) - 1, (y + 1 << level) - 1
                if right < x0 or left > x1 or bottom < y0 or top > y1:
                    continue
                if x0 <= left and right <= x1 and y0 <= top and bottom <= y1:
                    done.append((interleave(left, top), interleave(right, bottom)))
                else:
                    nearer.append((x, y))
        squares = nearer
    done += [(interleave(x << level, y << level), interleave((x + 1 << level) - 1, (y + 1 << level) - 1)) for x, y in squares]
    ranges: list[list[int]] = []
    for a, b in sorted(done):
        if ranges and a <= ranges[-1][1] + 1:
            ranges[-1][1] = max(b, ranges[-1][1])
        else:
            ranges.append([a, b])
    while len(ranges) > most:
        i = min(range(len(ranges) - 1), key=lambda k: ranges[k + 1][0] - ranges[k][1])
        ranges[i : i + 2] = [[ranges[i][0], ranges[i + 1][1]]]
    return [(a, b) for a, b in ranges]


def window_on_curve(spark: SparkSession, path: str, window: tuple[int, int, int, int], size: int) -> DataFrame:
    """The blocks that a window (col_min, row_min, width, height) of pixels meets, read by ranges of the curve."""
    c, r, w, h = window
    box = (c // size, r // size, (c + w - 1) // size, (r + h - 1) // size)
    near = F.lit(False)
    for a, b in curve_ranges(*box):
        near = near | F.col("z").between(a, b)
    return spark.read.parquet(path).where(near).where(F.col("bx").between(box[0], box[2]) & F.col("by").between(box[1], box[3]))
