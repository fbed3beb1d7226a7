"""The catalogue of a dataset: worlds, vertices, tiles and the links between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The order of each table's rows when written.
KEYS = {
    "tiles": ("ix", "iy"), "lattice": ("ix", "iy"), "imagery": ("ix", "iy"), "links": ("world", "ix", "iy"), "lattice_links": ("world", "ix", "iy"),
    "worlds": ("name",), "vertices": ("world", "seq"), "test_points": ("lat", "lon", "height"),
}
#: Rows of a file of a catalogue table.
FILE_ROWS = 1_000_000


def write_table(df: DataFrame, path: str, keys: tuple[str, ...], file_rows: int = FILE_ROWS) -> None:
    """Writes a table so that equal rows make equal files, however they were dealt before: sorted by keys, and cut into
    files by the rows' places in that order. As many tasks as there are shuffle partitions at most write, each of them
    whole files, so that what tasks report to the driver does not grow with the files."""
    from . import ordered

    n = df.count()
    placed = ordered.numbered(df, keys) if n > file_rows else df.withColumn("position", F.lit(0).cast("long"))
    files = max(1, -(-n // file_rows))
    tasks = min(files, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = placed.repartitionByRange(tasks, F.floor(F.col("position") / file_rows)) if files > 1 else placed.coalesce(1)
    dealt.sortWithinPartitions(*keys).drop("position").write.option("maxRecordsPerFile", file_rows).parquet(path)


def digest(df: DataFrame) -> str:
    """A digest of a table's rows, which neither their order nor their partitions change."""
    one = df.select(F.xxhash64(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).cast("decimal(38,0)").alias("h"))
    r = one.agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("s"), F.bit_xor(F.col("h").cast("long")).alias("x")).first()
    return f"{r['n']}-{(int(r['s'] or 0)) % (1 << 64):016x}-{(r['x'] or 0) % (1 << 64):016x}"


def vertices_of(worlds: DataFrame) -> DataFrame:
    """world, seq, lat, lon of worlds (name, points)."""
    return worlds.select(F.col("name").alias("world"), F.posexplode("points").alias("seq", "p")).select("world", "seq", "p.lat", "p.lon")


def links(needs: DataFrame) -> DataFrame:
    """world, ix, iy: each link once."""
    return needs.select("world", "ix", "iy").distinct()


def first_wins(df: DataFrame, name: str, place: Column, keep: str) -> DataFrame:
    """`name` and `keep` of the row that comes first by place among those of one name; partial sums, no sort."""
    return df.groupBy(name).agg(F.min_by(keep, place).alias(keep))


def preferred(candidates: DataFrame, group: str, later: Column, rank: str) -> DataFrame:
    """Of each group the candidate of least rank among those that are not put `later`, or else among all."""
    return first_wins(candidates, group, F.struct(later.alias("later"), F.col(rank).alias("rank")), rank)


def vertex_counts(worlds: DataFrame, vertices: DataFrame, least: int = 3) -> DataFrame:
    """world, n_vertices and whether they are enough, 0 for worlds without vertices."""
    n = worlds.select("world").distinct().join(vertices.select("world", F.lit(1).alias("_one")), "world", "left")
    return n.groupBy("world").agg(F.count("_one").alias("n_vertices"), (F.count("_one") >= least).alias("enough"))


def undeclared(links_: DataFrame, tiles: DataFrame) -> DataFrame:
    """Links to tiles that are not declared."""
    return links_.join(tiles, ["ix", "iy"], "left_anti")


def unneeded(tiles: DataFrame, kept_links: DataFrame) -> DataFrame:
    """Tiles that no kept world needs."""
    return tiles.join(kept_links, ["ix", "iy"], "left_anti")


def both(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both sides have, each once."""
    return a.select(*keys).distinct().join(b, keys, "left_semi")


def outcomes(tiles: DataFrame, by: list[str]) -> DataFrame:
    """tiles (action, from_store) -> how many of each group were written, used again, and answered from the store."""
    return tiles.groupBy(*by).agg(
        F.count_if(F.col("action") == "written").alias("written"), F.count_if(F.col("action") == "reused").alias("reused"), F.count_if("from_store").alias("cache_hits"))


def tiles_of(links_: DataFrame, tiles: DataFrame) -> DataFrame:
    """Links with the columns of their tiles."""
    return links_.join(tiles, ["ix", "iy"])


def differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that only one side has, with `only_in`; no rows if the sets are equal."""
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    both = sides.groupBy(*keys).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return both.where("l <> r").select(*keys, F.when(F.col("l") == 1, "left").otherwise("right").alias("only_in"))


def complete_worlds(corners: DataFrame) -> DataFrame:
    """Worlds of corners (world, height) all of whose corners have a height."""
    return corners.groupBy("world").agg(F.bool_and(F.col("height").isNotNull()).alias("_all")).where("_all").select("world")


def reusable(tiles: DataFrame) -> DataFrame:
    """tiles (tags, wanted_tags, filled, need, valid) with `reuse` and why not: tags equal but for the package's
    version, pixels filled that hold the need, and a tile that is valid."""
    own = lambda c: F.map_filter(c, lambda k, _: k != "package_version")
    same = F.array_sort(F.map_entries(own(F.col("tags")))) == F.array_sort(F.map_entries(own(F.col("wanted_tags"))))
    f, n = F.col("filled"), F.col("need")
    holds = (f["col_min"] <= n["col_min"]) & (f["row_min"] <= n["row_min"]) & (f["col_max"] >= n["col_max"]) & (f["row_max"] >= n["row_max"])
    why = F.when(~F.coalesce(same, F.lit(False)), "tags differ").when(~F.coalesce(holds, F.lit(False)), "not filled").when(~F.coalesce(F.col("valid"), F.lit(False)), "not valid")
    return tiles.withColumns({"why": why, "reuse": why.isNull()})
