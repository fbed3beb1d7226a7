"""Blocks with halos, in buckets, and along the Morton curve."""

import random

from pyspark.sql import functions as F

from hypsogrid.operators import blocks, stored

SIZE = 8


def raster(spark, side):
    px = spark.range(side * side).select((F.col("id") % side - 5).alias("col"), (F.floor(F.col("id") / side) - 3).alias("row"))
    v = F.when((F.col("col") * 7 + F.col("row") * 3) % 23 != 0, F.sin(F.col("col")) + F.col("row") * 2).cast("float")
    return blocks.to_blocks(px.select("col", "row", v.alias("v")), SIZE)


def places(spark, n, side):
    k = F.col("id")
    return spark.range(n).select(k, (k * 37 % (side * 8) / 8 - 7).alias("u"), (k * 101 % (side * 8) / 8 - 5).alias("v"))


def test_halo_samples_as_blocks_do(spark):
    table, p = raster(spark, 40), places(spark, 3000, 44)
    want = {r["id"]: r["height"] for r in blocks.bilinear(p, ["id"], table, SIZE).collect()}
    got = {r["id"]: r["height"] for r in stored.bilinear(p, stored.with_halo(table, SIZE), SIZE).collect()}
    assert got == want and any(v is None for v in want.values()) and sum(v is not None for v in want.values()) > 1000
    assert stored.with_halo(table.limit(0), SIZE).count() == 0


def test_stored_side_is_not_shuffled(spark, tmp_path):
    path = f"file://{tmp_path}/halo"
    halo = stored.write_buckets(stored.with_halo(raster(spark, 40), SIZE), path, 4)
    schema = ", ".join(f"{n} {t}" for n, t in halo.dtypes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for table in (halo, (stored.close_buckets(spark, path), stored.open_buckets(spark, path, schema, 4))[1]):
            found = stored.bilinear(places(spark, 500, 44), table, SIZE)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "Bucketed: true" in found._jdf.queryExecution().explainString(found._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            assert found.where("height is not null").count() > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        stored.close_buckets(spark, path)


def test_morton_order(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(-1000, 1000), rng.randrange(-1000, 1000)) for _ in range(200)]
    spread = lambda n: sum((n - stored.FIRST >> i & 1) << 2 * i for i in range(stored.BITS))
    rows = spark.createDataFrame(pairs, "bx long, by long").select("bx", "by", stored.morton(F.col("bx"), F.col("by")).alias("z")).collect()
    place = {(r["bx"], r["by"]): r["z"] for r in rows}
    assert all(z == spread(x) | spread(y) << 1 for (x, y), z in place.items())
    for most in (1, 4, 32):
        for _ in range(40):
            (x0, y0), (x1, y1) = sorted(rng.sample(pairs, 2))
            y0, y1 = min(y0, y1), max(y0, y1)
            ranges = stored.curve_ranges(x0, y0, x1, y1, most)
            assert len(ranges) <= most
            assert all(any(a <= z <= b for a, b in ranges) for (x, y), z in place.items() if x0 <= x <= x1 and y0 <= y <= y1)


def rows_scanned(df):
    """Rows that the files' reader gave, after row groups were skipped."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()) if "numOutputRows" in str(leaves.apply(i).metrics().keySet()))


def test_small_window_reads_few_row_groups(spark, tmp_path):
    n = 128
    ids = spark.range(n * n).select((F.col("id") % n - 64).alias("bx"), (F.floor(F.col("id") / n) - 64).alias("by"))
    table = ids.withColumn("values", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (F.rand(1) + i).cast("float")))
    path = f"file://{tmp_path}/curve"
    stored.write_along_curve(table, path, 8, row_group_bytes=64 << 10)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        near = stored.window_on_curve(spark, path, (-40, -24, 60, 50), SIZE)
        assert {(r["bx"], r["by"]) for r in near.collect()} == {(x, y) for x in range(-5, 3) for y in range(-3, 4)}
        scanned = rows_scanned(near)
        assert 56 <= scanned <= n * n // 10, scanned
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
