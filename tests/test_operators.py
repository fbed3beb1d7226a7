import pytest
from pyspark.sql import functions as F

from hypsogrid.operators import boxes, polygons, projection, rasters, sampling
from hypsogrid.streaming.sampling import sample_stream


def test_bilinear_needs_all_corners(spark):
    px = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (0, 1, 5.0), (1, 1, 7.0)], "col long, row long, v float")
    pt = spark.createDataFrame([(1, 0.5, 0.25), (2, 1.0, 0.0), (3, 0.0, 0.0), (4, -1.0, 0.0)], "id long, u double, v double")
    got = {r["id"]: r["height"] for r in sampling.bilinear(pt.withColumnRenamed("v", "w"), px, "u", "w").collect()}
    assert got == {1: 3.0, 2: None, 3: 1.0, 4: None}


def test_boxes_that_touch(spark):
    row = spark.sql("""select struct(0d as west, 0d as south, 1d as east, 1d as north) as a, struct(1d as west, 0d as south, 2d as east, 1d as north) as b,
        struct(0 as col_min, 0 as row_min, 1 as col_max, 1 as row_max) as c, struct(1 as col_min, 0 as row_min, 2 as col_max, 1 as row_max) as d""")
    got = row.select(boxes.intersection(F.col("a"), F.col("b")).alias("x"), boxes.range_intersection(F.col("c"), F.col("d")).alias("y")).first()
    assert got["x"] is None and tuple(got["y"]) == (1, 0, 1, 1)


def test_polygon_inside_and_around_boxes(spark):
    v = spark.createDataFrame([("w", i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])], "world string, seq int, x double, y double")
    b = spark.createDataFrame([("w", 1, 4.0, 4.0, 5.0, 5.0), ("w", 2, 11.0, 11.0, 12.0, 12.0), ("w", 3, -1.0, -1.0, 20.0, 20.0), ("w", 4, 10.0, 4.0, 11.0, 5.0)],
                              "world string, box int, west double, south double, east double, north double")
    assert sorted(r["box"] for r in polygons.meets_boxes(v, b).collect()) == [1, 3, 4]


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), None])
def test_projection_of_no_place(spark, bad):
    df = spark.createDataFrame([(bad, 50.0)], "lon double, lat double")
    got = projection.krovak(df).first()
    assert got["x"] is None and got["y"] is None


def test_mask(spark):
    df = spark.createDataFrame([(1.0,), (-9999.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert [r[0] for r in df.select(rasters.valid(F.col("v"), -9999.0)).collect()] == [1.0, None, None, None, None]


def test_stream_equals_batch(spark, tmp_path):
    px = spark.range(9).select((F.col("id") % 3).alias("col"), F.floor(F.col("id") / 3).alias("row"), F.col("id").cast("float").alias("v"))
    pt = spark.range(20).select("id", (F.col("id") % 5 / 2).alias("u"), (F.col("id") % 3 / 4).alias("w"))
    pt.write.parquet(str(tmp_path / "in"))
    stream = sample_stream(spark.readStream.schema(pt.schema).parquet(str(tmp_path / "in")), px, "u", "w")
    stream.writeStream.format("memory").queryName("sampled").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    key = lambda df: sorted((r["id"], r["height"]) for r in df.collect())
    assert str(key(spark.table("sampled"))) == str(key(sampling.bilinear(pt, px, "u", "w")))


def test_documents_of_one_file_are_parsed_by_many_tasks(spark):
    from hypsogrid.sources import worlds

    texts = ["a: [1, 2", "a: {b: [1, yes, 2.5, 1_000, 010]}", "mrs_uav_managers: {safety_area_manager: {safety_area: {horizontal: {points: [1, true, x, .inf]}}}}", "a:\tb", "- " * 250 + "a", "[" * 250 + "]" * 250]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "position long, text string").coalesce(1)
    parsed = worlds.parse(docs)
    assert parsed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(0 < n for n in parsed.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
    got = {r["text"]: r["parsed"] for r in parsed.where("position = 0").collect()}
    assert [got[t]["error"] for t in texts] == ["not a YAML document", "no safety area", None, "not a YAML document", "no safety area", "no safety area"]
    assert got[texts[2]]["points"] == ["1", "true", '"x"', "Infinity"]


def test_catalogue_files_are_whole_and_written_by_few_tasks(spark, tmp_path):
    from hypsogrid.operators import catalogue

    df = spark.range(1950).selectExpr("id % 39 as ix", "id div 39 as iy")
    found = []
    for build, parts in ((0, 3), (1, 7)):
        catalogue.write_table(df.repartition(parts), str(tmp_path / str(build)), ("ix", "iy"), 100)
        files = sorted((tmp_path / str(build)).glob("part-*"))
        found.append([[tuple(r) for r in spark.read.parquet(str(f)).collect()] for f in files])
        assert len({f.name.split("-")[1] for f in files}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found[0] == found[1] and [len(f) for f in found[0]] == [100] * 19 + [50]
    assert [r for f in found[0] for r in f] == sorted(tuple(r) for r in df.collect())
