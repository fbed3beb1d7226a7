"""Building, sampling and validating a small dataset, and the options and sources it takes."""

import random
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypsogrid import dataset
from hypsogrid.__main__ import main
from hypsogrid.operators import blocks, catalogue, polygons, projection, storage, vertical
from hypsogrid.options import OptionError, PrepareOptions, SamplerOptions
from hypsogrid.sources import undulations
from hypsogrid.sources.heights import BlockSource, HeightSource, require_datum

OPTIONS = PrepareOptions(resolution=1.0, tile_px=32, block_px=8, origin_x=-765_500.0, origin_y=-1_121_200.0, plausible=(-100.0, 2100.0), datum="egm96", rgb_resolution_m=2.0, wgs_tile_px=64, wgs_height_factor=2)


def plane(spark, most=200):
    """Heights of a plane, which bilinear interpolation gives back exactly; a hole of missing pixels."""
    px = spark.range(most * most).select((F.col("id") % most).alias("col"), F.floor(F.col("id") / most).alias("row"))
    v = 0.25 * (F.col("col") + 0.5) - 0.125 * (F.col("row") + 0.5) + 100
    return px.select("col", "row", F.when((F.col("col") > 120) & (F.col("row") > 120), None).otherwise(v).cast("float").alias("v"))


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y - size), (x, y - size)]


def lonlat(spark, points):
    """Places whose projection is near the given pixel centres, by Newton steps from a first guess."""
    lon, lat = [14.2] * len(points), [49.4] * len(points)
    for _ in range(6):
        probe = [(i, k, a + (1e-5 if k == 1 else 0), b + (1e-5 if k == 2 else 0)) for i, (a, b) in enumerate(zip(lon, lat)) for k in range(3)]
        rows = {(r["i"], r["k"]): (r["x"], r["y"]) for r in projection.krovak(spark.createDataFrame(probe, "i int, k int, lon double, lat double")).collect()}
        for i, (col, row) in enumerate(points):
            want = (OPTIONS.origin_x + col, OPTIONS.origin_y - row)
            (x, y), (xa, ya), (xb, yb) = (rows[i, k] for k in range(3))
            a, b, c, d = (xa - x) / 1e-5, (xb - x) / 1e-5, (ya - y) / 1e-5, (yb - y) / 1e-5
            det = a * d - b * c
            lon[i] += (d * (want[0] - x) - b * (want[1] - y)) / det
            lat[i] += (a * (want[1] - y) - c * (want[0] - x)) / det
    return list(zip(lon, lat))


def test_build_sample_validate(spark, tmp_path, capsys):
    corners = {"one": square(20, 40, 15), "two": square(30, 50, 30), "hole": square(110, 130, 30)}
    flat = lonlat(spark, [p for c in corners.values() for p in c])
    worlds = spark.createDataFrame([(n, [{"lon": a, "lat": b} for a, b in flat[4 * i : 4 * i + 4]]) for i, n in enumerate(corners)], "name string, points array<struct<lon: double, lat: double>>")
    source = BlockSource(blocks.to_blocks(plane(spark), 8), 8)
    assert isinstance(source, HeightSource)
    path = f"file://{tmp_path}/set"
    made = dataset.prepare(worlds, path, OPTIONS, source)
    assert {r["world"] for r in made.kept.collect()} == {"one", "two"} and [r["world"] for r in made.skipped.collect()] == ["hole"]
    assert made.report.where("severity = 'error'").count() == 0
    heights = dataset.sample(spark.createDataFrame([(i, *p) for i, p in enumerate(flat[:8])], "id int, lon double, lat double"), ["id"], dataset.read_heights(spark, path), OPTIONS)
    want = [0.25 * x - 0.125 * y + 100 for x, y in corners["one"] + corners["two"]]
    assert all(abs(r["height"] - want[r["id"]]) < 1e-6 for r in heights.collect())
    assert main(["sample", str(flat[0][0]), str(flat[0][1]), path]) == 0
    assert abs(float(capsys.readouterr().out) - want[0]) < 1e-6
    assert main(["sample", "10.0", "50.0", path]) == 0 and capsys.readouterr().out.strip() == "nan"
    assert main(["validate", path]) == 0
    window = dataset.plan(spark.createDataFrame([("one", i, *p) for i, p in enumerate(flat[:4])], "world string, seq int, lon double, lat double"), OPTIONS)
    own = dataset.world_heights(spark, path, "one", window, OPTIONS)
    shape = window.first()
    assert own.count() == shape["width"] * shape["height"] and own.where("v is null").count() == 0


WORLDS = "name string, points array<struct<lon: double, lat: double>>"


def make_worlds(spark, corners):
    flat = lonlat(spark, [p for c in corners.values() for p in c])
    return spark.createDataFrame([(n, [{"lon": a, "lat": b} for a, b in flat[4 * i : 4 * i + 4]]) for i, n in enumerate(corners)], WORLDS), flat


class Imagery:
    """Colours by pixel; every fifth is not seen."""

    coverage = (-180.0, -90.0, 180.0, 90.0)
    source_id = "colours"

    def read_rgba(self, windows):
        from hypsogrid.sources.heights import FormulaImagery

        col, row = F.col("col"), F.col("row")
        return FormulaImagery(col % 256, row % 256, F.lit(9), F.when((col + row) % 5 == 0, 0).otherwise(255)).read_rgba(windows)


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_builds_again_only_what_changed(spark, tmp_path):
    """Imagery, the geographic lattice, tiles used again, conflicts, strays, damage and a failed build."""
    first, second = {"one": square(20, 40, 15)}, {"one": square(20, 40, 15), "two": square(90, 50, 12)}
    worlds, _ = make_worlds(spark, second)
    source = BlockSource(blocks.to_blocks(plane(spark).where("col < 150"), 8), 8)
    options = replace(OPTIONS, include_rgb=True)
    path = f"file://{tmp_path}/set"
    made = dataset.prepare(worlds.where("name = 'one'"), path, options, source, Imagery())
    assert made.stats["written"] == 4 and made.stats["reused"] == 0 and made.stats["min_delta"] == made.stats["max_delta"] == 0.0
    assert made.report.where("severity = 'error'").count() == 0 and dataset.validate(spark, path).where("severity = 'error'").count() == 0
    heights = files_of(tmp_path / "set/heights")
    again = dataset.prepare(worlds, path, options, source, Imagery())
    assert {(r["ix"], r["iy"]): r["action"] for r in again.outcomes.collect() if r["action"] == "reused"}.keys() == {(0, 0), (1, 0), (0, 1), (1, 1)}
    now = files_of(tmp_path / "set/heights")
    assert heights.items() <= now.items() and len(now) > len(heights)
    # tags that differ are a conflict, and nothing changes; with overwrite those tiles are written anew
    state = files_of(tmp_path / "set/state")
    other = BlockSource(source.table, 8, source_id="other")
    with pytest.raises(FileExistsError, match="tags differ"):
        dataset.prepare(worlds, path, options, other, Imagery())
    assert files_of(tmp_path / "set/heights") == now and files_of(tmp_path / "set/state") == state
    replaced = dataset.prepare(worlds, path, replace(options, overwrite=True), other, Imagery())
    assert replaced.stats["reused"] == 0 and replaced.stats["written"] == again.stats["written"] + 4
    found = dataset.validate(spark, path)
    assert found.where("severity = 'error'").count() == 0 and found.where("check = 'stray'").count() > 0
    removed = dataset.collect_garbage(spark, path)
    assert removed > 0 and dataset.validate(spark, path).where("check = 'stray'").count() == 0
    # reading by world
    data = dataset.WorldDataset(spark, path)
    assert data.world_names() == ["one", "two"] and data.has_rgb and len(data.safety_area("two")) == 4
    window = data.fill_window("one")
    image = data.read_height("one").join(data.read_rgb("one").where("col % 2 = 0 and row % 2 = 0").selectExpr("col div 2 as col", "row div 2 as row", "r", "g", "b", "mask"), ["col", "row"])
    assert image.count() == window["width"] * window["height"]
    k = options.wgs_height_factor
    for r in image.where("v is not null").take(20):
        x, y = (window["col_min"] + r["col"]) * k, (window["row_min"] + r["row"]) * k
        assert r["mask"] == ((x + y) % 5 != 0) and (not r["mask"] or (r["r"], r["g"], r["b"]) == (x % 256, y % 256, 9))
    deg = dataset._degrees(options)
    centres = data.read_height("one").where("v is not null").select("col", "row", "v", (-180 + (F.col("col") + window["col_min"] + 0.5) * deg).alias("lon"), (90 - (F.col("row") + window["row_min"] + 0.5) * deg).alias("lat"))
    off = centres.join(data.sample(centres, ["col", "row"]), ["col", "row"]).select(F.max(F.abs(F.col("height") - F.col("v")))).first()[0]
    assert off < 1e-4
    with pytest.raises(dataset.WorldNotFoundError):
        data.world("three")
    # heights are scanned twice in a whole report, the lattice three times, imagery twice
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in plans
    report = dataset.validate(spark, path)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert [len(re.findall(rf"FileScan parquet [^\n]*set/{kind}", plan)) for kind in dataset.KINDS] == [2, 3, 2]
    # damage is seen: a lost file, and a changed one
    lost = next(f for f in sorted((tmp_path / "set/heights").rglob("*.parquet")))
    keep = lost.read_bytes()
    lost.unlink()
    assert dataset.validate(spark, path).where("severity = 'error' and check = 'missing tile'").count() == 1
    lost.write_bytes(keep)
    points = spark.read.parquet(f"{path}/state/test_points").withColumn("height", F.col("height") + 1)
    rows = points.collect()
    spark.createDataFrame(rows, points.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/state/test_points")
    assert dataset.validate(spark, path).where("severity = 'error' and check = 'value'").count() == len(rows)


def test_failed_build_leaves_the_old_one(spark, tmp_path, monkeypatch):
    worlds, _ = make_worlds(spark, {"one": square(20, 40, 15), "far": square(20, 400, 15)})
    source = BlockSource(blocks.to_blocks(plane(spark), 8), 8, coverage=(OPTIONS.origin_x, OPTIONS.origin_y - 200, OPTIONS.origin_x + 200, OPTIONS.origin_y))
    path = f"file://{tmp_path}/set"
    made = dataset.prepare(worlds, path, OPTIONS, source)
    assert [(r["world"], "coverage" in r["reason"]) for r in made.skipped.collect()] == [("far", True)]
    before = files_of(tmp_path / "set")

    def broken(*a, **k):
        return spark.createDataFrame([("error", "test", "all", "broken")], "severity string, check string, subject string, message string")

    monkeypatch.setattr(dataset, "validate_state", broken)
    with pytest.raises(dataset.BuildError, match="broken"):
        dataset.prepare(worlds, path, replace(OPTIONS, rebuild=True), source)
    assert files_of(tmp_path / "set") == before and not [p for p in (tmp_path / "set").iterdir() if "tmp" in p.name]


def test_pixels_answered_twice(spark):
    px = spark.createDataFrame([(0, 0, 2.0), (0, 0, 1.0), (0, 0, 1.0), (1, 0, 5.0), (1, 0, None)], "col long, row long, v float")
    assert {(r["col"], r["v"]) for r in blocks.pixels_of(blocks.to_blocks(px, 8), 8).collect()} == {(0, 1.0), (1, 5.0)}


def grid_files(folder):
    """A coarse grid over central Europe and a fine one in it, a metre higher."""
    folder.mkdir(parents=True)
    r, c = np.mgrid[0:9, 0:17]
    (folder / "coarse.gtx").write_bytes(undulations.encode(46.0, 10.0, 1.0, 1.0, 40 + 0.5 * c + 0.25 * r))
    r, c = np.mgrid[0:201, 0:201]
    (folder / "fine.gtx").write_bytes(undulations.encode(49.0, 14.0, 0.005, 0.005, 41 + 0.5 * (4 + c * 0.005) + 0.25 * (3 + r * 0.005)))


def test_heights_are_converted(spark, tmp_path):
    """Two nested binary grids, both planes, so that the bilinear undulation is known."""
    grid_files(tmp_path / "grids/egm96")
    corners = {"one": square(20, 40, 15)}
    worlds, flat = make_worlds(spark, corners)
    source = BlockSource(blocks.to_blocks(plane(spark), 8), 8)
    options = replace(OPTIONS, datum="wgs84-ellipsoid", undulations=f"file://{tmp_path}/grids")
    made = dataset.prepare(worlds, f"file://{tmp_path}/set", options, source)
    inner = 14 <= flat[0][0] <= 15 and 49 <= flat[0][1] <= 50
    want = [0.25 * x - 0.125 * y + 100 + 40 + inner + 0.5 * (lon - 10) + 0.25 * (lat - 46) for (x, y), (lon, lat) in zip(corners["one"], flat)]
    got = dataset.WorldDataset(spark, f"file://{tmp_path}/set").sample(spark.createDataFrame([(i, *p) for i, p in enumerate(flat)], "id int, lon double, lat double"), ["id"])
    assert all(abs(r["height"] - want[r["id"]]) < 1e-3 for r in got.collect())
    assert 40 < made.stats["min_delta"] <= made.stats["max_delta"] < 48 and made.stats["drift"] < 1e-3 and made.stats["converted"] == made.stats["n_valid"]
    info = dataset.WorldDataset(spark, f"file://{tmp_path}/set").info
    assert info["heightmap"]["vertical_crs"] == "wgs84-ellipsoid" and info["transform"]["steps"] == [{"grid": "egm96", "sign": 1}] and info["transform"]["checksums"].keys() == {"egm96"}
    with pytest.raises(vertical.VerticalError, match="egm96"):
        dataset.prepare(worlds, f"file://{tmp_path}/none", replace(options, undulations=None), source)
    with pytest.raises(vertical.VerticalError, match="outside its grids"):
        far = undulations.from_nodes(spark.createDataFrame([("g", c, r, 1.0) for c in range(2) for r in range(2)], "grid string, col int, row int, n double"),
                                     spark.createDataFrame([("g", 0.0, 0.0, 1.0, 1.0, 2, 2)], "grid string, west double, south double, dlon double, dlat double, n_cols int, n_rows int"))
        dataset.prepare(worlds, f"file://{tmp_path}/none", replace(options, undulations=None), source, grids={"egm96": far})
    assert not list((tmp_path / "none").glob("heights/build=*"))


def test_undulation_files(spark, tmp_path):
    values = np.arange(130 * 70, dtype=float).reshape(130, 70)
    values[5, 6] = np.nan
    folder = tmp_path / "g"
    folder.mkdir()
    (folder / "a.gtx").write_bytes(undulations.encode(-10.0, 170.0, 0.25, 0.5, values))  # across the 180th meridian
    blocks_ = undulations.read(spark, f"file://{folder}", 16)
    places = [(170.0, -10.0), (171.25, -9.3), (-170.0, 3.0), (204.5, 22.25), (173.1, -8.8), (160.0, 0.0), (180.0, 22.26), (None, 1.0)]
    got = vertical.undulation(spark.createDataFrame(places, "lon double, lat double"), blocks_, 16).collect()
    for r in got:
        u, v = ((r["lon"] - 170) % 360 / 0.5, (r["lat"] + 10) / 0.25) if r["lon"] is not None else (-1, -1)
        if not (0 <= u <= 69 and 0 <= v <= 129):
            assert r["undulation"] is None
            continue
        c, k = min(int(u), 68), min(int(v), 128)
        near = values[k : k + 2, c : c + 2]
        assert (r["undulation"] is None) if np.isnan(near).any() else abs(r["undulation"] - (70 * v + u)) < 1e-3
    nodes = spark.createDataFrame([("a.gtx", int(c), int(k), float(values[k, c])) for k in range(130) for c in range(70) if not np.isnan(values[k, c])], "grid string, col int, row int, n double")
    frames = undulations.grids(blocks_)
    sort = lambda df: sorted((r["bc"], r["br"], r["width"], r["nodes"]) for r in df.collect())
    assert str(sort(undulations.from_nodes(nodes, frames, 16))) == str(sort(blocks_))
    for bad in (b"short", undulations.encode(0.0, 0.0, 1.0, 1.0, np.zeros((3, 3)))[:-4], undulations.encode(0.0, 0.0, -1.0, 1.0, np.zeros((3, 3)))):
        (folder / "bad.gtx").write_bytes(bad)
        with pytest.raises(Exception, match="bad.gtx"):
            undulations.read(spark, f"file://{folder}").count()


def test_choice_of_operations():
    assert [s for s, _ in vertical.select("bpv", "egm96", {"cr2005", "egm96"}).steps] == ["cr2005", "egm96"]
    assert vertical.select("bpv", "bpv", set()).steps == ()
    with pytest.raises(vertical.VerticalError, match="cr2005, egm96"):
        vertical.select("bpv", "egm96", set())
    with pytest.raises(vertical.VerticalError, match="no known vertical datum"):
        vertical.select("sea", "egm96", set())


def test_equal_catalogues_are_equal_files(spark, tmp_path):
    rows = spark.range(500).select((F.col("id") * 7 % 500).alias("world"), (F.col("id") % 3).alias("ix"), (F.col("id") % 5).alias("iy"))
    content = []
    for n, parts in enumerate((3, 7)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = rows.repartition(parts, F.rand(n))
        catalogue.write_table(df, f"file://{tmp_path}/{n}", ("world", "ix", "iy"), 120)
        content.append(([f.read_bytes() for f in sorted((tmp_path / str(n)).glob("part-*"))], catalogue.digest(spark.read.parquet(f"file://{tmp_path}/{n}"))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(content[0][0]) == 5 and content[0] == content[1]
    assert catalogue.digest(rows) == content[0][1] != catalogue.digest(rows.where("world > 0"))


def test_command_line(spark, tmp_path, capsys):
    worlds, flat = make_worlds(spark, {"one": square(20, 40, 15)})
    text = "mrs_uav_managers: {{safety_area_manager: {{safety_area: {{horizontal: {{frame_name: {frame}, points: [{points}]}}}}}}}}"
    (tmp_path / "w").mkdir()
    (tmp_path / "w/world_one.yaml").write_text(text.format(frame="latlon_origin", points=", ".join(f"{lat!r}, {lon!r}" for lon, lat in flat)))
    (tmp_path / "w/bad.yaml").write_text(text.format(frame="local", points="1, 2"))
    blocks.to_blocks(plane(spark), 8).write.parquet(f"file://{tmp_path}/blocks")
    common = ["--tile-px", "32", "--block-px", "8", "--resolution", "1", "--origin", "-765500", "-1121200", "--datum", "egm96", "--rgb-resolution-m", "2", "--wgs-tile-px", "64", "--wgs-height-factor", "2"]
    out = f"{tmp_path}/set"
    assert main([*common, "prepare", f"{tmp_path}/w", "--heights", f"{tmp_path}/blocks", "--output", out]) == 0
    said = capsys.readouterr()
    assert "1 worlds, 4 tiles written" in said.out and "bad.yaml: frame is not" in said.err
    assert main(["sample", repr(flat[0][0]), repr(flat[0][1]), out]) == 0 and abs(float(capsys.readouterr().out) - (0.25 * 20 - 0.125 * 40 + 100)) < 1e-6
    assert main(["validate", out]) == 0
    assert main([*common, "prepare", f"{tmp_path}/w", f"{tmp_path}/w/bad.yaml", "--output", out]) == 2
    assert main([*common, "prepare", f"{tmp_path}/none.yaml", "--output", out]) == 2 and main(["--tile-px", "100", "validate", out]) == 2
    assert main([*common, "prepare", f"{tmp_path}/w", "--output", out]) == 2  # no source
    (tmp_path / "empty").mkdir()
    assert main(["validate", f"{tmp_path}/empty"]) == 1


def test_options():
    for bad in ({"resolution": 0}, {"tile_px": 100}, {"datum": "sea"}, {"interpolation": "spline"}, {"retries": -1}, {"plausible": (1.0, 1.0)}):
        with pytest.raises(OptionError):
            PrepareOptions(**bad)
    assert SamplerOptions("x").dataset == "x"
    with pytest.raises(ValueError):
        require_datum(BlockSource(None, 8, datum="egm96"), "wgs84-ellipsoid")


def test_fixture_of_the_projection(spark):
    """A plane sampled at published places: 0.25 x - 0.125 y + 100 from the grid's corner."""
    rows = projection.krovak(spark.createDataFrame([(14.42, 50.08), (None, 50.0), (float("nan"), 50.0)], "lon double, lat double")).collect()
    assert abs(rows[0]["x"] + 743000) < 2000 and abs(rows[0]["y"] + 1044000) < 2000 and rows[1]["x"] is None and rows[2]["y"] is None


def test_failed_swap_keeps_the_target(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    storage.write_atomically(spark.range(3), path)
    with pytest.raises(ValueError):
        storage.write_atomically(spark.range(5), path, overwrite=True, validate=lambda df: df.where("id = 4"))
    assert spark.read.parquet(path).count() == 3 and storage.clean(spark, f"file://{tmp_path}") == 0


def meets(polygon, box, steps=400):
    """Plain test of a convex polygon against a closed box: a corner of one in the other, or a point of an edge in the box."""
    west, south, east, north = box
    inside = lambda x, y: west <= x <= east and south <= y <= north
    sides = list(zip(polygon, polygon[1:] + polygon[:1]))
    turn = lambda px, py: {((bx - ax) * (py - ay) - (by - ay) * (px - ax)) >= 0 for (ax, ay), (bx, by) in sides}
    if any(len(turn(x, y)) == 1 for x in (west, east) for y in (south, north)):
        return True
    return any(inside(ax + (bx - ax) * k / steps, ay + (by - ay) * k / steps) for (ax, ay), (bx, by) in sides for k in range(steps + 1))


def test_polygons_against_boxes(spark):
    """Triangles and rectangles of quarters, against the tiles that they meet by the plain test."""
    rng = random.Random(8)
    shapes = []
    for _ in range(25):
        x, y, w, h = (rng.randrange(2, 70) / 4 + 0.125 for _ in range(4))
        shapes.append(rng.choice([[(x, y), (x + w, y), (x + w, y + h), (x, y + h)], [(x, y), (x + w, y), (x, y + h)], [(x + w, y), (x + w, y + h), (x, y + h)]]))
    v = spark.createDataFrame([(i, k, float(a), float(b)) for i, p in enumerate(shapes) for k, (a, b) in enumerate(p)], "world int, seq int, x double, y double")
    got = {(r["world"], r["ix"], r["iy"]) for r in polygons.tiles_met(v, 4.0).collect()}
    want = {(i, x, y) for i, p in enumerate(shapes) for x in range(10) for y in range(10) if meets(p, (4.0 * x, 4.0 * y, 4.0 * x + 4, 4.0 * y + 4))}
    assert got == want
