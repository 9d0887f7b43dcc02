import random

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import spatial as sp


@pytest.fixture(scope="module")
def grid(spark):
    rng = random.Random(1)
    cells = [(y, x, 48 + y * 0.03 + rng.uniform(-0.005, 0.005), -114 + x * 0.03 + rng.uniform(-0.005, 0.005))
             for y in range(15) for x in range(15)]
    return cells, spark.createDataFrame(cells, "iy int, ix int, lat double, lon double")


def brute(cells, lat, lon):
    return min(((la - lat) ** 2 + (lo - lon) ** 2, y, x) for y, x, la, lo in cells)[1:]


def test_nearest_equals_brute_force(spark, grid):
    cells, df = grid
    rng = random.Random(2)
    places = [(i, rng.uniform(47.95, 48.5), rng.uniform(-114.05, -113.5)) for i in range(120)]
    # far away, on a hot spot shared by many points, and without a position
    places += [(500, 0.0, 0.0), (501, 60.0, -100.0)] + [(600 + i, 0.0, 0.0) for i in range(60)] + [(900, None, -114.0)]
    points = spark.createDataFrame(places, "id int, lat double, lon double")
    got = {r.id: (r.iy, r.ix) for r in sp.nearest_cell(points, df, 0.04).collect()}
    assert len(got) == len(places) and got.pop(900) == (None, None)
    assert got == {i: brute(cells, la, lo) for i, la, lo in places if la is not None}


def test_corner_has_three_neighbours(spark, grid):
    cells, df = grid
    corner = [c for c in cells if c[:2] == (0, 0)][0]
    middle = [c for c in cells if c[:2] == (7, 7)][0]
    points = spark.createDataFrame([(1, corner[2], corner[3]), (2, middle[2], middle[3])], "id int, lat double, lon double")
    mids = sp.neighbour_midpoints(sp.nearest_cell(points, df, 0.04), df)
    assert {r.id: r.n for r in mids.groupBy("id").agg(F.count("*").alias("n")).collect()} == {1: 3, 2: 8}
    ring = sp.box_rings(mids).filter("id = 2").first().ring
    order = [(r.index_y - 7, r.index_x - 7) for r in mids.filter("id = 2").orderBy("ord").collect()]
    assert order == sp.NEIGHBOURS and len(ring) == 8
    first = [c for c in cells if c[:2] == (6, 7)][0]
    assert ring[0].lat == pytest.approx((middle[2] + first[2]) / 2, abs=1e-4)


@pytest.fixture(scope="module")
def raster(spark):
    rng = random.Random(3)
    rows = [(f"f{i % 3}", rng.uniform(0, 10), rng.uniform(0, 10), rng.choice([-9999.0, rng.uniform(0, 3000)])) for i in range(3000)]
    rows += [("f0", 2.2, 2.2, 100.0)] * 1500  # a third of all pixels in one tile
    boxes = [(i, y, y + h, x, x + w) for i, (y, x, h, w) in enumerate(
        (rng.uniform(0, 9), rng.uniform(0, 9), rng.uniform(0.1, 3), rng.uniform(0.1, 3)) for _ in range(40))]
    boxes += [(100, 20.0, 21.0, 20.0, 21.0), (101, 2.0, 4.0, 2.0, 4.0)]
    return (rows, boxes, spark.createDataFrame(rows, "file string, x double, y double, elevation_m double"),
            spark.createDataFrame(boxes, "id int, min_lat double, max_lat double, min_lon double, max_lon double"))


@pytest.mark.parametrize("side", [0.25, 1.0, 5.0])
def test_zonal_mean_equals_brute_force(raster, side):
    rows, boxes, pixels, table = raster
    want = {}
    for i, y0, y1, x0, x1 in boxes:
        inside = [v for _, x, y, v in rows if y0 <= y <= y1 and x0 <= x <= x1 and v >= 0]
        want[i] = sum(inside) / len(inside) if inside else -1.0
    got = {r.id: r.elevation for r in sp.zonal_mean(table, pixels, side).collect()}
    assert got == pytest.approx(want)


def test_first_covering_file_and_rejects(spark, raster):
    rows, boxes, pixels, table = raster
    points = table.select("id")
    cache = spark.createDataFrame([(0, 123.0, "kept")], "id int, elevation double, file string")
    found, rest = sp.point_elevation(points, cache, table, pixels, 0.5)
    got = {r.id: (r.elevation, r.file) for r in found.collect()}
    assert got[0] == (123.0, "kept") and [r.id for r in rest.collect()] == [100]
    i, y0, y1, x0, x1 = boxes[-1]
    inside = [v for f, x, y, v in rows if f == "f0" and y0 <= y <= y1 and x0 <= x <= x1 and v >= 0]
    assert got[101] == (pytest.approx(sum(inside) / len(inside)), "f0")


def test_pixels_in_boxes_pairs(raster):
    rows, boxes, pixels, table = raster
    want = sum(1 for _, y0, y1, x0, x1 in boxes for _, x, y, _ in rows if y0 <= y <= y1 and x0 <= x <= x1)
    assert sp.pixels_in_boxes(table, pixels, 0.7).count() == want


def test_raster_pixels(spark):
    strips = spark.createDataFrame(
        [("r", 10.0, 50.0, 1.0, -1.0, 0, [[1.0, 2.0], [3.0, 4.0]]), ("r", 10.0, 50.0, 1.0, -1.0, 2, [[5.0, 6.0]])],
        "file string, x0 double, y0 double, dx double, dy double, row0 int, strip array<array<double>>",
    )
    got = sorted((r.elevation_m, r.x, r.y) for r in sp.raster_pixels(strips).collect())
    assert got[0] == (1.0, 10.5, 49.5) and got[-1] == (6.0, 11.5, 47.5) and len(got) == 6


def test_pick_cells(spark):
    values = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0)], "iy int, ix int, t double")
    where = spark.createDataFrame([(9, 0, 1), (8, 0, 1)], "id int, iy int, ix int")
    assert sorted((r.id, r.t) for r in sp.pick_cells(values, where).collect()) == [(8, 2.0), (9, 2.0)]


@pytest.mark.parametrize("side", [0.004, 0.03, 3.0])
def test_pyramid_for_any_side_and_distance(spark, grid, side, monkeypatch):
    """Far, near, crowded and tied places; the plan has no pairs of all with all."""
    monkeypatch.setattr(sp, "_CROWD", 16)
    cells, df = grid
    rng = random.Random(5)
    places = [(i, rng.uniform(48, 48.5), rng.uniform(-114, -113.5)) for i in range(60)]
    places += [(100 + i, rng.uniform(-80, 80), rng.uniform(-170, 170)) for i in range(60)]
    places += [(200 + i, 48.2 + i * 1e-6, -113.9) for i in range(80)]
    places += [(400, 48.0, float("nan")), (401, float("inf"), 0.0), (402, None, None)]
    points = spark.createDataFrame(places, "id int, lat double, lon double")
    again = df.unionByName(df.selectExpr("iy + 100 as iy", "ix", "lat", "lon")).unionByName(df.selectExpr("iy", "ix", "cast('NaN' as double) as lat", "lon"))
    found = sp.nearest_cell(points, again, side)
    got = {r.id: (r.iy, r.ix) for r in found.collect()}
    assert {got.pop(i) for i in (400, 401, 402)} == {(None, None)}
    assert got == {i: brute(cells, la, lo) for i, la, lo in places if i < 400}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_cells(spark, grid):
    with pytest.raises(ValueError):
        sp.nearest_cell(grid[1].select("lat", "lon"), grid[1].limit(0), 0.1)


def test_quadtree_cover_is_a_partition(spark):
    """Rim and squares of every box are its tiles, each once, and few."""
    rng = random.Random(6)
    boxes = [(i, y, y + rng.choice([0, 1, 5, 60]) * rng.random(), x, x + rng.choice([0, 2, 40]) * rng.random())
             for i in range(40) for y, x in [(rng.uniform(-30, 30), rng.uniform(-30, 30))]]
    table = spark.createDataFrame(boxes, "id int, min_lat double, max_lat double, min_lon double, max_lon double")
    spans = sp._spans(table, 1.0, 1024)
    seen = {}
    for r in sp._rim(spans).select("id", "level", "_ty", "_tx").union(sp._whole(spans)).collect():
        size = 1 << r.level
        seen.setdefault(r.id, []).extend((y, x) for y in range(r._ty * size, (r._ty + 1) * size) for x in range(r._tx * size, (r._tx + 1) * size))
    for i, y0, y1, x0, x1 in boxes:
        want = [(y, x) for y in range(int(y0 // 1), int(y1 // 1) + 1) for x in range(int(x0 // 1), int(x1 // 1) + 1)]
        assert sorted(seen[i]) == want


def test_huge_box_is_bounded(spark, raster):
    rows, _, pixels, _ = raster
    boxes = [(1, -1e9, 1e9, -1e9, 1e9), (2, -1e300, 1e300, float("-inf"), float("inf")), (3, 2.0, 4.0, 2.0, 1e7), (4, 1.0, 0.0, 1.0, 2.0), (5, None, 1.0, 0.0, 1.0)]
    table = spark.createDataFrame(boxes, "id int, min_lat double, max_lat double, min_lon double, max_lon double")
    spans = sp._spans(table, 0.001, sp._RIM)
    assert sp._rim(spans).groupBy("id").count().agg({"count": "max"}).first()[0] <= 4 * (sp._RIM + 1)
    assert sp._whole(spans).groupBy("id").count().agg({"count": "max"}).first()[0] <= 20 * sp._RIM
    got = {r.id: (r.n, round(r.total, 4)) for r in sp.box_sums(table, pixels, 0.25).collect()}
    good = [(x, y, v) for _, x, y, v in rows if v >= 0]
    part = [v for x, y, v in good if 2 <= y <= 4 and x >= 2]
    total = (len(good), round(sum(v for *_, v in good), 4))
    assert got == {1: pytest.approx(total), 2: pytest.approx(total), 3: pytest.approx((len(part), round(sum(part), 4)))}
    pairs = sp.pixels_in_boxes(table, pixels, 0.25).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in pairs} == {1: len(rows), 2: len(rows), 3: sum(1 for _, x, y, _ in rows if 2 <= y <= 4 and x >= 2)}


def test_pixels_are_read_once(spark, raster, tmp_path, monkeypatch):
    _, _, pixels, table = raster
    pixels.write.parquet(str(tmp_path / "pixels"))
    stored = spark.read.parquet(str(tmp_path / "pixels"))
    plans, cut = [], sp.cut_lineage
    monkeypatch.setattr(sp, "cut_lineage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df, name))
    plans.append(sp.box_sums(table, stored, 0.25)._jdf.queryExecution().optimizedPlan().toString())
    # One written step has the pixels in its plan, once; what is left to run reads only written sums and covers.
    assert sum(plan.count("elevation_m#") > 0 for plan in plans) == 1
    assert max(plan.count("Relation [file") for plan in plans) == 1


def test_box_sums_take_few_rows_for_a_box(spark, monkeypatch):
    """Boxes of all sizes beside brute force, in parted strips; no step lists the tiles along an edge."""
    monkeypatch.setattr(sp, "_CROWD_PIXELS", 64)
    monkeypatch.setattr(sp, "_CROWD_EDGES", 16)
    rng = random.Random(8)
    rows = [("ab"[i % 2] if i % 7 else None, rng.randrange(160) / 8, rng.randrange(160) / 8, float(rng.randrange(-3, 50))) for i in range(1500)]
    rows += [("a", 3.0, 4.0, float("inf")), ("b", 5.0, 5.0, float("nan")), ("b", float("nan"), 5.0, 1.0), ("a", None, 5.0, 1.0), ("a", float("inf"), 5.0, 2.0)]
    pixels = spark.createDataFrame(rows, "file string, x double, y double, elevation_m double")
    boxes = [(i if i % 9 else None, y, y + rng.choice([0, 0.01, 1, 30]) * rng.random(), x, x + rng.choice([0, 0.01, 2, 30]) * rng.random())
             for i in range(120) for y, x in [(rng.randrange(160) / 8, rng.randrange(160) / 8)]]
    boxes += [boxes[5], (500, 0.0, 20.0, 0.0, float("inf"))]
    table = spark.createDataFrame(boxes, "id int, min_lat double, max_lat double, min_lon double, max_lon double")
    sizes, cut = [], sp.cut_lineage
    monkeypatch.setattr(sp, "cut_lineage", lambda df, name: sizes.append((out := cut(df, name)).count()) or out)
    found = sp.box_sums(table, pixels, 0.02, ("file",)).collect()
    want = {}
    for i, y0, y1, x0, x1 in boxes:
        for file, x, y, v in rows:
            if x is not None and x0 <= x <= x1 and y0 <= y <= y1 and not v < 0:
                want.setdefault((i, file), []).append(v)
    assert {(r.id, r.file): r.n for r in found} == {k: len(v) for k, v in want.items()}
    assert {(r.id, r.file): r.total for r in found} == {k: pytest.approx(sum(v), nan_ok=True) for k, v in want.items()}
    # A box of 30 by 30 degrees is 1,500 tiles long.
    assert max(sizes) < 1510 + 100 * len(boxes)
