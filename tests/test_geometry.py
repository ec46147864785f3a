"""Golden grid values, predicates, validity, overlay and projections against plain Python."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rooftally.functions import geometry as geo
from rooftally.functions import grid, kernels
from rooftally.operators import quality, spatial
from tests.shapes import RINGS, area, box, inside, ring, star


def cells(spark, rings, size=0.5):
    df = spark.createDataFrame([(1, r) for r in rings], f"boundary_id int, rings {RINGS}")
    return spatial.boundary_to_grid(df, size).orderBy("grid_i", "grid_j").collect()


def test_grid_golden_cell(spark):
    (cell,) = cells(spark, [box(119.34238, 26.01709, 119.37546, 26.04441)])
    assert cell["grid_id"] == "GBA_050_I0598_J0232"
    assert (cell["minx"], cell["miny"], cell["maxx"], cell["maxy"]) == (119.0, 26.0, 119.5, 26.5)


def test_grid_neighbours_share_cells(spark):
    df = spark.createDataFrame([(1, box(0.1, 0.1, 0.49, 0.9)), (2, box(0.49, 0.1, 0.9, 0.9))], f"boundary_id int, rings {RINGS}")
    shared = spatial.shared_cells(spatial.boundary_to_grid(df, 0.5), 1, 2)
    assert {r["grid_id"] for r in shared.collect()} == {"GBA_050_I0360_J0180", "GBA_050_I0360_J0181"}


def test_grid_origin_and_lines(spark):
    assert [c["grid_id"] for c in cells(spark, [box(-179.9, -89.9, -179.6, -89.6)])] == ["GBA_050_I0000_J0000"]
    # ends exactly on a line: no cell beyond; starts on a line: no cell before; world edge is clamped
    assert [(c["grid_i"], c["grid_j"]) for c in cells(spark, [box(0, 0, 0.5, 0.5)])] == [(360, 180)]
    assert max(c["grid_i"] for c in cells(spark, [box(179.2, 0.1, 180, 0.4)])) == 719
    # a boundary of no width on a line has no cell
    assert cells(spark, [[[(0.5, 0.1), (0.5, 0.4), (0.5, 0.1)]]]) == []


def test_grid_does_not_round_up(spark):
    below = 0.4999999999999999
    df = spark.createDataFrame([(below,)], "v double").select(grid.min_index(F.col("v"), -180, 0.5).alias("i"))
    assert df.first()["i"] == 360


@pytest.mark.parametrize("size", [0, -1, 0.7, 0.125])
def test_grid_bad_size(size):
    with pytest.raises(ValueError):
        grid.checked_size(size)


def test_empty_boundary_has_no_grid(spark):
    df = spark.createDataFrame([], f"boundary_id int, rings {RINGS}")
    assert spatial.boundary_to_grid(df, 0.5).count() == 0


def test_assign_golden(spark):
    shapes = [box(0.1, 0.1, 0.2, 0.2), box(0.8, 0.8, 1.1, 1.1), box(1.1, 1.1, 1.2, 1.2)]
    features = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"id int, rings {RINGS}")
    features = features.withColumn("p", geo.interior_point(F.col("rings"))).withColumns({"rep_x": F.col("p.x"), "rep_y": F.col("p.y")})
    unit = spark.createDataFrame([(1, box(0, 0, 1, 1))], f"boundary_id int, rings {RINGS}")
    assert sorted(r["id"] for r in spatial.assign_to_boundary(features, unit).collect()) == [0, 1]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_assign_equals_brute_force(spark, monkeypatch, limit):
    """Concave boundaries, holes, overlapping polygons of one boundary, points on outlines; broadcast and salted."""
    import rooftally.operators.spatial as module
    from rooftally.session import lookup_join

    monkeypatch.setattr(module, "lookup_join", lambda *a, **k: lookup_join(*a, **{**k, "max_rows": limit}))
    rng = random.Random(5)
    bounds = [(0, star(rng, 2, 2, 1.5)), (0, star(rng, 3, 2, 1.0)), (1, [*box(0, 0, 4, 4), *box(1, 1, 3, 3)]), (2, star(rng, -0.2, 0.1, 0.7, 25)), (2, star(rng, -0.2, 0.1, 0.7, 25))]
    bounds.append(bounds[0])  # the same polygon twice must not cancel itself
    points = [(rng.uniform(-1, 5), rng.uniform(-1, 5)) for _ in range(1500)] + [(0.0, 0.0), (4.0, 2.0), (1.0, 1.0), (2.0, 1.0), (0.5, 4.0)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, rep_x double, rep_y double")
    table = spark.createDataFrame(bounds, f"boundary_id int, rings {RINGS}")
    got = {(r["id"], r["boundary_id"]) for r in spatial.assign_to_boundary(df, table, 0.25).collect()}
    want = {(i, b) for i, (x, y) in enumerate(points) for b, rings in bounds if inside(rings, x, y)}
    assert got == want
    assert spatial.assign_to_boundary(df, table, 0.25).count() == len(want)


def utm(lon, lat, zone):
    """Reference transverse Mercator: sixth-order series in the excentricity (Snyder), no false origin."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, dl = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, aa = math.tan(p) ** 2, ep2 * math.cos(p) ** 2, math.cos(p) * dl
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p) - 35 * e2**3 / 3072 * math.sin(6 * p))
    x = k0 * n * (aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa**5 / 120)
    y = k0 * (m + n * math.tan(p) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c * c) * aa**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa**6 / 720))
    return x, y


def test_utm_matches_series(spark):
    spots = [(119.3, 26.0), (117.0, 0.0), (116.0, -45.5), (119.9, 70.0)]
    df = spark.createDataFrame(spots, "lon double, lat double").select("lon", "lat", geo.utm_point(F.col("lon"), F.col("lat"), F.lit(50)).alias("p"))
    for r in df.collect():
        x, y = utm(r["lon"], r["lat"], 50)
        assert abs(r["p"]["x"] - x) < 0.01 and abs(r["p"]["y"] - y) < 0.01


def test_buffer_equals_brute_force(spark):
    rng = random.Random(3)
    shape = star(rng, 118.0, 26.0, 0.3)
    points = [(rng.uniform(117.5, 118.5), rng.uniform(25.5, 26.5)) for _ in range(600)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id int, rep_x double, rep_y double")
    table = spark.createDataFrame([(1, shape)], f"boundary_id int, rings {RINGS}")
    got = {r["id"] for r in spatial.assign_with_buffer(df, table, 3000.0, 0.1).collect()}

    def distance(x, y):
        px, py = utm(x, y, 50)
        best = math.inf
        corners = [utm(a, b, 50) for a, b in shape[0]]
        for (x1, y1), (x2, y2) in zip(corners, corners[1:]):
            t = max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            best = min(best, math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1)))
        return best

    want = {i for i, (x, y) in enumerate(points) if inside(shape, x, y) or distance(x, y) <= 3000}
    assert got == want
    assert len(got) > len({i for i, (x, y) in enumerate(points) if inside(shape, x, y)})
    with pytest.raises(ValueError):
        spatial.assign_with_buffer(df, table, -1)


def test_interior_point_lies_inside(spark):
    rng = random.Random(8)
    shapes = [star(rng, rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(0.1, 2), rng.randint(5, 20)) for _ in range(200)]
    shapes.append([*box(0, 0, 4, 4), *box(0.5, 0.5, 3.5, 3.5)])  # the middle is a hole
    shapes.append([ring((0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (4, 3), (4, 4), (0, 4))])
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"id int, rings {RINGS}")
    for r in df.select("id", geo.interior_point(F.col("rings")).alias("p")).collect():
        assert inside(shapes[r["id"]], r["p"]["x"], r["p"]["y"])
    empty = spark.createDataFrame([(None,), ([],)], f"rings {RINGS}").select(geo.interior_point(F.col("rings")).alias("p"))
    assert [r["p"] for r in empty.collect()] == [None, None]
    flat = spark.createDataFrame([([[(0.0, 0.0), (2.0, 0.0), (0.0, 0.0)]],)], f"rings {RINGS}")
    assert tuple(flat.select(geo.interior_point(F.col("rings")).alias("p")).first()["p"]) == (1.0, 0.0)


VALIDITY = [
    (box(0, 0, 1, 1), True),
    ([ring((0, 0), (1, 1), (1, 0), (0, 1))], False),  # bow-tie
    ([*box(0, 0, 4, 4), *box(1, 1, 2, 2)], True),  # hole
    ([*box(0, 0, 4, 4), *box(3, 3, 5, 5)], False),  # rings cross
    ([*box(0, 0, 1, 1), *box(1, 0, 2, 1)], False),  # rings share an edge
    ([*box(0, 0, 1, 1), *box(1, 1, 2, 2)], True),  # rings meet in a point
    ([ring((0, 0), (4, 0), (4, 4), (2, 0), (0, 4))], False),  # touches its own edge
    ([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]], False),  # not closed
    ([[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]], False),
    ([ring((0, 0), (2, 0), (4, 0), (4, 4), (0, 4))], True),  # straight through a vertex
    ([ring((0, 0), (4, 0), (4, 4), (2, 4), (2, 2), (2, 4), (0, 4))], False),  # spike
    ([ring((0, 0), (1, 0), (1, 0), (1, 1), (0, 1))], True),  # repeated point
    ([[(0.0, 0.0), (1.0, 0.0), (float("nan"), 1.0), (0.0, 0.0)]], False),
    (None, False),
]


@pytest.mark.parametrize("small", [40, 0])
def test_validity(monkeypatch, small):
    monkeypatch.setattr(kernels, "SMALL_EDGES", small)
    shapes = [None if s is None else [np.array(r) for r in s] for s, _ in VALIDITY]
    assert kernels.valid_polygons(shapes).tolist() == [want for _, want in VALIDITY]


def test_validity_in_spark(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(VALIDITY)], f"id int, rings {RINGS}")
    got = {r["id"]: r["ok"] for r in df.select("id", quality.valid_geometry(F.col("rings")).alias("ok")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(VALIDITY)}
    valid, invalid = quality.split_by_validity(df)
    assert valid.count() + invalid.count() == len(VALIDITY)


def edges(rings):
    return np.vstack([np.hstack([np.array(r[:-1]), np.array(r[1:])]) for r in rings])


def test_overlay_kinds():
    shape = [np.array(r) for r in box(0, 0, 2, 2)]
    kind, rings = kernels.overlay(shape, [edges(box(1, 1, 3, 3))])
    assert kind == "POLYGON" and area(rings) == pytest.approx(1)
    assert kernels.overlay(shape, [edges(box(2, 0, 3, 2))])[0] == "LINESTRING"
    assert kernels.overlay(shape, [edges(box(2, 2, 3, 3))])[0] == "POINT"
    assert kernels.overlay(shape, [edges(box(5, 5, 6, 6))]) is None
    kind, rings = kernels.overlay(shape, [edges(box(-1, -1, 9, 9))])
    assert area(rings) == pytest.approx(4)
    # two parts with a common seam act as one mask
    kind, rings = kernels.overlay(shape, [edges(box(-1, -1, 1, 3)), edges(box(1, -1, 3, 3))])
    assert area(rings) == pytest.approx(4) and len(rings) == 1
    # overlapping parts count once
    kind, rings = kernels.overlay(shape, [edges(box(-1, -1, 1.5, 3)), edges(box(0.5, -1, 3, 3))])
    assert area(rings) == pytest.approx(4)
    # a mask with a hole
    kind, rings = kernels.overlay(shape, [edges([*box(-1, -1, 3, 3), *box(0.5, 0.5, 1.5, 1.5)])])
    assert len(rings) == 2 and area([max(rings, key=lambda r: area([r]))]) - 1 == pytest.approx(3)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_overlay_point_sets(seed):
    """A point is in the common part exactly when it is in the polygon and in some mask part."""
    rng = random.Random(seed)
    shape = star(rng, 0, 0, 1, rng.randint(4, 12))
    masks = [star(rng, rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(0.3, 1.5), rng.randint(4, 12)) for _ in range(rng.randint(1, 3))]
    cut = kernels.overlay([np.array(r) for r in shape], [edges(m) for m in masks])
    rings = [] if cut is None or cut[0] != "POLYGON" else [[tuple(p) for p in r] for r in cut[1]]
    for _ in range(60):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        want = inside(shape, x, y) and any(inside(m, x, y) for m in masks)
        assert inside(rings, x, y) == want


@pytest.mark.parametrize(("x", "y", "length", "width"), [(1.2e7, 3e6, 5e5, 20.0), (1.2e5, 3e5, 1e4, 20.123), (100.0, 20.0, 50.0, 0.001)])
def test_slanted_edge_keeps_all_area(x, y, length, width):
    """Boxes on a long slanted mask edge, in metres and degrees, against the closed formula for a half-plane."""
    rng = random.Random(5)
    u, v = 0.8 * length, 0.6 * length  # the mask lies left of the edge from (x, y) to (x + u, y + v)
    mask = edges([ring((x, y), (x + u, y + v), (x - v, y + u))])
    for _ in range(400):
        s = rng.uniform(0.05, 0.95)
        a, b = x + u * s + rng.uniform(-1.2, 0.2) * width, y + v * s + rng.uniform(-1.2, 0.2) * width
        cut = kernels.overlay([np.array(box(a, b, a + width, b + width)[0])], [mask])
        rings = [r - r[0] for r in cut[1]] if cut and cut[0] == "POLYGON" else []
        # distances of the corners from the edge, in units of the box
        far = (0.8 * (b + width - y) - 0.6 * (a - x)) / width
        above = [max(0.0, far - i * 0.6 - j * 0.8) ** 2 for i in (0, 1) for j in (0, 1)]
        want = (above[0] - above[1] - above[2] + above[3]) / (2 * 0.6 * 0.8)
        assert area(rings) / width**2 == pytest.approx(want, abs=1e-4)


def test_an_outline_that_does_not_close_is_an_error():
    with pytest.raises(kernels.OpenRing):
        kernels._link(np.array([[0.0, 0.0, 1.0, 0.0], [1.0, 0.0, 1.0, 1.0]]))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_clip_equals_overlay_of_everything(spark, monkeypatch, limit):
    import rooftally.operators.spatial as module
    from rooftally.session import lookup_join

    monkeypatch.setattr(module, "lookup_join", lambda *a, **k: lookup_join(*a, **{**k, "max_rows": limit}))
    rng = random.Random(11)
    masks = [star(rng, 1, 1, 1.2, 14), star(rng, 2, 1.3, 0.9, 9), [*box(-1, -1, 0.4, 3), *box(-0.6, 0, 0, 2)]]
    shapes = [star(rng, rng.uniform(-1.2, 3), rng.uniform(-1.2, 3), rng.uniform(0.02, 0.5), rng.randint(4, 9)) for _ in range(250)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"feature_id int, rings {RINGS}")
    table = spark.createDataFrame([(m,) for m in masks], f"rings {RINGS}")
    got = {r["feature_id"]: r for r in spatial.clip(df, table, 0.25).collect()}
    for i, s in enumerate(shapes):
        cut = kernels.overlay([np.array(r) for r in s], [edges(m) for m in masks])
        if cut is None:
            assert i not in got
        else:
            mine = [[(p["x"], p["y"]) for p in r] for r in got[i]["rings"]]
            for _ in range(20):
                x, y = rng.uniform(-1, 3), rng.uniform(-1, 3)
                assert inside(mine, x, y) == (inside(s, x, y) and any(inside(m, x, y) for m in masks))


def test_mercator_round_trip(spark):
    df = spark.createDataFrame([(119.34238, 26.01709), (-180.0, -85.0), (0.0, 0.0)], "lon double, lat double")
    out = df.select("lon", "lat", geo.mercator_x(F.col("lon")).alias("x"), geo.mercator_y(F.col("lat")).alias("y"))
    out = out.select("*", geo.longitude(F.col("x")).alias("lon2"), geo.latitude(F.col("y")).alias("lat2")).collect()
    for r in out:
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9) and r["lat2"] == pytest.approx(r["lat"], abs=1e-9)
    assert out[0]["x"] == pytest.approx(13285132.97, abs=0.05)


def test_wkb_and_wkt(spark):
    shapes = [box(0, 0, 1, 2), [*box(0, 0, 4, 4), *box(1, 1, 2, 2)], None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"id int, rings {RINGS}")
    back = {r["id"]: r for r in df.select("id", "rings", kernels.from_wkb(kernels.as_wkb("rings")).alias("again")).collect()}
    assert all(r["rings"] == r["again"] for r in back.values())
    zero = spark.createDataFrame([([[(-0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (-0.0, 0.0)]],), ([[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]],)], f"rings {RINGS}")
    assert zero.select(kernels.as_wkb("rings").alias("w")).distinct().count() == 1
    wkt = spark.createDataFrame([("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((2 2, 3 2, 3 3, 2 2)))",)], "w string")
    assert wkt.select(F.size(geo.rings_from_wkt(F.col("w"))).alias("n")).first()["n"] == 2
    assert df.filter("id = 0").select(geo.bbox_wkt(F.lit(10020011.0), F.lit(0.5), F.lit(2.0), F.lit(3.25)).alias("w")).first()["w"] == (
        "POLYGON((10020011.0 0.5,2.0 0.5,2.0 3.25,10020011.0 3.25,10020011.0 0.5))"
    )


def test_cells_of_in_sql(spark):
    from rooftally.functions import tables

    tables.register(spark)
    rows = spark.sql("SELECT * FROM cells_of(119.34238D, 26.01709D, 119.37546D, 26.04441D, 0.5D)").collect()
    assert [tuple(r) for r in rows] == [("GBA_050_I0598_J0232", 598, 232)]
    spark.createDataFrame([(1, 0.1, 0.1, 0.6, 0.5), (2, 179.9, 89.9, 180.0, 90.0)], "id int, a double, b double, c double, d double").createOrReplaceTempView("boxes")
    rows = spark.sql("SELECT id, grid_i, grid_j FROM boxes, LATERAL cells_of(a, b, c, d, 0.5D)").collect()
    assert sorted(map(tuple, rows)) == [(1, 360, 180), (1, 361, 180), (2, 719, 359)]
