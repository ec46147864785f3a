"""Multi-part geometry: readers and printers, roles of rings, validity, overlapping parts, the cover of large outlines."""

import json
import random
import struct
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftally.functions import kernels
from rooftally.functions import parts as multi
from rooftally.operators import spatial
from rooftally.sources import layers
from tests.shapes import RINGS, box, inside, ring, star, write_shapefile

PARTS = f"array<{RINGS}>"
HOLE = ring((1, 1), (1, 2), (2, 2), (2, 1))
TWO = [[box(0, 0, 4, 4)[0], HOLE], box(3, 3, 6, 6)]


def arrays(parts):
    return [[np.array(r) for r in p] for p in parts]


def plain(value):
    return None if value is None else [[[tuple(p) for p in r] for r in part] for part in value]


def test_text_and_binary_round_trips(spark):
    rng = random.Random(3)
    shapes = [TWO, [box(0, 0, 1, 1)], [star(rng, rng.uniform(-170, 170), 1e-9, 0.1) for _ in range(3)], [[ring((0.1 + 0.2, 1e-12), (1e7 / 3, 2), (5, 123456789.123))]], [], None]
    df = spark.createDataFrame(list(enumerate(shapes)), f"id int, parts {PARTS}")
    text = df.select("id", "parts", multi.from_wkt(multi.as_wkt(F.col("parts"))).alias("t"), multi.from_wkb(multi.as_wkb("parts")).alias("b"), multi.as_geojson(F.col("parts")).alias("g"))
    again = text.select("*", multi.from_geojson(F.get_json_object("g", "$.type"), F.get_json_object("g", "$.coordinates")).alias("j"))
    for r in again.collect():
        want = plain(r["parts"])
        assert plain(r["b"]) == want and plain(r["t"]) == want
        assert r["parts"] is None or not r["parts"] or plain(r["j"]) == want
    kinds = {r["id"]: r["k"] for r in again.select("id", F.get_json_object("g", "$.type").alias("k")).collect()}
    assert kinds[0] == "MultiPolygon" and kinds[1] == "Polygon"


def test_other_forms_of_text_and_binary(spark):
    texts = {
        "POLYGON((0 0,1 0,1 1,0 0))": [[[(0, 0), (1, 0), (1, 1), (0, 0)]]], " srid=4326;MultiPolygon Z ( ( (0 0 5, 1 0 5,1 1 5 , 0 0 5) ) , ((2 2 1,3 2 1,3 3 1,2 2 1)))": [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [[(2, 2), (3, 2), (3, 3), (2, 2)]]],
        "MULTIPOLYGON EMPTY": [], "POINT(1 2)": None, None: None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", multi.from_wkt(F.col("t")).alias("p")).collect()
    assert {r["t"]: plain(r["p"]) for r in rows} == texts
    flat = struct.pack(">BIII", 0, 3, 1, 4) + struct.pack(">8d", 0, 0, 1, 0, 1, 1, 0, 0)
    high = struct.pack("<BIIII", 1, 0xA0000003, 4326, 1, 4) + struct.pack("<12d", 0, 0, 9, 1, 0, 9, 1, 1, 9, 0, 0, 9)
    measured = struct.pack("<BIII", 1, 3003, 1, 4) + struct.pack("<16d", *[v for p in ((0, 0), (1, 0), (1, 1), (0, 0)) for v in (*p, 7, 8)])
    mixed = struct.pack("<BII", 1, 7, 2) + struct.pack("<BI2d", 1, 1, 3, 4) + flat
    for data in (flat, high, measured, mixed):
        assert [[r.tolist() for r in p] for p in multi.wkb_parts(data)] == [[[[0, 0], [1, 0], [1, 1], [0, 0]]]]
    with pytest.raises(Exception):
        multi.wkb_parts(flat[:-3])


def test_roles_from_direction():
    outer, island = ring((0, 0), (0, 9), (9, 9), (9, 0)), ring((3, 3), (3, 4), (4, 4), (4, 3))
    lake = ring((2, 2), (6, 2), (6, 6), (2, 6))
    alone = ring((20, 0), (21, 0), (21, 1))
    found = multi.shells_with_holes([np.array(r) for r in (lake, outer, island, alone)])
    assert [[tuple(map(tuple, r)) for r in p] for p in found] == [[tuple(outer), tuple(lake)], [tuple(island)], [tuple(alone)]]
    assert multi.shells_with_holes(None) is None and multi.shells_with_holes([]) == []
    assert len(multi.shells_with_holes([np.array(lake), np.array(alone)])) == 2


def test_validity_with_roles():
    cases = [
        (TWO, False), ([[box(0, 0, 4, 4)[0], HOLE]], True), ([[box(0, 0, 4, 4)[0], HOLE, box(1.2, 1.2, 1.5, 1.5)[0]]], False), ([box(0, 0, 2, 2), box(2, 2, 3, 3)], True),
        ([box(0, 0, 2, 2), box(2, 0, 3, 2)], False), ([[box(0, 0, 9, 9)[0], box(1, 1, 8, 8)[0]], box(2, 2, 3, 3)], True), ([box(0, 0, 9, 9), box(2, 2, 3, 3)], False),
        ([[box(0, 0, 4, 4)[0], box(6, 6, 7, 7)[0]]], False), ([[box(0, 0, 4, 4)[0], ring((0, 2), (2, 1), (4, 2), (2, 3))]], False),
        ([[box(0, 0, 9, 9)[0], ring((1, 1), (3, 1), (2, 3)), ring((2, 3), (4, 4), (1, 4)), ring((1, 1), (1, 4), (0.5, 2))]], False),
        ([[box(0, 0, 9, 9)[0], ring((1, 1), (3, 1), (2, 3)), ring((2, 3), (4, 4), (1, 4))]], True), ([], False), (None, False), ([[]], False),
    ]
    assert multi.valid_parts([p if p is None else arrays(p) for p, _ in cases]).tolist() == [v for _, v in cases]


def test_overlapping_parts_keep_their_points(spark):
    features = spark.createDataFrame([(1, 3.5, 3.5), (2, 1.5, 1.5), (3, 5.0, 5.0), (4, 0.0, 2.0), (5, 7.0, 7.0)], "id int, rep_x double, rep_y double")
    whole = spark.createDataFrame([("a", TWO)], f"boundary_id string, parts {PARTS}")
    assert {r["id"] for r in spatial.assign_to_boundary(features, whole, size=0.7).collect()} == {1, 3, 4}
    assert {r["id"] for r in spatial.assign_with_buffer(features, whole, 1000.0, size=0.7).collect()} == {1, 3, 4}
    # closed cells: 9 by 9 meet the first part, 7 by 7 the second, 4 by 4 both
    assert spatial.boundary_to_grid(whole, 0.5).count() == 81 + 49 - 16


def test_readers_keep_parts(spark, tmp_path):
    geometry = {"type": "MultiPolygon", "coordinates": TWO}
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": "x", "properties": {}, "geometry": geometry}]}))
    row = layers.read_geojson_features(spark, str(tmp_path / "a.json")).first()
    assert plain(row["parts"]) == TWO and len(row["rings"]) == 3
    folder = tmp_path / "shp"
    folder.mkdir()
    outer, hole, second = ring((0, 0), (0, 4), (4, 4), (4, 0)), ring((1, 1), (2, 1), (2, 2)), ring((7, 7), (7, 8), (8, 8))
    write_shapefile(folder / "s", [[outer, second, hole], None], [1, 2])
    for suffix in ("shp", "SHX", "Dbf"):
        (folder / f"s.{suffix.lower()}").rename(folder / f"s.{suffix}")
    rows = layers.read_shapefiles(spark, str(folder)).orderBy("record_no").collect()
    assert plain(rows[0]["parts"]) == [[outer, hole], [second]] and rows[1]["parts"] is None and rows[0]["attributes"]["NAME"] == "n0"


@pytest.mark.parametrize("shift", [0.0, 0.25, 0.125])
def test_cover_of_outlines_along_the_grid(spark, shift):
    """Edges on the lines of the grid and through its corners, points on lines and corners."""
    s = shift
    outline = [ring((s, s), (2 + s, s), (2 + s, 0.5 + s), (1 + s, 0.5 + s), (1.5 + s, 1 + s), (1 + s, 1.5 + s), (2 + s, 1.5 + s), (2 + s, 2 + s), (s, 2 + s), (1 + s, 1 + s))]
    spots = [(k, -0.5 + 0.125 * (k % 25), -0.5 + 0.125 * (k // 25)) for k in range(625)]
    features = spark.createDataFrame(spots, "id int, rep_x double, rep_y double")
    boundary = spark.createDataFrame([("a", outline)], f"boundary_id string, rings {RINGS}")
    assert {r["id"] for r in spatial.assign_to_boundary(features, boundary, size=0.25).collect()} == {k for k, x, y in spots if inside(outline, x, y)}


def test_long_coast(spark):
    """Rows of the cover grow with the edges and the covered cells, points agree with the plain test."""
    rng, n = random.Random(8), 20_000
    angles = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radii = 10 + np.cumsum([rng.uniform(-0.002, 0.002) for _ in range(n)])
    radii += np.linspace(0, radii[0] - radii[-1], n)
    outline = [ring(*zip((radii * np.cos(angles)).tolist(), (radii * np.sin(angles)).tolist()))]
    boundary = spark.createDataFrame([("a", outline)], f"boundary_id string, rings {RINGS}").cache()
    size = 0.25
    cells = spatial.cover_cells(boundary, size).select("cell_i", F.coalesce(F.size("edges"), F.lit(0)).alias("n")).agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("edges")).first()
    assert cells["edges"] < 1.2 * n and cells["cells"] < 1.5 * np.pi * 11**2 / size**2
    spots = [(k, rng.uniform(-11, 11), rng.uniform(-11, 11)) for k in range(400)]
    features = spark.createDataFrame(spots, "id int, rep_x double, rep_y double")
    assert {r["id"] for r in spatial.assign_to_boundary(features, boundary, size=size).collect()} == {k for k, x, y in spots if inside(outline, x, y)}


def test_stacks_are_judged_as_one_by_one(monkeypatch):
    """Shapes of the same layout are judged together, with the verdicts of the plain way; only those that repeat a point or touch in three rings are taken alone."""
    rng = random.Random(3)

    def some_ring():
        x, y, w, h = rng.randint(0, 6), rng.randint(0, 6), rng.randint(1, 6), rng.randint(1, 6)
        corners = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
        return ring(*rng.choice([corners, corners[:3], corners[::-1], [(x, y + 1), (x + 2, y), (x + 4, y + 1), (x + 2, y + 2)]]))

    def shape(k):
        around = box(-1, -1, 13, 13)[0]
        one, two, three = some_ring(), some_ring(), some_ring()
        return [[[one]], [[around, one]], [[one], [two]], [[one, two]], [[around, one, two]], [[around, one], [two]], [[around, one], [two], [three]]][k % 7]

    shapes = [shape(k) for k in range(4000)] + [None, [], [[]], [[ring((0, 0), (1, 0))]], [[ring((0, 0), (float("nan"), 0), (1, 1))]]]
    column = multi.parts_to_arrow([p if p is None else arrays(p) for p in shapes])
    plainly = multi.valid_parts([p if p is None else arrays(p) for p in shapes]).tolist()
    assert 100 < sum(plainly) < 3900
    assert multi.valid_parts_column(column).tolist() == plainly
    flat_rows = [p if p is None else [np.array(r) for part in p for r in part] for p in shapes]
    assert kernels.valid_rings(kernels.rings_to_arrow(flat_rows)).tolist() == kernels.valid_polygons(flat_rows).tolist()
    sound = [[box(k, 0, k + 6, 6)[0], box(k + 1, 1, k + 5, 5)[0]] for k in range(50)]
    monkeypatch.setattr(multi, "valid_polygons", None)
    monkeypatch.setattr(multi, "well_nested", None)
    assert multi.valid_parts_column(multi.parts_to_arrow([arrays([p]) for p in sound])).all()


def test_validity_takes_no_call_per_row():
    """Calls grow with the sorts of shapes in a batch, not with its rows, and the sorts may come in any order."""
    sorts = [
        [box(0, 0, 2, 2)], [[ring((0, 0), (1, 1), (1, 0), (0, 1))]], [[ring((0, 0), (1, 0), (0, 1))]], None, [], [[]], [[box(0, 0, 4, 4)[0], HOLE]], [[HOLE], []], TWO,
        [box(k, 0, k + 0.5, 1) for k in range(15)], [*[box(k, 0, k + 0.5, 1) for k in range(15)], []], [[[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]],
    ]
    want = [True, False, True, False, False, False, True, False, False, True, False, False]
    mixed = [k for _ in range(3) for k in random.Random(5).sample(range(12), 12)]
    column = multi.parts_to_arrow([sorts[k] if sorts[k] is None else arrays(sorts[k]) for k in mixed])
    assert multi.valid_parts_column(column).tolist() == [want[k] for k in mixed]
    assert multi.valid_parts_column(column.slice(5, 20)).tolist() == [want[k] for k in mixed[5:25]]

    def calls(test, column):
        seen = []
        test(column)
        sys.setprofile(lambda frame, event, what: seen.append(event))
        test(column)
        sys.setprofile(None)
        return len(seen)

    small = [sorts[k] if sorts[k] is None else arrays(sorts[k]) for k in (0, 1, 2, 3, 4, 5, 6, 8)]
    flat_rows = [p if p is None else [r for part in p for r in part] for p in small]
    for test, made, rows in [(kernels.valid_rings, kernels.rings_to_arrow, flat_rows), (multi.valid_parts_column, multi.parts_to_arrow, small)]:
        assert calls(test, made(rows * 500)) < calls(test, made(rows * 5)) + 50
