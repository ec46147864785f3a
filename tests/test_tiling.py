"""Chunks, slices, volumes, merging and the adaptive cover on small literal data and against plain Python."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rooftally.operators import tiling
from rooftally.plans import build
from rooftally.session import lookup_join, with_position
from tests.shapes import RINGS, box, ring


def leaves(points, target, depth=0, path=""):
    """Plain Python quadtree over (id, x, y)."""
    if len(points) <= target or depth >= 32:
        return {p[0]: path for p in points}
    xs, ys = [p[1] for p in points], [p[2] for p in points]
    mx, my = (min(xs) + max(xs)) / 2, (min(ys) + max(ys)) / 2
    groups = {}
    for p in points:
        groups.setdefault((1 if p[1] >= mx else 0) + (2 if p[2] >= my else 0), []).append(p)
    if len(groups) <= 1:
        ordered = sorted(points, key=lambda p: (p[2], p[1], p[0]))
        return {p[0]: f"{path}/{k // target:09d}" for k, p in enumerate(ordered)}
    out = {}
    for digit, group in groups.items():
        out |= leaves(group, target, depth + 1, path + str(digit))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_quadtree_equals_recursion(spark, seed):
    rng = random.Random(seed)
    points = [(i, rng.choice([rng.random(), rng.gauss(0.2, 0.01)]), rng.random()) for i in range(1500)]
    points += [(2000 + i, 0.25, 0.75) for i in range(130)]  # more equal points than a chunk holds
    df = spark.createDataFrame(points, "id int, rep_x double, rep_y double")
    got = {r["id"]: r["node"] for r in tiling.quadtree_chunks(df, 40, order=["id"]).collect()}
    assert got == leaves(points, 40)


def test_quadtree_hot_dataset(spark):
    """One dataset with most rows and several small ones; each has its own tree."""
    rng = random.Random(4)
    rows = [("big", i, rng.random(), rng.random()) for i in range(900)] + [(f"s{k}", 1000 + 10 * k + i, 5.0, 5.0) for k in range(5) for i in range(10)]
    df = spark.createDataFrame(rows, "dataset string, id int, rep_x double, rep_y double")
    out = tiling.quadtree_chunks(df, 30, order=["id"], dataset="dataset").collect()
    assert {r["id"]: r["node"] for r in out if r["dataset"] == "big"} == leaves([r[1:] for r in rows if r[0] == "big"], 30)
    assert {r["node"] for r in out if r["dataset"] != "big"} == {""}


def test_depth_limit(spark):
    points = [(i, i / 1000, 0.0) for i in range(200)]
    df = spark.createDataFrame(points, "id int, rep_x double, rep_y double")
    assert {len(r["node"]) for r in tiling.quadtree_chunks(df, 2, max_depth=3).collect()} == {3}


def test_slices_and_volumes(spark):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(23)], "id int, rep_x double, rep_y double")
    out = tiling.spatial_slices(df, 5, order=["id"]).collect()
    ordered = sorted(out, key=lambda r: (r["rep_y"], r["rep_x"], r["id"]))
    assert [r["slice"] for r in ordered] == [k // 5 for k in range(23)]
    parts = tiling.volumes(spark.range(5), ["id"], 2).groupBy("part").count().orderBy("part").collect()
    assert [(r["part"], r["count"]) for r in parts] == [(1, 2), (2, 2), (3, 1)]


def test_positions_with_one_hot_key(spark):
    """A third of the rows and more share the leading key; the unique last key still spreads and orders them."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id")).alias("k"), "id")
    out = with_position(df, "k", "id", partitions=6).collect()
    ordered = sorted(out, key=lambda r: (r["k"], r["id"]))
    assert [r["position"] for r in ordered] == list(range(1, 3001))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_salted_equals_broadcast(spark, how):
    big = spark.range(2000).select((F.col("id") % 7 * F.when(F.col("id") % 3 == 0, 0).otherwise(1)).alias("k"), "id")
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "d")], "k long, v string")
    results = [sorted(map(tuple, lookup_join(big, small, ["k"], how, max_rows=n).collect()), key=str) for n in (100, 0)]
    assert results[0] == results[1]


# --- merging --------------------------------------------------------------------------------------------------

def greedy(chunks, minimum, maximum, reach, ratio):
    """Plain quadratic greedy merge over (members, n, box), in list order."""
    work = [([name], n, b) for name, n, b in chunks]

    def area(b):
        return max(b[2] - b[0], 0) * max(b[3] - b[1], 0)

    while True:
        best = None
        for i, (_, n, a) in enumerate(work):
            if n >= minimum:
                continue
            for j, (_, m, b) in enumerate(work):
                if i == j or n + m > maximum:
                    continue
                gap = (max(a[0] - b[2], b[0] - a[2], 0) ** 2 + max(a[1] - b[3], b[1] - a[3], 0) ** 2) ** 0.5
                hull = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
                both = area(a) + area(b)
                if gap <= reach or (both > 0 and area(hull) / both <= ratio):
                    key = (gap, area(hull), i, j)
                    best = min(best, key) if best else key
        if best is None:
            return {frozenset(w[0]) for w in work}
        i, j = sorted(best[2:])
        (m1, n1, a), (m2, n2, b) = work[i], work[j]
        joined = (m1 + m2, n1 + n2, (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])))
        work = [w for k, w in enumerate(work) if k not in (i, j)] + [joined]


@pytest.mark.parametrize("bound, seed, layers, most", [(5_000, 9, 6, 25), (12, 9, 3, 25), (3, 5, 1, 9)])
def test_merge_small_chunks_equals_greedy(spark, bound, seed, layers, most):
    """Also where datasets are taken apart by what can depend on each other, by distance, and by single best pairs."""
    rng = random.Random(seed)
    rows, want = [], set()
    for d in range(layers):
        chunks = []
        for k in range(rng.randint(2, most)):
            x, y = rng.randint(0, 20) * 0.5, rng.randint(0, 20) * 0.5
            chunks.append((f"{k:03d}", rng.randint(5, 120), (x, y, x + rng.randint(1, 4) * 0.5, y + rng.randint(1, 4) * 0.5)))
        rows += [(f"d{d}", name, n, *b) for name, n, b in chunks]
        want |= {(f"d{d}", g) for g in greedy(chunks, 50, 130, 0.5, 1.25)}
    df = spark.createDataFrame(rows, "dataset string, node string, n int, minx double, miny double, maxx double, maxy double")
    out = tiling.merge_small_chunks(df, 50, 130, 0.5, 1.25, bound=bound).toPandas()
    assert isinstance(out, pd.DataFrame)
    got = {(d, frozenset(g["node"])) for (d, _), g in out.groupby(["dataset", "merged"])}
    assert got == want


def test_spatial_chunks_partition_the_input(spark):
    """Chunks hold every building once, none is above the limit, names count from the south-west."""
    rng = random.Random(2)
    shapes = []
    for i in range(600):
        x, y = (rng.uniform(10, 10.4), rng.uniform(50, 50.3)) if i % 3 else (rng.uniform(10, 10.02), rng.uniform(50, 50.02))
        shapes.append((i, "city", box(x, y, x + 0.0005, y + 0.0004)))
    shapes += [(1000 + i, "hamlet", box(1, 1, 1.001, 1.001)) for i in range(5)]
    df = spark.createDataFrame(shapes, f"row_id int, dataset string, rings {RINGS}")
    out = tiling.spatial_chunks(df, "row_id", target=100, minimum=30, maximum=120).select("row_id", "dataset", "chunk_name").collect()
    assert sorted(r["row_id"] for r in out) == sorted(s[0] for s in shapes)
    sizes = pd.Series([r["chunk_name"] for r in out]).value_counts()
    assert sizes.max() <= 120 and sizes["hamlet"] == 5
    names = sorted(n for n in sizes.index if n != "hamlet")
    assert names == [f"city_001_{k:03d}" for k in range(1, len(names) + 1)]


def test_crowded_place_is_sliced(spark):
    """All buildings in one place: the tree cannot split them, slices must, and nothing is lost."""
    rows = [(i, "d", box(1, 1, 1.001, 1.001)) for i in range(95)] + [(200, "d", box(5, 5, 5.001, 5.001))]
    df = spark.createDataFrame(rows, f"row_id int, dataset string, rings {RINGS}")
    out = tiling.spatial_chunks(df, "row_id", target=20, minimum=0, maximum=20).groupBy("chunk_name").count().collect()
    assert sorted(r["count"] for r in out) == [1, 15, 20, 20, 20, 20]


def test_places_are_worked_out_once(spark):
    """Rectangles, other shapes and missing ones: the rows that come back are not projected a second time."""
    rows = [(i, "d", box(i, i, i + 1, i + 1)) for i in range(8)] + [(8, "d", [[(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]), (9, "d", None), (10, "d", [])]
    df = spark.createDataFrame(rows, f"row_id int, dataset string, rings {RINGS}")
    out = tiling.spatial_chunks(df, "row_id", target=3, minimum=0, maximum=3)
    assert set(out.columns) == {"row_id", "dataset", "rings", "chunk_name"} and out.count() == 11
    assert "TAN(" not in out._jdf.queryExecution().toString().upper()


def test_rectangles_travel_as_corners(spark):
    """Plain rectangles lose their rings on the way and get the same ones back; other shapes and corners on an axis keep theirs."""
    slant = [ring((1, 1), (4, 1), (1, 4))]
    shapes = [box(2, 3, 4, 5), slant, box(0, 1, 2, 2), [[(1.0, -0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]], [ring((1, 1), (1, 2), (2, 2), (2, 1))], [], None]
    df = spark.createDataFrame([(i, "d" if i % 2 else None, s) for i, s in enumerate(shapes)], f"row_id int, dataset string, rings {RINGS}")
    packed = tiling.spatial_chunks(df, "row_id", target=2, minimum=0, maximum=2, packed=True)
    kept = {r["row_id"]: (r["_west"], r["rings"] is None) for r in packed.collect()}
    assert kept == {0: (2.0, True), 1: (None, False), 2: (None, False), 3: (None, False), 4: (None, False), 5: (None, False), 6: (None, True)}
    back = {r["row_id"]: r["rings"] and [[(p["x"], p["y"]) for p in one] for one in r["rings"]] for r in tiling.unpacked(packed).collect()}
    assert [str(back[i]) for i in range(len(shapes))] == [str(s) for s in shapes]


def test_layer_sorts_numbers_before_texts(spark):
    """Duplicates are ranked by the digest of their corners, and the rows of the layer are not stored again after their chunks are known."""
    rows = [(i, "d", box(i, i, i + 1, i + 1)) for i in range(1, 9)]
    layer, _ = build.process_layer(spark.createDataFrame(rows, f"row_id int, dataset string, rings {RINGS}"), target=3, minimum=0, maximum=3)
    text = layer._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 2 and "WindowGroupLimit [_w" in text
    assert "dataset" in text.split("WindowGroupLimit [", 1)[1].split(",")[1]


def test_numbered_nodes_are_the_paths(spark):
    """Numbers of leaves stand for the same leaves as their paths, in trees of several datasets, one of them without a name."""
    rng = random.Random(4)
    points = [(i, (None, "a", "b")[i % 3], rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(1500)]
    df = spark.createDataFrame(points, "id int, d string, rep_x double, rep_y double")
    tree = tiling.build_quadtree(df, 20, scope=["d"])
    numbers = tree.number(df).select("id", "d", "_at")
    named = tree.paths(numbers.select("d", "_at").distinct())
    assert named.count() == numbers.select("d", "_at").distinct().count()
    got = {r["id"]: r["node"] for r in numbers.filter("d IS NOT NULL").join(named, ["d", "_at"]).collect()}
    assert got == leaves([(i, x, y) for i, d, x, y in points if d == "a"], 20) | leaves([(i, x, y) for i, d, x, y in points if d == "b"], 20)
    assert {r["id"]: r["node"] for r in tree.assign(df).collect()} == got | {p[0]: "" for p in points if p[1] is None}


def test_chunks_without_broadcasts_are_the_same(spark, monkeypatch):
    """Very large trees and tables of names join by a shuffle: same rows, same names."""
    rng = random.Random(6)
    spots = [(i, ("a", "b", None)[i % 3], rng.uniform(1, 2), rng.uniform(1, 2)) for i in range(300)]
    df = spark.createDataFrame([(i, d, box(x, y, x + 0.01, y + 0.01)) for i, d, x, y in spots], f"row_id int, dataset string, rings {RINGS}")

    def chunks():
        return sorted((r["row_id"], r["dataset"] or "", r["chunk_name"], str(r["rings"])) for r in tiling.spatial_chunks(df, "row_id", target=10, minimum=5, maximum=12).collect())

    want = chunks()
    assert len(want) == 300 and len({w[2] for w in want}) > 30
    monkeypatch.setattr(tiling, "NAMES_ROWS", 0)
    assert chunks() == want
    monkeypatch.setattr(tiling, "BROADCAST_ROWS", 0)
    assert chunks() == want


@pytest.mark.parametrize("kind, ids, repeated", [
    ("long", [-65, -64, -1, 0, 63, 64, 127, 2**62], False), ("long", [-1, 5, -1], True), ("int", [64, 128, 64], True), ("int", [None, 1], False), ("int", [None, None], True),
    ("string", ["x", "y"], False), ("string", ["x", "x"], True),
])
def test_repeated_row_ids(spark, kind, ids, repeated):
    df = spark.createDataFrame([("a", i) for i in ids] + [("b", i) for i in ids[:1]], f"dataset string, row_id {kind}")
    assert (tiling._repeated(df, "dataset", "row_id").count() > 0) == repeated


def test_process_layer_steps(spark):
    bow = [[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]
    rows = [
        (1, "d", 12.0, box(0, 0, 1, 1)), (2, "d", 0.0, box(2, 0, 3, 1)), (3, "d", -3.0, box(4, 0, 5, 1)), (4, "d", None, box(6, 0, 7, 1)),
        (5, "d", 9.0, bow), (6, "d", 3.0, box(0, 0, 1, 1)), (7, "d", 5.0, None),
    ]
    df = spark.createDataFrame(rows, f"row_id int, dataset string, HEIGHT double, rings {RINGS}")
    layer, report = build.process_layer(df)
    assert sorted(r["row_id"] for r in layer.collect()) == [1, 4]
    (r,) = report.collect()
    assert (r["input_count"], r["valid_count"], r["removed_zero_height_count"], r["removed_duplicate_count"], r["output_count"]) == (7, 5, 2, 1, 2)
    # a layer without a height column keeps all valid shapes
    layer, _ = build.process_layer(df.drop("HEIGHT"))
    assert layer.count() == 4


# --- adaptive cover -------------------------------------------------------------------------------------------

def test_cover_by_span(spark):
    """A square of 0.25 degrees with a largest span of 0.1: sixteen leaves, five splits."""
    area = spark.createDataFrame([("a", 0.0, 0.0, 0.25, 0.25)], "area_id string, minx double, miny double, maxx double, maxy double")
    none = spark.createDataFrame([], "minx double, miny double, maxx double, maxy double")
    (r,) = tiling.cover_stats(tiling.adaptive_cover(none, area, 10, max_span=0.1)).collect()
    assert (r["requests"], r["splits"], r["leaves"]) == (16, 5, 16)


def test_cover_over_the_cap_once(spark):
    """0.08 degrees, over the cap once: five requests, one split, four rows found."""
    area = spark.createDataFrame([("a", 0.0, 0.0, 0.08, 0.08)], "area_id string, minx double, miny double, maxx double, maxy double")
    spots = spark.createDataFrame([(x, y, x, y) for x in (0.01, 0.06) for y in (0.02, 0.07)], "minx double, miny double, maxx double, maxy double")
    cover = tiling.adaptive_cover(spots, area, 3)
    (r,) = tiling.cover_stats(cover).collect()
    assert (r["requests"], r["splits"]) == (5, 1)
    assert cover.filter("leaf").agg(F.sum("n")).first()[0] == 4


def test_cover_gives_up_at_the_smallest_span(spark):
    area = spark.createDataFrame([("a", 0.0, 0.0, 0.01, 0.01)], "area_id string, minx double, miny double, maxx double, maxy double")
    spots = spark.createDataFrame([(0.005, 0.005, 0.005, 0.005)] * 3, "minx double, miny double, maxx double, maxy double")
    with pytest.raises(ValueError):
        tiling.adaptive_cover(spots, area, 2)
    loose = tiling.adaptive_cover(spots, area, 2, strict=False)
    assert loose.filter("leaf and n > 2").count() > 0


@pytest.mark.parametrize("target", [2, 100])
def test_rows_without_a_dataset_stay(spark, target):
    boxes = [(i, None if i % 3 else "d", [ring((i, i), (i + 1, i), (i + 1, i + 1))]) for i in range(12)]
    df = spark.createDataFrame(boxes, f"row_id long, dataset string, rings {RINGS}")
    out = tiling.spatial_chunks(df, "row_id", target=target, minimum=0).collect()
    assert sorted((r["row_id"], r["dataset"]) for r in out) == [(i, d) for i, d, _ in boxes]
    assert all("\0" not in r["chunk_name"] for r in out)


def test_connected_plane_is_one_group(spark, monkeypatch):
    """6 400 small chunks side by side, all connected: merged in one go."""
    monkeypatch.setattr(tiling, "_by_distance", None)
    side = 80
    chunks = spark.range(side * side).select(
        F.lit("a").alias("dataset"), F.lpad(F.col("id").cast("string"), 5, "0").alias("node"), (300 + F.col("id") * 7919 % 1100).alias("n"),
        *[((F.expr(f"{axis}") + shift) * 1.0).alias(name) for name, axis, shift in (("minx", "id % 80", 0), ("miny", "id div 80", 0), ("maxx", "id % 80", 1), ("maxy", "id div 80", 1))],
    )
    merged = tiling.merge_small_chunks(chunks, 1300, 4000, 0.05, 1.25)
    groups = merged.join(chunks, ["dataset", "node"]).groupBy("merged").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    found = groups.agg(F.sum("k").alias("all"), F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    assert found["all"] == side * side and found["most"] <= 4000 and found["groups"] < side * side / 2


def test_greedy_looks_at_neighbours_only(monkeypatch):
    """Few boxes are looked at per chunk, and boxes without numbers or without end are as before: near to none, near to all."""
    looked = []
    around = tiling._Near.around
    monkeypatch.setattr(tiling._Near, "around", lambda self, k: looked.append(found := around(self, k)) or found)
    grid = [(k, 700, float(k % 50), float(k // 50), k % 50 + 1.0, k // 50 + 1.0) for k in range(2500)]
    tiling._greedy_pairs(pd.DataFrame(grid, columns=["id", "n", *tiling._BOX]), 1300, 4000, 0.1, 1.25, float("inf"))
    assert sum(map(len, looked)) < 60 * len(looked)
    nan, end = float("nan"), float("inf")
    odd = [(1, 10, nan, nan, nan, nan), (2, 10, 0.0, 0.0, 1.0, 1.0), (3, 10, 500.0, 0.0, 501.0, 1.0), (4, 10, 100.0, 0.0, end, 1.0)]
    roots = tiling._greedy_pairs(pd.DataFrame(odd, columns=["id", "n", *tiling._BOX]), 15, 20, 0.1, 1.25, end)
    assert roots["root"].tolist() == [1, 2, 3, 3]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_salts_hot_keys_only(spark, how, monkeypatch):
    monkeypatch.setattr("rooftally.session.HOT_ROWS", 100)
    big = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id")
    small = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v")).union(spark.createDataFrame([(0, 5), (None, 6)], "k long, v long"))
    results = [sorted(map(tuple, lookup_join(big, small, ["k"], how, max_rows=n).collect()), key=str) for n in (10_000, 0)]
    assert results[0] == results[1] and results[0]
    if how != "inner":
        return
    pairs = 2 * 667 + len([k for k in range(1, 1500) if k % 3 == 1])
    monkeypatch.setattr("rooftally.session.SALTS", 10**6)  # a copy of every row of the small side would not end
    monkeypatch.setattr("rooftally.session.HOT_ROWS", 10_000)
    assert lookup_join(big, small, ["k"], "inner", max_rows=0).count() == pairs
