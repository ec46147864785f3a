"""Union of polygons: area and outline against a fine raster and closed forms, over cells of several sizes."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftally.functions import geometry as geo
from rooftally.operators import dissolve as outlines
from rooftally.operators.dissolve import dissolve
from tests.shapes import RINGS, box, inside, ring, star


def union(spark, shapes, size):
    df = spark.createDataFrame([("a", s) for s in shapes], f"boundary_id string, rings {RINGS}")
    rows = dissolve(df, size=size).select("ring", "hole", geo.signed_area(F.col("ring")).alias("area")).collect()
    return [([tuple(p) for p in r["ring"]], r["hole"], r["area"]) for r in rows]


@pytest.mark.parametrize("size", [0.25, 0.7, 50.0])
@pytest.mark.parametrize(
    "shapes, area, rings",
    [
        ([box(0, 0, 2, 2), box(1, 1, 3, 3)], 7, 1),  # overlapping
        ([box(0, 0, 1, 1), box(1, 0, 2, 1), box(0, 0, 1, 1)], 2, 1),  # a shared seam, a repeated polygon
        ([box(0, 0, 4, 4), box(1, 1, 2, 2)], 16, 1),  # nested
        ([[box(0, 0, 4, 4)[0], box(1, 1, 3, 3)[0]], box(1.5, 1.5, 2.5, 2.5)], 13, 3),  # an island in a hole
        ([[box(0, 0, 4, 4)[0], box(1, 1, 3, 3)[0]], box(1, 1, 3, 3)], 16, 1),  # a hole that another polygon fills
        ([box(0, 0, 3, 1), box(0, 2, 3, 3), box(0, 0, 1, 3), box(2, 0, 3, 3)], 8, 2),  # four bars round a hole
        ([box(0, 0, 1, 1), box(5, 5, 6, 6)], 2, 2),  # apart
    ],
)
def test_closed_forms(spark, shapes, area, rings, size):
    found = union(spark, shapes, size)
    assert sum(a for *_, a in found) == pytest.approx(area, abs=1e-7) and len(found) == rings
    assert all(hole == (a < 0) for _, hole, a in found)


def test_corners_of_a_simple_union(spark):
    (outline, hole, _), = union(spark, [box(0, 0, 2, 2), box(1, 1, 3, 3)], 0.25)
    assert not hole and outline[0] == outline[-1]
    assert set(outline) == {(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 2.0), (0.0, 2.0)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_stars(spark, seed):
    rng = random.Random(seed)
    shapes = [star(rng, rng.uniform(0, 6), rng.uniform(0, 6), rng.uniform(0.5, 2), rng.randint(3, 14)) for _ in range(12)]
    found = union(spark, shapes, 0.5)
    rings = [r for r, *_ in found]
    spots = [(rng.uniform(-2, 8), rng.uniform(-2, 8)) for _ in range(1500)]
    assert all(inside(rings, x, y) == any(inside(s, x, y) for s in shapes) for x, y in spots)


@pytest.mark.parametrize("pairs", [1, 50, None])
def test_cells_are_worked_on_together(monkeypatch, pairs):
    """A batch of cells gives what each gives alone, and takes one step for all of them, or more where the pairs are bounded."""
    rng, polygons, cells = random.Random(3), [], []
    for _ in range(40):
        held = [star(rng, rng.uniform(0, 1), rng.uniform(0, 1), rng.uniform(0.3, 1), rng.randint(3, 8))[0] for _ in range(rng.randint(0, 3))]
        cells.append(len(held))
        polygons += [np.array([(*a, *b) for a, b in zip(r, r[1:])]) for r in held]
    calls, meeting = [], outlines._meeting

    def counted(*edges):
        calls.append(1)
        return meeting(*edges)

    def work(shapes, counts):
        box = np.tile((0.0, 0.0, 1.0, 1.0), (len(counts), 1))
        edges = np.vstack(shapes) if shapes else np.empty((0, 4))
        ends = (np.cumsum([0, *map(len, shapes)]), np.cumsum([0, *counts]))
        owner, sizes, points = outlines.strung(*outlines.cell_outlines(edges, *ends, np.zeros(len(shapes), bool), box, 9))
        return [(o, p.tolist()) for o, p in zip(owner.tolist(), np.split(points, np.cumsum(sizes)[:-1]))]

    starts = np.cumsum([0, *cells])
    alone = [(k, path) for k, n in enumerate(cells) for _, path in work(polygons[starts[k] : starts[k] + n], [n])]
    monkeypatch.setattr(outlines, "_meeting", counted)
    if pairs:
        monkeypatch.setattr(outlines, "PAIRS_AT_ONCE", pairs)
    assert work(polygons, cells) == alone and alone
    assert pairs or len(calls) == 1


def test_nothing_to_dissolve(spark):
    assert union(spark, [], 0.25) == [] and union(spark, [None, []], 0.25) == []
    assert ring((0, 0), (1, 0), (1, 1))[0] == (0.0, 0.0)
