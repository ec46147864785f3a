"""Union of the polygons of a boundary: its outline as directed rings.

Edges go to the join cells they cross. In each cell they are cut where they meet each other and at the cell's lines; of the pieces those stay
that have the union on one side only, turned so that it lies on their left. Pieces are strung to paths in their cell, and paths that meet at the lines
between cells are brought together by their ends. No task holds more than the polygons' edges of a batch of cells, which are cut as one stack, or one
connected outline.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.fixed_values import WORLD_MIN_X, WORLD_MIN_Y
from rooftally.functions import geometry as geo
from rooftally.functions.kernels import PAIRS_AT_ONCE, RINGS_TYPE, _cross, _meeting, _nested, rings_to_arrow
from rooftally.operators.spatial import cover_cells
from rooftally.session import has_at_most, stage

#: Decimals that points are rounded to, and how far beside a piece its sides are looked at; edges that near a cell belong to it too.
DIGITS, BESIDE, MARGIN = 9, 1e-7, 1e-6


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[k], starts[k] + 1, ...``, ``counts[k]`` numbers for each k in a row."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _blocks(counts: np.ndarray):
    """Ranges of rows that have up to ``PAIRS_AT_ONCE`` partners in all, or are one row."""
    total, first = np.cumsum(counts), 0
    while first < len(counts):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS_AT_ONCE, side="right")))
        yield np.arange(first, last)
        first = last


def _distinct(cell: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of each cell in order."""
    order = np.lexsort((*rows.T[::-1], cell))
    cell, rows = cell[order], rows[order]
    new = np.r_[True, (cell[1:] != cell[:-1]) | (rows[1:] != rows[:-1]).any(axis=1)][: len(cell)]
    return cell[new], rows[new]


def _odd_way(points: np.ndarray, edges: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Whether the way from a corner up or down, then across to the point, crosses the edge an odd number of times (as ``geo.odd_on_the_way``), row by row."""
    x1, y1, x2, y2 = edges.T
    dx, dy = x2 - x1, y2 - y1
    (px, py), (x0, y0) = points.T, corner.T

    def right(x, y):
        left, far = dx * (y - y1), (x - x1) * dy
        return ((y1 > y) != (y2 > y)) & np.where(dy > 0, left > far, left < far)

    def above(y):
        left, far = dx * (y - y1), (x0 - x1) * dy
        return np.where(left == far, (dy != 0) & ((dy > 0) == (dx > 0)), (left < far) == (dx > 0))

    up = ((x1 > x0) != (x2 > x0)) & (above(y0) != above(py))
    return up != (right(x0, py) != right(px, py))


def _cut_edges(cell: np.ndarray, edges: np.ndarray, boxes: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and piece (x1 y1 x2 y2, from its smaller end) of the edges, cut where they meet others of their cell and the cell's lines."""
    some = np.any(edges[:, :2] != edges[:, 2:], axis=1)
    cell, edges = _distinct(cell[some], edges[some])
    left, bottom, right, top = boxes.T
    lines = np.stack([np.stack(line, axis=1) for line in (
        (left, bottom - 1, left, top + 1), (right, bottom - 1, right, top + 1), (left - 1, bottom, right + 1, bottom), (left - 1, top, right + 1, top)
    )], axis=1)
    number = np.arange(len(boxes))
    order = np.argsort(np.concatenate([cell, np.repeat(number, 4)]), kind="stable")
    others = np.concatenate([edges, lines.reshape(-1, 4)])[order]
    count = np.bincount(cell, minlength=len(boxes)) + 4
    first = np.cumsum(count) - count
    own = np.arange(len(edges))
    found = [(own, np.zeros(len(own)), edges[:, :2]), (own, np.ones(len(own)), edges[:, 2:])]
    for block in _blocks(count[cell]):
        who = np.repeat(block, count[cell[block]])
        edge, other = edges[who], others[_runs(first[cell[block]], count[cell[block]])]
        d, e, o = edge[:, 2:] - edge[:, :2], other[:, 2:] - other[:, :2], other[:, :2] - edge[:, :2]
        flat = (_cross(*d.T, *e.T) == 0) & (_cross(*o.T, *d.T) == 0)
        met = _meeting(edge, other)
        for there, spots in ((~np.isnan(met[:, 0]), met), (flat, other[:, :2]), (flat, other[:, 2:])):
            spots, way = spots[there], d[there]
            along = ((spots - edge[there, :2]) * way).sum(axis=1) / (way * way).sum(axis=1)
            inside = (along > 0) & (along < 1)
            found.append((who[there][inside], along[inside], spots[inside]))
    who, along, spots = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((along, who))
    who, spots = who[order], spots[order]
    joined = who[1:] == who[:-1]
    pieces, cell = np.round(np.hstack([spots[:-1], spots[1:]])[joined], digits), cell[who[:-1][joined]]
    some = np.any(pieces[:, :2] != pieces[:, 2:], axis=1)
    pieces, cell = pieces[some], cell[some]
    swapped = (pieces[:, 0] > pieces[:, 2]) | ((pieces[:, 0] == pieces[:, 2]) & (pieces[:, 1] > pieces[:, 3]))
    return _distinct(cell, np.where(swapped[:, None], pieces[:, [2, 3, 0, 1]], pieces))


def cell_outlines(
    edges: np.ndarray, edge_at: np.ndarray, poly_at: np.ndarray, corners: np.ndarray, boxes: np.ndarray, digits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Cell and directed piece (x1 y1 x2 y2) of the outlines of the unions in a batch of cells, each with its union on the left.

    Polygon p of the batch has the edges ``edge_at[p]`` to ``edge_at[p + 1]``, cell c the polygons ``poly_at[c]`` to ``poly_at[c + 1]`` and the bounds
    ``boxes[c]``; ``corners`` says which polygons hold the lower left corner of their cell. All cells are worked on at once, in blocks of pairs.
    """
    polygons = np.diff(poly_at)
    poly_of = np.repeat(np.arange(len(corners)), np.diff(edge_at))
    first, count = edge_at[poly_at[:-1]], edge_at[poly_at[1:]] - edge_at[poly_at[:-1]]
    cell, pieces = _cut_edges(np.repeat(np.arange(len(boxes)), count), edges, boxes, digits)
    middle = (pieces[:, :2] + pieces[:, 2:]) / 2
    own = ((middle >= boxes[cell, :2]) & (middle < boxes[cell, 2:])).all(axis=1)
    cell, pieces, middle = cell[own], pieces[own], middle[own]
    d = pieces[:, 2:] - pieces[:, :2]
    length = np.hypot(d[:, 0], d[:, 1])[:, None]
    aside = np.column_stack([-d[:, 1], d[:, 0]]) / length * np.minimum(length / 1000, BESIDE)

    def covered(points: np.ndarray) -> np.ndarray:
        found = np.zeros(len(points), bool)
        for block in _blocks(count[cell]):
            at = cell[block]
            row, edge = np.repeat(np.arange(len(block)), count[at]), _runs(first[at], count[at])
            odd = _odd_way(points[block][row], edges[edge], boxes[at, :2][row])
            # a place for each polygon of each point's cell
            place = np.cumsum(polygons[at]) - polygons[at]
            crossings = np.bincount((place - poly_at[at])[row] + poly_of[edge], weights=odd, minlength=polygons[at].sum())
            holds = (crossings % 2 == 1) != corners[_runs(poly_at[at], polygons[at])]
            found[block] = np.bincount(np.repeat(np.arange(len(block)), polygons[at]), weights=holds, minlength=len(block)) > 0
        return found

    on_left, on_right = covered(middle + aside), covered(middle - aside)
    pieces = np.where((on_right & ~on_left)[:, None], pieces[:, [2, 3, 0, 1]], pieces)
    return cell[on_left != on_right], pieces[on_left != on_right]


def strung(cell: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paths of the directed pieces of each cell, parted where more than one comes in or goes out: cell and number of points of each path, in the order
    of cells, and the points of all. A path that closes repeats its first point."""
    count = len(pieces)
    places, owner = np.vstack([pieces[:, :2], pieces[:, 2:]]), np.concatenate([cell, cell])
    order = np.lexsort((places[:, 1], places[:, 0], owner))
    new = (np.diff(owner[order]) != 0) | (np.diff(places[order], axis=0) != 0).any(axis=1)
    node = np.empty(2 * count, np.int64)
    node[order] = np.cumsum(np.r_[0, new][: 2 * count])
    start, end = node[:count], node[count:]
    goes, comes = (np.bincount(n, minlength=2 * count) for n in (start, end))
    simple, at = (goes == 1) & (comes == 1), np.empty(2 * count, np.int64)
    at[start] = np.arange(count)
    following = np.where(simple[end], at[end], -1).tolist()
    used, walked, sizes = bytearray(count), [], []
    # first the paths that start where others meet, then what is left: rings
    for k in (*np.flatnonzero(~simple[start]).tolist(), *range(count)):
        before = len(walked)
        while k >= 0 and not used[k]:
            used[k] = 1
            walked.append(k)
            k = following[k]
        if len(walked) > before:
            sizes.append(len(walked) - before)
    walked, sizes = np.array(walked, np.int64), np.array(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    owner = cell[walked[starts]]
    order = np.argsort(owner, kind="stable")
    owner, sizes, walked = owner[order], sizes[order], walked[_runs(starts[order], sizes[order])]
    starts, path = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    points = np.empty((count + len(sizes), 2))
    points[starts + np.arange(len(sizes))] = pieces[walked[starts], :2]
    points[np.arange(count) + path + 1] = pieces[walked, 2:]
    return owner, sizes + 1, points


def linked(paths: list[np.ndarray]) -> list[np.ndarray]:
    """Closed rings of directed paths; every end has a start, else the polygons were not closed."""
    starts = defaultdict(list)
    for k, path in enumerate(paths):
        starts[tuple(path[0])].append(k)
    used, rings = set(), []
    for first in range(len(paths)):
        if first in used:
            continue
        ring, k = [paths[first]], first
        used.add(first)
        while (end := tuple(paths[k][-1])) != tuple(paths[first][0]):
            k = next((n for n in starts[end] if n not in used), None)
            if k is None:
                raise ValueError(f"an outline ends at {end}")
            used.add(k)
            ring.append(paths[k][1:])
        rings.append(_straightened(np.vstack(ring)))
    return rings


def _straightened(ring: np.ndarray) -> np.ndarray:
    """The closed ring without points in a straight line, which the lines between cells leave behind."""
    spots = ring[:-1]
    before, after = spots - np.roll(spots, 1, axis=0), np.roll(spots, -1, axis=0) - spots
    cross = before[:, 0] * after[:, 1] - before[:, 1] * after[:, 0]
    ahead = (before * after).sum(axis=1) > 0
    longest = np.maximum(np.hypot(*before.T), np.hypot(*after.T))
    kept = spots[~(ahead & (np.abs(cross) <= 4 * 10.0**-DIGITS * longest))]
    kept = kept if len(kept) > 2 else spots
    return np.vstack([kept, kept[:1]])


@F.arrow_udf(RINGS_TYPE)
def _paths_of_cell(edges: pa.Array, corners: pa.Array, left: pa.Array, bottom: pa.Array, right: pa.Array, top: pa.Array) -> pa.Array:
    boxes = np.column_stack([c.to_numpy(zero_copy_only=False) for c in (left, bottom, right, top)])
    polygons, held = edges.flatten(), corners.flatten().to_numpy(zero_copy_only=False).astype(bool)
    members = polygons.flatten()
    flat = np.column_stack([members.field(f).to_numpy(zero_copy_only=False) for f in ("x1", "y1", "x2", "y2")])
    edge_at, poly_at = (np.r_[0, np.cumsum(pc.list_value_length(c).to_numpy(zero_copy_only=False))].astype(np.int64) for c in (polygons, edges))
    owner, sizes, points = strung(*cell_outlines(flat, edge_at, poly_at, held, boxes, DIGITS))
    spots = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], ["x", "y"])
    paths = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), spots)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=len(boxes)))], pa.int32()), paths)


@F.arrow_udf(RINGS_TYPE)
def _rings_of_paths(paths: pa.Array) -> pa.Array:
    return rings_to_arrow([linked(p) for p in _nested(paths, ["x", "y"])])


def _connected(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """``id``, ``comp`` for the connected components of ``pairs`` (a, b) over ``items`` (id).

    Each round, every item joins its neighbour (or itself) of the least rank, ranks are drawn anew by a hash, and joined items become one:
    a constant part of a chain goes in every round, whatever the order of its ids.
    """
    comp, number = items.select("id", F.col("id").alias("comp")), 0
    both = stage(pairs.union(pairs.select("b", "a")).filter("a <> b").distinct())
    while not has_at_most(both, 0):
        def rank(column: str):
            return F.struct(F.xxhash64(F.col(column), F.lit(number)), F.col(column).alias("id"))

        to = stage(both.groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a"))).alias("to")).select("a", F.col("to.id").alias("to")))
        comp = stage(comp.join(to.withColumnRenamed("a", "comp"), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")))
        moved = both.join(to, "a").select(F.col("to").alias("a"), "b").join(to.select(F.col("a").alias("b"), F.col("to").alias("_to")), "b").select("a", F.col("_to").alias("b"))
        both = stage(moved.filter("a <> b").distinct())
        number += 1
    return comp


def dissolve(boundaries: DataFrame, key: str = "boundary_id", size: float = 0.25) -> DataFrame:
    """The union of each boundary's polygons (``key`` and ``rings`` or ``parts``) as its outline: ``key, ring, hole``.

    One row per ring; the union lies on its left, so shells run counter-clockwise and holes clockwise, and the signed areas add up to
    the area of the union. Polygons may overlap, touch, nest and repeat; a seam that is covered from both sides is no outline. Points are rounded to
    ``DIGITS`` decimals, points in a straight line are left out. Boundaries without geometry give no rows.
    """
    cover = cover_cells(boundaries, size, key, grow=F.lit(MARGIN))
    cells = cover.groupBy(key, "cell_i", "cell_j").agg(
        F.max(F.col("edges").isNull()).alias("whole"), F.collect_list(F.struct(F.coalesce("edges", F.array().cast(f"array<{geo.EDGE}>")).alias("edges"), "corner_inside")).alias("p")
    ).filter("NOT whole")
    step, x0, y0 = F.lit(float(size)), F.lit(float(WORLD_MIN_X)), F.lit(float(WORLD_MIN_Y))
    lines = [F.col("cell_i") * step + x0, F.col("cell_j") * step + y0, (F.col("cell_i") + 1) * step + x0, (F.col("cell_j") + 1) * step + y0]
    paths = cells.select(key, F.explode(_paths_of_cell(F.col("p.edges"), F.col("p.corner_inside"), *lines)).alias("path"))
    start, end = F.get("path", F.lit(0)), F.element_at("path", -1)
    paths = stage(paths.select(key, F.xxhash64(key, "path").alias("id"), start.alias("start"), end.alias("end"), "path"))
    open_paths = paths.filter("start <> end")
    following = open_paths.select(F.col(key).alias("_key"), F.col("start").alias("_start"), F.col("id").alias("b"))
    pairs = open_paths.join(following, F.col(key).eqNullSafe(F.col("_key")) & (F.col("end") == F.col("_start"))).select(F.col("id").alias("a"), "b")
    comps = open_paths.join(_connected(pairs, open_paths.select("id")), "id").groupBy(key, "comp").agg(F.collect_list("path").alias("paths"))
    alone = paths.filter("start = end").select(key, F.array("path").alias("paths"))
    rings = comps.select(key, "paths").unionByName(alone).select(key, F.explode(_rings_of_paths(F.col("paths"))).alias("ring"))
    return rings.withColumn("hole", geo.signed_area(F.col("ring")) < 0)
