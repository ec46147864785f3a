"""Arrow kernels for the geometry that has no sensible Catalyst form: validity, overlay and WKB.

Each is a small function of one geometry; Spark partitions and ships the rows.
"""

from __future__ import annotations

import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS_TYPE = T.ArrayType(T.ArrayType(POINT_TYPE))
CUT_TYPE = T.StructType([T.StructField("geom_type", T.StringType()), T.StructField("rings", RINGS_TYPE)])


def _nested(column: pa.ListArray, fields: list[str]) -> list[list[np.ndarray] | None]:
    """Rows of ``array<array<struct>>`` as lists of two-dimensional arrays, straight from the Arrow buffers."""
    inner = column.values
    members = inner.values
    flat = np.column_stack([members.field(f).to_numpy(zero_copy_only=False) for f in fields]) if len(members) else np.empty((0, len(fields)))
    outer_at, inner_at = column.offsets.to_numpy(), inner.offsets.to_numpy()
    missing = column.is_null().to_numpy(zero_copy_only=False)
    return [
        None if missing[row] else [flat[inner_at[k] : inner_at[k + 1]] for k in range(outer_at[row], outer_at[row + 1])]
        for row in range(len(column))
    ]


def rings_to_arrow(rows: list[list[np.ndarray] | None]) -> pa.ListArray:
    """The other way round: lists of point arrays to an Arrow ``array<array<struct<x, y>>>``."""
    rings = [ring for row in rows if row for ring in row]
    points = np.vstack(rings) if rings else np.empty((0, 2))
    members = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], ["x", "y"])
    inner = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(r) for r in rings]), pa.int32()), members)
    ends = np.cumsum([0] + [len(r) if r else 0 for r in rows])
    missing = pa.array([r is None for r in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner, mask=missing)


def _edge_array(rings: list[np.ndarray]) -> np.ndarray:
    parts = [np.hstack([r[:-1], r[1:]]) for r in rings if len(r) > 1]
    edges = np.vstack(parts) if parts else np.empty((0, 4))
    return edges[np.any(edges[:, :2] != edges[:, 2:], axis=1)]


def _cross(ax, ay, bx, by):
    return ax * by - ay * bx


def _locate(points: np.ndarray, edges: np.ndarray, tolerance: float = 0.0) -> np.ndarray:
    """1 inside, 0 on the outline, -1 outside, for each point against a closed edge set; also for stacks of both."""
    if not len(edges):
        return np.full(len(points), -1)
    px, py = points[..., :1], points[..., 1:]
    x1, y1, x2, y2 = np.moveaxis(edges, -1, 0)[..., None, :]
    dx, dy = x2 - x1, y2 - y1
    cross = dx * (py - y1) - (px - x1) * dy
    along = (px - x1) * dx + (py - y1) * dy
    length2 = dx * dx + dy * dy
    near = (np.abs(cross) <= tolerance * np.sqrt(length2)) & (along >= 0) & (along <= length2)
    crossing = ((y1 > py) != (y2 > py)) & ((cross > 0) == (y2 > y1))
    inside = crossing.sum(axis=-1) % 2 == 1
    return np.where(near.any(axis=-1), 0, np.where(inside, 1, -1))


# --- validity -------------------------------------------------------------------------------------------------

# Polygons with up to this many edges are tested in whole batches, all pairs of edges at once.
SMALL_EDGES = 40
PAIRS_AT_ONCE = 1_000_000


def _conflict(a: np.ndarray, b: np.ndarray, may_touch: np.ndarray) -> np.ndarray:
    """Whether edges cross, overlap, or touch where they must not (pairwise, last axis x1 y1 x2 y2)."""
    ax, ay, bx, by = np.moveaxis(a, -1, 0)
    cx, cy, dx, dy = np.moveaxis(b, -1, 0)
    s1 = np.sign(_cross(bx - ax, by - ay, cx - ax, cy - ay))
    s2 = np.sign(_cross(bx - ax, by - ay, dx - ax, dy - ay))
    s3 = np.sign(_cross(dx - cx, dy - cy, ax - cx, ay - cy))
    s4 = np.sign(_cross(dx - cx, dy - cy, bx - cx, by - cy))
    flat = (s1 == 0) & (s2 == 0)
    meet = (s1 * s2 <= 0) & (s3 * s4 <= 0) & ~flat
    crossing = (s1 * s2 < 0) & (s3 * s4 < 0)

    def shared(p1, p2, q1, q2):
        return np.minimum(np.maximum(p1, p2), np.maximum(q1, q2)) - np.maximum(np.minimum(p1, p2), np.minimum(q1, q2))

    wide = np.abs(bx - ax) >= np.abs(by - ay)
    overlap = np.where(wide, shared(ax, bx, cx, dx), shared(ay, by, cy, dy))
    across = np.where(wide, shared(ay, by, cy, dy), shared(ax, bx, cx, dx))
    laid_on = flat & (overlap > 0) & (across >= 0)
    end_to_end = flat & (overlap == 0) & (across >= 0)
    return crossing | laid_on | ((meet | end_to_end) & ~may_touch)


def _may_touch(ring_a, ring_b, rank_a, rank_b, size):
    """Edges of different rings may touch in points, edges of one ring only at the joint of neighbours."""
    gap = np.abs(rank_a - rank_b)
    return (ring_a != ring_b) | (gap == 1) | (gap == size - 1)


def _edges_conflict(edges: np.ndarray, ring_of: np.ndarray, rank: np.ndarray, size_of: np.ndarray) -> bool:
    """The same test for one polygon with many edges, sweeping along x."""
    order = np.argsort(np.minimum(edges[:, 0], edges[:, 2]), kind="stable")
    edges, ring_of, rank, size_of = edges[order], ring_of[order], rank[order], size_of[order]
    left, right = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    for k in range(len(edges)):
        others = np.arange(k + 1, np.searchsorted(left, right[k], side="right"))
        others = others[(low[others] <= high[k]) & (high[others] >= low[k])]
        allowed = _may_touch(ring_of[k], ring_of[others], rank[k], rank[others], size_of[k])
        if len(others) and _conflict(np.broadcast_to(edges[k], (len(others), 4)), edges[others], allowed).any():
            return True
    return False


def _polygon_edges(rings: list[np.ndarray] | None):
    """(edges, ring number, place in the ring, edges of the ring), None when a ring is not closed or too short."""
    if not rings:
        return None
    edges, ring_of, rank, size_of = [], [], [], []
    for number, ring in enumerate(rings):
        if len(ring) < 4 or not np.isfinite(ring).all() or (ring[0] != ring[-1]).any():
            return None
        ring = ring[np.r_[True, (ring[1:] != ring[:-1]).any(axis=1)]]
        if len(ring) < 4:
            return None
        n = len(ring) - 1
        edges.append(np.hstack([ring[:-1], ring[1:]]))
        ring_of.append(np.full(n, number))
        rank.append(np.arange(n))
        size_of.append(np.full(n, n))
    return np.vstack(edges), np.concatenate(ring_of), np.concatenate(rank), np.concatenate(size_of)


def valid_polygons(rows: list[list[np.ndarray] | None]) -> np.ndarray:
    """Closed rings of four points or more, no crossing or overlap, no repeated passage through a place within a
    ring, rings meeting in single points only. Nesting is free, as rings carry no shell or hole role."""
    valid = np.zeros(len(rows), bool)
    by_size = defaultdict(list)
    for number, rings in enumerate(rows):
        made = _polygon_edges(rings)
        if made is not None:
            by_size[len(made[0])].append((number, *made))
    for count, group in by_size.items():
        if count > SMALL_EDGES:
            for number, *parts in group:
                valid[number] = not _edges_conflict(*parts)
            continue
        i, j = np.triu_indices(count, 1)
        step = max(1, PAIRS_AT_ONCE // len(i))
        for start in range(0, len(group), step):
            numbers, edges, ring_of, rank, size_of = (np.array(column) for column in zip(*group[start : start + step]))
            allowed = _may_touch(ring_of[:, i], ring_of[:, j], rank[:, i], rank[:, j], size_of[:, i])
            valid[numbers] = ~_conflict(edges[:, i], edges[:, j], allowed).any(axis=1)
    return valid


def _ring_members(rings: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Points of all rings of ``array<array<struct<x, y>>>`` and where each ring starts."""
    members = rings.values.values
    points = np.column_stack([members.field(f).to_numpy(zero_copy_only=False) for f in ("x", "y")]) if len(members) else np.empty((0, 2))
    return points, rings.values.offsets.to_numpy()


def layout_edges(points: np.ndarray, at: int, size: int) -> np.ndarray:
    """Edges of the ring of ``size`` points from place ``at`` on, for a stack of polygons."""
    return np.concatenate([points[:, at : at + size - 1], points[:, at + 1 : at + size]], axis=2)


def valid_layout(points: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``valid_polygons`` for a stack of polygons with the same sizes of rings, and which of them repeat a point in a row and have to be taken one by one."""
    valid, repeated = np.isfinite(points).all(axis=(1, 2)), np.zeros(len(points), bool)
    edges, ring_of, rank, size_of, at = [], [], [], [], 0
    for number, size in enumerate(sizes):
        e = layout_edges(points, at, size)
        valid &= (points[:, at] == points[:, at + size - 1]).all(axis=1)
        repeated |= (e[..., :2] == e[..., 2:]).all(axis=2).any(axis=1)
        edges.append(e)
        ring_of.append(np.full(size - 1, number))
        rank.append(np.arange(size - 1))
        size_of.append(np.full(size - 1, size - 1))
        at += size
    # edge by edge with the polygons side by side, so that every step runs along them
    edges = np.ascontiguousarray(np.moveaxis(np.concatenate(edges, axis=1), 0, -1))
    ring_of, rank, size_of = (np.concatenate(c) for c in (ring_of, rank, size_of))
    i, j = np.triu_indices(len(edges), 1)
    allowed = _may_touch(ring_of[i], ring_of[j], rank[i], rank[j], size_of[i])[:, None]
    asked = np.flatnonzero(valid & ~repeated)
    step = max(1, PAIRS_AT_ONCE // len(i))
    for start in range(0, len(asked), step):
        some = asked[start : start + step]
        stack = np.moveaxis(edges[:, :, some], 1, -1)
        valid[some] = ~_conflict(stack[i], stack[j], allowed).any(axis=0)
    return valid, repeated & valid


def same_sizes(rows: np.ndarray, row_at: np.ndarray, sizes: np.ndarray, n_rings: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``n_rings`` rings in groups whose rings have the same numbers of points, with those numbers."""
    own = sizes[row_at[rows][:, None] + np.arange(n_rings)]
    order = np.lexsort(own.T)
    rows, own = rows[order], own[order]
    cuts = np.flatnonzero((own[1:] != own[:-1]).any(axis=1)) + 1
    return list(zip(np.split(rows, cuts), own[np.r_[0, cuts]]))


def valid_rings(rings: pa.ListArray) -> np.ndarray:
    """``valid_polygons`` of an Arrow column: small polygons of the same sizes of rings are judged as one stack."""
    points, ring_at = _ring_members(rings)
    row_at, sizes = rings.offsets.to_numpy(), np.diff(ring_at)
    count = np.where(rings.is_null().to_numpy(zero_copy_only=False), 0, np.diff(row_at))
    most = SMALL_EDGES // 3  # more rings than that have too many edges for a stack
    valid, alone = np.zeros(len(rings), bool), np.flatnonzero(count > most).tolist()
    for n_rings in np.unique(count[(count > 0) & (count <= most)]):
        for rows, own in same_sizes(np.flatnonzero(count == n_rings), row_at, sizes, n_rings):
            if own.min() < 4:
                continue
            if own.sum() - len(own) > SMALL_EDGES:
                alone += rows.tolist()
                continue
            valid[rows], repeated = valid_layout(points[ring_at[row_at[rows]][:, None] + np.arange(own.sum())], own.tolist())
            alone += rows[repeated].tolist()
    if alone:
        valid[alone] = valid_polygons(_nested(rings.take(pa.array(alone)), ["x", "y"]))
    return valid


@F.arrow_udf(T.BooleanType())
def is_valid(rings: pa.Array) -> pa.Array:
    return pa.array(valid_rings(rings), pa.bool_())


# --- overlay --------------------------------------------------------------------------------------------------

def _meeting(edge: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Where ``edge`` meets each of ``others`` in one point; NaN where it does not.

    A pair is always computed from the smaller of its two edges, both taken from their smaller end, so the point is the
    same to the last bit whichever of the two is cut. A meeting at an end is that end itself.
    """
    mine = np.broadcast_to(edge, others.shape)
    turned = [np.where(_after(e)[:, None], e[:, [2, 3, 0, 1]], e) for e in (mine, others)]
    swap = _larger(turned[0], turned[1])[:, None]
    a, b = np.where(swap, turned[1], turned[0]), np.where(swap, turned[0], turned[1])
    dx, dy, ex, ey = a[:, 2] - a[:, 0], a[:, 3] - a[:, 1], b[:, 2] - b[:, 0], b[:, 3] - b[:, 1]
    det, ox, oy = _cross(dx, dy, ex, ey), b[:, 0] - a[:, 0], b[:, 1] - a[:, 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = _cross(ox, oy, ex, ey) / det, _cross(ox, oy, dx, dy) / det
        points = np.column_stack([a[:, 0] + t * dx, a[:, 1] + t * dy])
        for at, ends in ((t == 0, a[:, :2]), (t == 1, a[:, 2:]), (u == 0, b[:, :2]), (u == 1, b[:, 2:])):
            points = np.where(at[:, None], ends, points)
        meets = (det != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    return np.where(meets[:, None], points, np.nan)


def _larger(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each row of ``a`` comes after that of ``b`` in the order of its numbers."""
    differs = a != b
    first = differs.argmax(axis=1)
    row = np.arange(len(a))
    return differs.any(axis=1) & (a[row, first] > b[row, first])


def _after(edges: np.ndarray) -> np.ndarray:
    return _larger(edges[:, :2], edges[:, 2:])


def _cut_points(edges: np.ndarray, others: np.ndarray) -> list[np.ndarray]:
    """For each edge its pieces' end points: own ends plus every meeting point with ``others``."""
    result = []
    for edge in edges:
        start, end = edge[:2], edge[2:]
        d = end - start
        found = [start[None], end[None]]
        if len(others):
            points = _meeting(edge, others)
            found.append(points[~np.isnan(points[:, 0])])
            ex, ey = others[:, 2] - others[:, 0], others[:, 3] - others[:, 1]
            ox, oy = others[:, 0] - start[0], others[:, 1] - start[1]
            flat = (_cross(d[0], d[1], ex, ey) == 0) & (_cross(ox, oy, d[0], d[1]) == 0)
            found += [others[flat, :2], others[flat, 2:]]
        points = np.vstack(found)
        along = ((points - start) @ d) / (d @ d)
        inside = (along > 0) & (along < 1)
        inside[:2] = True
        points, along = points[inside], along[inside]
        along[:2] = (0.0, 1.0)
        result.append(points[np.argsort(along, kind="stable")])
    return result


def _pieces(edges: np.ndarray, others: np.ndarray, digits: int) -> np.ndarray:
    chains = _cut_points(edges, others)
    parts = [np.hstack([c[:-1], c[1:]]) for c in chains]
    pieces = np.round(np.vstack(parts), digits) if parts else np.empty((0, 4))
    return pieces[np.any(pieces[:, :2] != pieces[:, 2:], axis=1)]


class OpenRing(ValueError):
    """The pieces of an outline do not close."""


def _link(pieces: np.ndarray) -> list[list[tuple[float, float]]]:
    """Join undirected pieces to closed rings; every node has an even number of pieces, else ``OpenRing``."""
    at = defaultdict(list)
    for number, (x1, y1, x2, y2) in enumerate(pieces):
        at[(x1, y1)].append((number, (x2, y2)))
        at[(x2, y2)].append((number, (x1, y1)))
    used, rings = set(), []
    for number, (x1, y1, x2, y2) in enumerate(pieces):
        if number in used:
            continue
        used.add(number)
        ring, here = [(x1, y1), (x2, y2)], (x2, y2)
        while here != ring[0]:
            step = next(((n, p) for n, p in at[here] if n not in used), None)
            if step is None:
                raise OpenRing(f"an outline ends at {here}")
            used.add(step[0])
            here = step[1]
            ring.append(here)
        if len(ring) >= 4:
            rings.append(ring)
    return rings


def overlay(rings: list[np.ndarray], masks: list[np.ndarray], digits: int | None = None, spans: list[np.ndarray] | None = None) -> tuple[str, list[np.ndarray]] | None:
    """Common part of a polygon and the union of edge-set polygons; NULL when they do not meet.

    Points are rounded to ``digits`` decimals, by default 15 significant digits of the largest coordinate less two, so
    that meetings that fall into one place do so for both outlines. Where an outline still does not close, the polygon
    is taken again two and four digits coarser; if that fails too it is an error, never a loss.
    """
    if digits is None:
        digits = 13 - int(np.ceil(np.log10(max(1.0, max(np.abs(r).max() for r in rings)))))
    for coarser in (0, 2):
        try:
            return _overlay(rings, masks, digits - coarser, spans)
        except OpenRing:
            pass
    return _overlay(rings, masks, digits - 4, spans)


def _overlay(rings: list[np.ndarray], masks: list[np.ndarray], digits: int, spans: list[np.ndarray] | None) -> tuple[str, list[np.ndarray]] | None:
    """``overlay`` at one precision.

    Kept outline: pieces of the polygon inside the mask, and pieces of a mask part inside the polygon but in no
    other part. Pieces on both outlines count once, when both interiors lie on the same side.
    """
    shape = _edge_array(rings)
    masks = [m[np.any(m[:, :2] != m[:, 2:], axis=1)] for m in masks]
    numbers = list(range(len(masks)))
    low, high = shape[:, :2].min(axis=0), shape[:, :2].max(axis=0)
    near = [
        m[(np.minimum(m[:, 0], m[:, 2]) <= high[0]) & (np.maximum(m[:, 0], m[:, 2]) >= low[0])
          & (np.minimum(m[:, 1], m[:, 3]) <= high[1]) & (np.maximum(m[:, 1], m[:, 3]) >= low[1])]
        for m in masks
    ]
    all_near = np.vstack(near) if near else np.empty((0, 4))
    tolerance = 10.0 ** (1 - digits)

    def middle(p: np.ndarray) -> np.ndarray:
        return (p[:, :2] + p[:, 2:]) / 2

    def beside(p: np.ndarray) -> np.ndarray:
        d = p[:, 2:] - p[:, :2]
        normal = np.column_stack([-d[:, 1], d[:, 0]]) / np.hypot(d[:, 0], d[:, 1])[:, None]
        return middle(p) + normal * np.minimum(np.hypot(d[:, 0], d[:, 1]) / 1000, 10.0 ** (3 - digits))[:, None]

    def in_part(points: np.ndarray, part: int, slack: float = 0.0) -> np.ndarray:
        where = _locate(points, masks[part], slack)
        if spans is not None:
            y = points[:, 1:]
            where[~((y >= spans[part][:, 0]) & (y <= spans[part][:, 1])).any(axis=1)] = -1
        return where

    def in_mask(points: np.ndarray) -> np.ndarray:
        where = [in_part(points, k, tolerance) for k in numbers]
        return np.max(where, axis=0) if where else np.full(len(points), -1)

    own = _pieces(shape, all_near, digits)
    where = in_mask(middle(own))
    kept = [own[where == 1]]
    edge = own[where == 0]
    if len(edge):
        outer = np.array([in_part(beside(edge), k) for k in numbers]).max(axis=0)
        same_side = (_locate(beside(edge), shape) == 1) == (outer == 1)
        # a piece on a seam between two parts lies inside the union although it is on an outline of each
        other_side = np.hstack([edge[:, 2:], edge[:, :2]])
        both = (outer == 1) & (np.array([in_part(beside(other_side), k) for k in numbers]).max(axis=0) == 1)
        kept.append(edge[same_side | both])
        contact = edge[~(same_side | both)]
    else:
        contact = edge
    for number, mask in enumerate(near):
        pieces = _pieces(mask, np.vstack([shape, all_near]), digits)
        if not len(pieces):
            continue
        pieces = pieces[_locate(middle(pieces), shape, tolerance) == 1]
        if not len(pieces):
            continue
        others = [k for k in numbers if k != number]
        if others:
            spots = np.array([in_part(middle(pieces), k, tolerance) for k in others])
            covered = (spots == 1).any(axis=0)
            # on a seam the union has no outline unless both parts lie on the same side; then the first keeps it
            seam = (spots == 0).any(axis=0) & ~covered
            left = np.array([in_part(beside(pieces), k) for k in numbers])
            flipped = np.hstack([pieces[:, 2:], pieces[:, :2]])
            right = np.array([in_part(beside(flipped), k) for k in numbers])
            inner_seam = seam & ((left == 1).any(axis=0) & (right == 1).any(axis=0))
            doubled = seam & ~inner_seam & np.array(
                [any(k < number and spot[i] == 0 for k, spot in zip(others, spots))
                 for i in range(len(pieces))]
            )
            pieces = pieces[~(covered | inner_seam | doubled)]
        kept.append(pieces)
    outline = np.vstack(kept)
    if len(outline):
        swapped = (outline[:, 0] > outline[:, 2]) | ((outline[:, 0] == outline[:, 2]) & (outline[:, 1] > outline[:, 3]))
        directed = np.where(swapped[:, None], outline[:, [2, 3, 0, 1]], outline)
        rings_out = _link(np.unique(directed, axis=0))
        if rings_out:
            return "POLYGON", [np.array(r) for r in rings_out]
    if len(contact):
        return "LINESTRING", [line.reshape(2, 2) for line in contact]
    spots = np.unique(np.vstack([own[:, :2], own[:, 2:]]), axis=0)
    spots = spots[in_mask(spots) >= 0]
    if len(spots):
        return "POINT", [spot.reshape(1, 2) for spot in spots]
    return None


@F.arrow_udf(CUT_TYPE)
def common_part(rings: pa.Array, parts: pa.Array, spans: pa.Array) -> pa.Array:
    """``rings`` cut to the union of the mask ``parts`` (each an array of edges); NULL members without contact.

    ``spans``: per part the ranges of y (low, high) in which its edges are complete.
    """
    shapes, masks, ranges = _nested(rings, ["x", "y"]), _nested(parts, ["x1", "y1", "x2", "y2"]), _nested(spans, ["low", "high"])
    cuts = [(s is not None and overlay(s, m, spans=r)) or (None, None) for s, m, r in zip(shapes, masks, ranges)]
    kinds = pa.array([kind for kind, _ in cuts], pa.string())
    return pa.StructArray.from_arrays([kinds, rings_to_arrow([r for _, r in cuts])], ["geom_type", "rings"])


# --- binary form ----------------------------------------------------------------------------------------------

def polygon_wkb(rings: list[np.ndarray] | None) -> bytes | None:
    if rings is None:
        return None
    head = struct.pack("<BII", 1, 3, len(rings))
    return head + b"".join(struct.pack("<I", len(r)) + (r + 0.0).astype("<f8").tobytes() for r in rings)


@F.arrow_udf(T.BinaryType())
def as_wkb(rings: pa.Array) -> pa.Array:
    """Well-known binary of a polygon, little-endian, -0.0 written as 0.0."""
    return pa.array([polygon_wkb(r) for r in _nested(rings, ["x", "y"])], pa.binary())


def polygon_from_wkb(data: bytes | None) -> list[np.ndarray] | None:
    """Rings of a WKB Polygon or MultiPolygon (parts flattened), either byte order, two dimensions."""
    if data is None:
        return None

    def read(at: int) -> tuple[list[np.ndarray], int]:
        order = "<" if data[at] == 1 else ">"
        kind, count = struct.unpack_from(order + "II", data, at + 1)
        at += 9
        found = []
        for _ in range(count):
            if kind == 6:
                inner, at = read(at)
                found += inner
            else:
                (n,) = struct.unpack_from(order + "I", data, at)
                found.append(np.frombuffer(data, order + "f8", 2 * n, at + 4).reshape(-1, 2).astype(float))
                at += 4 + 16 * n
        return found, at

    return read(0)[0]


@F.arrow_udf(RINGS_TYPE)
def from_wkb(data: pa.Array) -> pa.Array:
    return rings_to_arrow([polygon_from_wkb(d.as_py()) for d in data])
