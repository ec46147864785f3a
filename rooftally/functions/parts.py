"""Multi-part geometry with hole roles: a ``parts`` column next to ``rings``.

``parts`` is ``ARRAY<rings>``: every part is a polygon, its shell first, then its holes. A point belongs to the geometry when a part
covers it, so parts that overlap do not cancel each other as they would as rings of one polygon. ``flat`` gives the ``rings`` that the
other functions take; operators on boundaries take a part at a time (``polygon_rows``).

Readers and printers are Catalyst expressions for WKT and GeoJSON and Arrow kernels for WKB, shapefile rings and validity.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rooftally.functions import geometry as geo
from rooftally.functions.kernels import RINGS_TYPE, SMALL_EDGES, _locate, _ring_members, layout_edges, polygon_wkb, rings_to_arrow, same_sizes, valid_layout, valid_polygons
from rooftally.functions.kernels import _nested as _nested_rings

PARTS = f"array<{geo.RINGS}>"
PARTS_TYPE = T.ArrayType(RINGS_TYPE)

Rings = list[np.ndarray]


def flat(parts: Column) -> Column:
    """All rings of all parts."""
    return F.flatten(parts)


def single(rings: Column) -> Column:
    """One polygon as its only part; NULL stays NULL."""
    return F.when(rings.isNotNull(), F.array(rings))


def polygon_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per part, as ``rings``; a frame without ``parts`` stays as it is. ``keep`` names the other columns to carry."""
    if "parts" not in df.columns:
        return df
    others = keep if keep is not None else [c for c in df.columns if c not in ("parts", "rings")]
    return df.select(*others, F.explode("parts").alias("rings"))


def cover_point(parts: Column, x: Column, y: Column) -> Column:
    """Closed test: a part covers the point, its outline included."""
    return F.exists(parts, lambda rings: geo.rings_cover_point(rings, x, y))


# --- text -----------------------------------------------------------------------------------------------------

def number_text(value: Column) -> Column:
    """A coordinate that reads back to the same value, without exponent where it has 20 decimals at most."""
    text = value.cast("string")
    return F.when(text.contains("E") & (F.abs(value) < 1e17), geo.plain_number(value)).otherwise(text)


def _rings_text(rings: Column) -> Column:
    def ring(points: Column) -> Column:
        pairs = F.transform(points, lambda p: F.concat_ws(" ", number_text(p["x"]), number_text(p["y"])))
        return F.concat(F.lit("("), F.array_join(pairs, ","), F.lit(")"))

    return F.concat(F.lit("("), F.array_join(F.transform(rings, ring), ","), F.lit(")"))


def as_wkt(parts: Column) -> Column:
    """POLYGON for one part, MULTIPOLYGON for several, POLYGON EMPTY for none."""
    many = F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(parts, _rings_text), ","), F.lit(")"))
    return F.when(F.size(parts) == 0, "POLYGON EMPTY").when(F.size(parts) == 1, F.concat(F.lit("POLYGON"), _rings_text(F.get(parts, F.lit(0))))).otherwise(many)


def from_wkt(wkt: Column) -> Column:
    """Parts of a POLYGON or MULTIPOLYGON text, with or without ``SRID=...;``; further dimensions are left out, other kinds give NULL."""
    text = F.trim(F.regexp_replace(wkt, r"(?i)^\s*(srid=\d+;)?\s*", ""))
    kind = F.upper(F.regexp_extract(text, r"^([A-Za-z]+)", 1))
    body = F.regexp_replace(F.regexp_replace(text, r"(?i)^[a-z]+(\s+(zm|z|m))?\s*", ""), r"\s+", " ")
    polygons = F.split(F.regexp_replace(body, r"^\( ?\( ?\(|\) ?\) ?\)$", ""), r"\) ?\) ?, ?\( ?\(")
    one = F.array(F.regexp_replace(body, r"^\( ?\(|\) ?\)$", ""))

    def pair(token: Column) -> Column:
        numbers = F.split(F.trim(token), " ")
        return geo.point(F.get(numbers, F.lit(0)).cast("double"), F.get(numbers, F.lit(1)).cast("double"))

    def polygon(text: Column) -> Column:
        return F.transform(F.split(text, r"\) ?, ?\("), lambda ring: F.transform(F.split(ring, ","), pair))

    empty = F.array().cast(PARTS)
    return (
        F.when(kind.isin("POLYGON", "MULTIPOLYGON") & F.upper(body).startswith("EMPTY"), empty)
        .when(kind == "POLYGON", F.transform(one, polygon))
        .when(kind == "MULTIPOLYGON", F.transform(polygons, polygon))
    )


def as_geojson(parts: Column) -> Column:
    """GeoJSON Polygon for one part, else MultiPolygon."""
    coordinates = F.transform(parts, lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"]))))
    one = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.get(coordinates, F.lit(0)).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")))
    return F.when(F.size(parts) == 1, one).otherwise(many)


def from_geojson(kind: Column, coordinates: Column) -> Column:
    """Parts from a geometry's type and the text of its coordinates; NULL for other kinds than polygons."""
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    polygons = F.when(kind == "Polygon", F.array(one)).when(kind == "MultiPolygon", many)
    return F.transform(polygons, lambda rings: F.transform(rings, lambda ring: F.transform(ring, lambda p: geo.point(F.get(p, F.lit(0)), F.get(p, F.lit(1))))))


# --- kernels --------------------------------------------------------------------------------------------------

def _nested(column: pa.ListArray) -> list[list[Rings] | None]:
    polygons = _nested_rings(column.values, ["x", "y"])
    at, missing = column.offsets.to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
    return [None if missing[row] else [p or [] for p in polygons[at[row] : at[row + 1]]] for row in range(len(column))]


def parts_to_arrow(rows: list[list[Rings] | None]) -> pa.ListArray:
    polygons = rings_to_arrow([p for row in rows if row for p in row])
    ends = np.cumsum([0] + [len(r) if r else 0 for r in rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), polygons, mask=pa.array([r is None for r in rows], pa.bool_()))


def to_wkb(parts: list[Rings] | None) -> bytes | None:
    if parts is None:
        return None
    if len(parts) == 1:
        return polygon_wkb(parts[0])
    return struct.pack("<BII", 1, 6, len(parts)) + b"".join(polygon_wkb(p) for p in parts)


def wkb_parts(data: bytes | None) -> list[Rings] | None:
    """Parts of a Polygon, MultiPolygon or collection of them in WKB or EWKB, either byte order; only x and y are kept.

    Other kinds have no parts; a text that ends early is an error.
    """
    if data is None:
        return None

    def read(at: int) -> tuple[list[Rings], int]:
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 9 if code & 0x20000000 else 5  # a reference system may follow
        kind = (code & 0xFFFF) % 1000
        width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000) + {0: 0, 1: 1, 2: 1, 3: 2}[(code & 0xFFFF) // 1000]
        if kind == 1:
            return [], at + 8 * width
        (count,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            return [], at + 8 * width * count
        found: list[Rings] = []
        if kind == 3:
            rings = []
            for _ in range(count):
                (n,) = struct.unpack_from(order + "I", data, at)
                rings.append(np.frombuffer(data, order + "f8", width * n, at + 4).reshape(-1, width)[:, :2].astype(float))
                at += 4 + 8 * width * n
            return ([rings] if rings else []), at
        for _ in range(count):
            inner, at = read(at)
            found += inner
        return found, at

    return read(0)[0]


@F.arrow_udf(T.BinaryType())
def as_wkb(parts: pa.Array) -> pa.Array:
    """Well-known binary, little-endian: a Polygon for one part, else a MultiPolygon; -0.0 written as 0.0."""
    return pa.array([to_wkb(p) for p in _nested(parts)], pa.binary())


@F.arrow_udf(PARTS_TYPE)
def from_wkb(data: pa.Array) -> pa.Array:
    return parts_to_arrow([wkb_parts(d.as_py()) for d in data])


def _clockwise(ring: np.ndarray) -> bool:
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) < 0


def _inside(ring: np.ndarray, other: np.ndarray) -> bool:
    """Whether ``ring`` lies in ``other``: its box does, and its first corner or middle that is not on the other's outline."""
    edges = np.hstack([other[:-1], other[1:]])
    low, high = other.min(axis=0), other.max(axis=0)
    if (ring < low).any() or (ring > high).any():
        return False
    for at in range(0, len(ring) - 1, 16):
        some = ring[at : at + 17]
        spots = np.vstack([some, (some[:-1] + some[1:]) / 2])
        near = edges[(np.minimum(edges[:, 1], edges[:, 3]) <= spots[:, 1].max()) & (np.maximum(edges[:, 1], edges[:, 3]) >= spots[:, 1].min())]
        where = _locate(spots, near)
        told = where[where != 0]
        if len(told):
            return bool(told[0] > 0)
    return False


def _boxes(rings: Rings) -> np.ndarray:
    return np.array([[*r.min(axis=0), *r.max(axis=0)] for r in rings])


def shells_with_holes(rings: Rings | None) -> list[Rings] | None:
    """Parts of a shapefile record: clockwise rings are shells, the others holes of the smallest shell around them.

    A hole that no shell holds is a shell of its own, as writers that mind no direction mean it.
    """
    if rings is None:
        return None
    rings = [r for r in rings if len(r)]
    if len(rings) < 2:
        return [rings] if rings else []
    shells = [r for r in rings if _clockwise(r)]
    holes = [r for r in rings if not _clockwise(r)]
    if not shells:
        shells, holes = holes, []
    parts, boxes = [[s] for s in shells], _boxes(shells)
    areas = (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    for hole in holes:
        low, high = hole.min(axis=0), hole.max(axis=0)
        around = np.flatnonzero((boxes[:, :2] <= low).all(axis=1) & (boxes[:, 2:] >= high).all(axis=1))
        owner = next((k for k in around[np.argsort(areas[around], kind="stable")] if _inside(hole, shells[k])), None)
        if owner is None:
            parts.append([hole])
        else:
            parts[owner].append(hole)
    return parts


# --- validity -------------------------------------------------------------------------------------------------

def _touches_in_a_loop(part: Rings) -> bool:
    """Whether rings of a part meet in points so that its interior falls apart: a loop in the graph of rings and meeting points."""
    corners: dict[tuple[float, float], set[int]] = {}
    for number, ring in enumerate(part):
        for x, y in ring[:-1]:
            corners.setdefault((x, y), set()).add(number)
    boxes = _boxes(part)
    # a corner may also lie on an edge of another ring
    for number, ring in enumerate(part):
        edges = np.hstack([ring[:-1], ring[1:]])
        near = (boxes[:, 0] <= boxes[number, 2]) & (boxes[:, 2] >= boxes[number, 0]) & (boxes[:, 1] <= boxes[number, 3]) & (boxes[:, 3] >= boxes[number, 1])
        for other in np.flatnonzero(near):
            if other == number:
                continue
            spots = part[other][:-1]
            spots = spots[((spots >= boxes[number, :2]) & (spots <= boxes[number, 2:])).all(axis=1)]
            for x, y in spots[_locate(spots, edges) == 0] if len(spots) else ():
                corners[(x, y)].add(number)
    owner = list(range(len(part)))

    def top(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    for met in corners.values():
        first, *others = met
        for other in others:
            a, b = top(first), top(other)
            if a == b:
                return True
            owner[a] = b
    return False


def well_nested(parts: list[Rings]) -> bool:
    """For rings that do not cross: holes lie in their shell and in no other hole, no interior lies in another's, each is in one piece."""
    shells = [p[0] for p in parts]
    for part in parts:
        shell, *holes = part
        boxes = _boxes(part)
        for k, hole in enumerate(holes, 1):
            if not _inside(hole, shell):
                return False
            around = np.flatnonzero((boxes[1:, :2] <= boxes[k, :2]).all(axis=1) & (boxes[1:, 2:] >= boxes[k, 2:]).all(axis=1)) + 1
            if any(o != k and _inside(hole, part[o]) for o in around):
                return False
        if len(part) > 1 and _touches_in_a_loop(part):
            return False
    if len(parts) > 1:
        boxes = _boxes(shells)
        for k, shell in enumerate(shells):
            around = np.flatnonzero((boxes[:, :2] <= boxes[k, :2]).all(axis=1) & (boxes[:, 2:] >= boxes[k, 2:]).all(axis=1))
            for o in around:
                # a part may lie in another's shell only within one of its holes
                if o != k and _inside(shell, shells[o]) and not any(_inside(shell, hole) for hole in parts[o][1:]):
                    return False
    return True


def valid_parts(rows: list[list[Rings] | None]) -> np.ndarray:
    """Rings that are closed and neither cross nor share a stretch (rings may meet in points), and are nested as their roles say."""
    valid = valid_polygons([r and [ring for part in r for ring in part] for r in rows])
    for at in np.flatnonzero(valid):
        if any(not part for part in rows[at]) or (sum(map(len, rows[at])) > 1 and not well_nested(rows[at])):
            valid[at] = False
    return valid


def nested_layout(points: np.ndarray, layout: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """``well_nested`` for a stack of geometries with the same sizes of rings in their parts, and which of them have to be taken one by one."""
    sizes = [size for part in layout for size in part]
    starts = np.cumsum([0, *sizes])
    edges = [layout_edges(points, at, size) for at, size in zip(starts, sizes)]
    low, high = ([f(points[:, at : at + size], axis=1) for at, size in zip(starts, sizes)] for f in (np.min, np.max))

    def held(a: int, b: int) -> np.ndarray:
        """Whether ring ``a`` lies in ring ``b`` and its box in the other's, as ``_inside`` tells it."""
        found = (low[b] <= low[a]).all(axis=1) & (high[b] >= high[a]).all(axis=1)
        rows = np.flatnonzero(found)
        if len(rows):
            spots = []
            for at in range(0, sizes[a] - 1, 16):
                some = points[rows, starts[a] + at : starts[a] + min(at + 17, sizes[a])]
                spots += [some, (some[:, :-1] + some[:, 1:]) / 2]
            where = _locate(np.concatenate(spots, axis=1), edges[b][rows])
            first = (where != 0).argmax(axis=1)
            found[rows] = where[np.arange(len(rows)), first] > 0
        return found

    def on(a: int, b: int) -> np.ndarray:
        """Which corners of ring ``a`` lie on ring ``b``."""
        return _locate(edges[a][..., :2], edges[b]) == 0

    good, unsure, shells, first = np.ones(len(points), bool), np.zeros(len(points), bool), [], 0
    for part in layout:
        shell, holes = first, range(first + 1, first + len(part))
        shells.append((shell, holes))
        first += len(part)
        for hole in holes:
            good &= held(hole, shell)
            for other in holes:
                if other != hole:
                    good &= ~held(hole, other)
        if len(part) == 2:
            # two rings fall into a loop where they meet in two places or more
            hole = shell + 1
            both = (edges[hole][:, :, None, :2] == edges[shell][:, None, :, :2]).all(axis=3).any(axis=2)
            good &= on(shell, hole).sum(axis=1) + (on(hole, shell) & ~both).sum(axis=1) < 2
        for a in [shell, *holes] if len(part) > 2 else ():
            for b in [shell, *holes]:
                if a != b:
                    unsure |= on(a, b).any(axis=1)
    for shell, _ in shells:
        for other, holes in shells:
            if shell != other:
                within = held(shell, other)
                for hole in holes:
                    within &= ~held(shell, hole)
                good &= ~within
    return good, unsure & good


def valid_parts_column(parts: pa.ListArray) -> np.ndarray:
    """``valid_parts`` of an Arrow column: small geometries of the same sizes of rings in their parts are judged as one stack."""
    points, ring_at = _ring_members(parts.values)
    row_at, part_at, sizes = parts.offsets.to_numpy(), parts.values.offsets.to_numpy(), np.diff(ring_at)
    counts = np.diff(part_at)
    n_parts = np.where(parts.is_null().to_numpy(zero_copy_only=False), 0, np.diff(row_at))
    most = SMALL_EDGES // 3  # more rings than that have too many edges for a stack
    valid, layouts = np.zeros(len(parts), bool), []
    alone = [row for row in np.flatnonzero(n_parts > most) if counts[row_at[row] : row_at[row + 1]].min() > 0]
    for n in np.unique(n_parts[(n_parts > 0) & (n_parts <= most)]):
        for rows, per_part in same_sizes(np.flatnonzero(n_parts == n), row_at, counts, n):
            if per_part.min() < 1:
                continue
            if per_part.sum() > most:
                alone += rows.tolist()
                continue
            layouts += [(*alike, per_part) for alike in same_sizes(rows, part_at[row_at], sizes, per_part.sum())]
    for rows, own, per_part in layouts:
        if own.min() < 4:
            continue
        if own.sum() - len(own) > SMALL_EDGES:
            alone += rows.tolist()
            continue
        stack = points[ring_at[part_at[row_at[rows]]][:, None] + np.arange(own.sum())]
        good, repeated = valid_layout(stack, own.tolist())
        asked = np.flatnonzero(good & ~repeated)
        if len(own) > 1 and len(asked):
            layout = [p.tolist() for p in np.split(own, np.cumsum(per_part)[:-1])]
            good[asked], unsure = nested_layout(stack[asked], layout)
            repeated[asked] = unsure
        valid[rows] = good
        alone += rows[repeated].tolist()
    if alone:
        valid[alone] = valid_parts(_nested(parts.take(pa.array(alone))))
    return valid


@F.arrow_udf(T.BooleanType())
def is_valid(parts: pa.Array) -> pa.Array:
    return pa.array(valid_parts_column(parts), pa.bool_())
