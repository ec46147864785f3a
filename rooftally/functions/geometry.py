"""Geometry on ``rings`` columns, written as Catalyst expressions.

A geometry is ``rings ARRAY<ARRAY<STRUCT<x DOUBLE, y DOUBLE>>>``; every ring repeats its first point at the end,
rings of either direction are accepted and interior means "odd number of rings around", which covers holes and
multi-polygons. An *edge* is ``STRUCT<x1, y1, x2, y2>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rooftally.fixed_values import SPHERE_RADIUS

POINT = "struct<x:double,y:double>"
RINGS = f"array<array<{POINT}>>"
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often (and in whatever lambda) ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- constructors and accessors -------------------------------------------------------------------------------

def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def box_rings(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """A rectangle, starting lower left, counter-clockwise."""
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    return F.array(F.array(*[point(x, y) for x, y in corners]))


def has_geometry(rings: Column) -> Column:
    """False for a NULL geometry and for one without points."""
    return F.coalesce(F.size(F.flatten(rings)) > 0, F.lit(False))


def bounds_of(rings: Column) -> Column:
    """STRUCT<minx, miny, maxx, maxy>; NULL members for an empty geometry."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"),
    )


def edges_of(rings: Column) -> Column:
    """All edges of all rings as one array."""

    def ring_edges(ring: Column) -> Column:
        starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))

        def edge(start: Column, index: Column) -> Column:
            end = F.element_at(ring, index + 2)
            return F.struct(
                start["x"].alias("x1"), start["y"].alias("y1"), end["x"].alias("x2"), end["y"].alias("y2")
            )

        return F.transform(starts, edge)

    return F.flatten(F.transform(rings, ring_edges))


def normalize_zero(rings: Column) -> Column:
    """Turn -0.0 into 0.0, so that equal places have equal bytes."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(p["x"] + F.lit(0.0), p["y"] + F.lit(0.0))))


def plain_number(value: Column) -> Column:
    """A coordinate as text without exponent, with at least one decimal: ``10020011.0``."""
    fixed_point = value.cast("decimal(30,15)").cast("string")
    return F.regexp_replace(fixed_point, r"(\.\d+?)0+$", "$1")


def bbox_wkt(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Five-point rectangle as WKT."""

    def pair(x: Column, y: Column) -> Column:
        return F.concat_ws(" ", plain_number(x), plain_number(y))

    corners = F.concat_ws(",", pair(minx, miny), pair(maxx, miny), pair(maxx, maxy), pair(minx, maxy), pair(minx, miny))
    return F.concat(F.lit("POLYGON(("), corners, F.lit("))"))


def rings_from_wkt(wkt: Column) -> Column:
    """POLYGON or MULTIPOLYGON text to rings."""
    body = F.regexp_replace(wkt, r"(?i)^\s*(multi)?polygon\s*", "")
    ring_texts = F.filter(F.split(body, r"\)[\s,(]*"), lambda t: F.length(F.regexp_replace(t, r"[\s()]", "")) > 0)

    def parse(text: Column) -> Column:
        pairs = F.split(F.regexp_replace(text, r"[()]", ""), ",")
        return F.transform(
            pairs,
            lambda pair: point(
                F.element_at(F.split(F.trim(pair), r"\s+"), 1).cast("double"),
                F.element_at(F.split(F.trim(pair), r"\s+"), 2).cast("double"),
            ),
        )

    return F.transform(ring_texts, parse)


def rings_as_geojson(rings: Column) -> Column:
    """GeoJSON Polygon object as text."""
    coordinates = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), coordinates.alias("coordinates")))


def signed_area(ring: Column) -> Column:
    """Signed area of one ring (counter-clockwise positive), taken around its first point for precision."""

    def around(origin: Column) -> Column:
        terms = F.transform(
            edges_of(F.array(ring)),
            lambda e: ((e["x1"] - origin["x"]) * (e["y2"] - origin["y"]) - (e["x2"] - origin["x"]) * (e["y1"] - origin["y"])) / 2,
        )
        return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)

    return let(F.get(ring, F.lit(0)), around)


# --- predicates -----------------------------------------------------------------------------------------------

def _on_edge(edge: Column, x: Column, y: Column) -> Column:
    cross = (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (x - edge["x1"]) * (edge["y2"] - edge["y1"])
    return (
        (cross == 0)
        & x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
    )


def _crosses_ray(edge: Column, x: Column, y: Column) -> Column:
    """The edge meets the ray from the point towards growing x (written without a division)."""
    left = (edge["x2"] - edge["x1"]) * (y - edge["y1"])
    right = (x - edge["x1"]) * (edge["y2"] - edge["y1"])
    return ((edge["y1"] > y) != (edge["y2"] > y)) & ((left > right) == (edge["y2"] > edge["y1"]))


def odd_crossings(edges: Column, x: Column, y: Column) -> Column:
    return F.size(F.filter(edges, lambda e: _crosses_ray(e, x, y))) % 2 == 1


def crosses_right(edge: Column, x: Column, y: Column) -> Column:
    """The edge crosses the horizontal line just above the point, strictly right of it."""
    left = (edge["x2"] - edge["x1"]) * (y - edge["y1"])
    right = (x - edge["x1"]) * (edge["y2"] - edge["y1"])
    return ((edge["y1"] > y) != (edge["y2"] > y)) & F.when(edge["y2"] > edge["y1"], left > right).otherwise(left < right)


def crosses_above(edge: Column, x: Column, y: Column) -> Column:
    """The edge, which spans the vertical line just right of the point, crosses it above the point.

    Both this and ``crosses_right`` judge as if the point lay a little to the right, and far less above: so ways along the lines
    of a grid count crossings alike whichever comes first, also where edges run along the grid or through its corners.
    """
    left = (edge["x2"] - edge["x1"]) * (y - edge["y1"])
    right = (x - edge["x1"]) * (edge["y2"] - edge["y1"])
    rises = edge["y2"] > edge["y1"]
    return F.when(left == right, (edge["y1"] != edge["y2"]) & (rises == (edge["x2"] > edge["x1"]))).otherwise((left < right) == (edge["x2"] > edge["x1"]))


def odd_on_the_way(edges: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """Whether the way from (x0, y0), up or down and then across to (x, y), crosses an odd number of the edges."""

    def crosses(e: Column) -> Column:
        up = ((e["x1"] > x0) != (e["x2"] > x0)) & (crosses_above(e, x0, y0) != crosses_above(e, x0, y))
        return up != (crosses_right(e, x0, y) != crosses_right(e, x, y))

    return F.size(F.filter(edges, crosses)) % 2 == 1


def edges_cover_point(edges: Column, x: Column, y: Column) -> Column:
    """Closed point-in-polygon test: a point on the outline counts as inside."""
    return F.exists(edges, lambda e: _on_edge(e, x, y)) | odd_crossings(edges, x, y)


def rings_cover_point(rings: Column, x: Column, y: Column) -> Column:
    return let(edges_of(rings), lambda edges: edges_cover_point(edges, x, y))


def edge_meets_box(edge: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed test by separating axes: the two box axes and the normal of the edge."""
    dx, dy = edge["x2"] - edge["x1"], edge["y2"] - edge["y1"]

    def side(x: Column, y: Column) -> Column:
        return dx * (y - edge["y1"]) - dy * (x - edge["x1"])

    corners = [side(minx, miny), side(maxx, miny), side(maxx, maxy), side(minx, maxy)]
    return (
        (F.least(edge["x1"], edge["x2"]) <= maxx) & (F.greatest(edge["x1"], edge["x2"]) >= minx)
        & (F.least(edge["y1"], edge["y2"]) <= maxy) & (F.greatest(edge["y1"], edge["y2"]) >= miny)
        & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)
    )


def rings_meet_box(rings: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed intersection of a geometry and a rectangle."""

    def test(edges: Column) -> Column:
        return F.exists(edges, lambda e: edge_meets_box(e, minx, miny, maxx, maxy)) | odd_crossings(edges, minx, miny)

    return let(edges_of(rings), test)


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return (
        (a["minx"] <= b["maxx"]) & (a["maxx"] >= b["minx"]) & (a["miny"] <= b["maxy"]) & (a["maxy"] >= b["miny"])
    )


def is_box(rings: Column) -> Column:
    """One ring that is an axis-aligned rectangle from its lower left corner, counter-clockwise."""
    ring = F.get(rings, F.lit(0))

    def corner(i: int, axis: str) -> Column:
        return F.get(ring, F.lit(i))[axis]

    test = (
        (F.size(rings) == 1) & (F.size(ring) == 5)
        & (corner(0, "x") < corner(1, "x")) & (corner(1, "x") == corner(2, "x"))
        & (corner(3, "x") == corner(0, "x")) & (corner(4, "x") == corner(0, "x"))
        & (corner(0, "y") == corner(1, "y")) & (corner(1, "y") < corner(2, "y"))
        & (corner(3, "y") == corner(2, "y")) & (corner(4, "y") == corner(0, "y"))
    )
    return F.coalesce(test, F.lit(False))


#: Columns that stand for the ring of a plain rectangle, see ``corners``.
CORNERS = ["_west", "_south", "_east", "_north"]


def corners(rings: Column) -> dict[str, Column]:
    """The bounds of a plain rectangle, from which ``rings_of_corners`` makes its ring again; NULL for all other geometries.

    Coordinates of zero are left as they are, since a ring may write them with either sign.
    """
    ring = F.get(rings, F.lit(0))
    bounds = [F.get(ring, F.lit(k))[axis] for k, axis in ((0, "x"), (0, "y"), (2, "x"), (2, "y"))]
    plain = is_box(rings)
    for bound in bounds:
        plain = plain & (bound != 0)
    return {name: F.when(plain, bound) for name, bound in zip(CORNERS, bounds)}


def rings_of_corners(rings: Column) -> Column:
    """``rings`` where there are any, else the rectangle of the columns ``CORNERS``."""
    return F.when(F.col(CORNERS[0]).isNull(), rings).otherwise(box_rings(*[F.col(c) for c in CORNERS]))


# --- derived points and projections ---------------------------------------------------------------------------

def interior_point(rings: Column) -> Column:
    """A point inside the polygon: middle of the widest span of a scan line near mid-height.

    The scan line lies halfway between the vertices next to the middle of the bounds, so it never runs through
    a vertex. Empty geometries give NULL; geometries without area fall back to the middle of their bounds.
    """

    def widest_span(edges: Column, scan: Column) -> Column:
        crossed = F.filter(edges, lambda e: (e["y1"] > scan) != (e["y2"] > scan))
        xs = F.array_sort(
            F.transform(crossed, lambda e: e["x1"] + (scan - e["y1"]) * ((e["x2"] - e["x1"]) / (e["y2"] - e["y1"])))
        )

        def spans(sorted_xs: Column) -> Column:
            starts = F.filter(sorted_xs, lambda _x, i: i % 2 == 0)
            ends = F.filter(sorted_xs, lambda _x, i: i % 2 == 1)
            widths = F.zip_with(
                starts, ends, lambda a, b: F.struct((b - a).alias("width"), (-a).alias("left"), ((a + b) / 2).alias("x"), scan.alias("y"))
            )
            return F.array_max(widths)

        return let(xs, spans)

    def scan_line(box: Column) -> Column:
        def near_middle(ys: Column) -> Column:
            middle = (box["miny"] + box["maxy"]) / 2
            below = F.coalesce(F.array_max(F.filter(ys, lambda v: v <= middle)), box["miny"])
            above = F.coalesce(F.array_min(F.filter(ys, lambda v: v > middle)), box["maxy"])
            return (below + above) / 2

        return let(F.transform(F.flatten(rings), lambda p: p["y"]), near_middle)

    def choose(box: Column) -> Column:
        def point_of(span: Column) -> Column:
            centre = point((box["minx"] + box["maxx"]) / 2, (box["miny"] + box["maxy"]) / 2)
            return F.when(F.coalesce(span["width"] > 0, F.lit(False)), point(span["x"], span["y"])).otherwise(centre)

        found = let(scan_line(box), lambda scan: let(edges_of(rings), lambda edges: widest_span(edges, scan)))
        return let(found, point_of)

    low, high = F.get(F.get(rings, F.lit(0)), F.lit(0)), F.get(F.get(rings, F.lit(0)), F.lit(2))
    box_centre = point((low["x"] + high["x"]) / 2, (low["y"] + high["y"]) / 2)
    return F.when(is_box(rings), box_centre).when(has_geometry(rings), let(bounds_of(rings), choose))


def mercator_x(lon: Column) -> Column:
    return F.lit(SPHERE_RADIUS) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(SPHERE_RADIUS) * F.asinh(F.tan(F.radians(lat)))


def longitude(x: Column) -> Column:
    return F.degrees(x / F.lit(SPHERE_RADIUS))


def latitude(y: Column) -> Column:
    return F.degrees(F.atan(F.sinh(y / F.lit(SPHERE_RADIUS))))


def to_mercator(rings: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(mercator_x(p["x"]), mercator_y(p["y"]))))


def to_degrees(rings: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: point(longitude(p["x"]), latitude(p["y"]))))


def utm_zone(lon: Column) -> Column:
    return F.least(F.lit(60), F.greatest(F.lit(1), (F.floor((lon + 180) / 6) + 1).cast("int")))


def utm_point(lon: Column, lat: Column, zone: Column) -> Column:
    """Transverse Mercator on WGS 84 (third-order series in the third flattening), metres, as a point.

    False easting and northing are left out: the coordinates only serve distances within one zone.
    """
    n = 0.0016792203863836474
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    ]
    k = 2 * n**0.5 / (1 + n)

    def series(a: Column) -> Column:
        x, y = a["eta"], a["xi"]
        for order, factor in enumerate(alpha, start=1):
            x = x + F.lit(factor) * F.cos(2 * order * a["xi"]) * F.sinh(2 * order * a["eta"])
            y = y + F.lit(factor) * F.sin(2 * order * a["xi"]) * F.cosh(2 * order * a["eta"])
        return point(F.lit(0.9996 * radius) * x, F.lit(0.9996 * radius) * y)

    def angles(a: Column) -> Column:
        xi = F.atan2(a["t"], F.cos(a["lam"]))
        eta = F.atanh(F.sin(a["lam"]) / F.sqrt(1 + a["t"] * a["t"]))
        return let(F.struct(xi.alias("xi"), eta.alias("eta")), series)

    sine, lam = F.sin(F.radians(lat)), F.radians(lon - (zone * 6 - 183))
    conformal = F.sinh(F.atanh(sine) - F.lit(k) * F.atanh(F.lit(k) * sine))
    return let(F.struct(conformal.alias("t"), lam.alias("lam")), angles)


def edge_distance(edge: Column, x: Column, y: Column) -> Column:
    """Distance from a point to a segment, in the units of the coordinates."""
    dx, dy = edge["x2"] - edge["x1"], edge["y2"] - edge["y1"]
    length2 = dx * dx + dy * dy
    along = F.when(
        length2 > 0, ((x - edge["x1"]) * dx + (y - edge["y1"]) * dy) / length2
    ).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(x - (edge["x1"] + t * dx), y - (edge["y1"] + t * dy))


# --- boxes ----------------------------------------------------------------------------------------------------

def box_gap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Distance between two boxes, 0 when they meet."""
    x = F.greatest(a["minx"] - b["maxx"], b["minx"] - a["maxx"], F.lit(0.0))
    y = F.greatest(a["miny"] - b["maxy"], b["miny"] - a["maxy"], F.lit(0.0))
    return F.sqrt(x * x + y * y)


def box_hull(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    return {
        "minx": F.least(a["minx"], b["minx"]), "miny": F.least(a["miny"], b["miny"]),
        "maxx": F.greatest(a["maxx"], b["maxx"]), "maxy": F.greatest(a["maxy"], b["maxy"]),
    }


def box_area(a: dict[str, Column]) -> Column:
    return F.greatest(a["maxx"] - a["minx"], F.lit(0.0)) * F.greatest(a["maxy"] - a["miny"], F.lit(0.0))


def expansion_ratio(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Area of the common hull over the sum of the areas; NULL when both areas are zero."""
    total = box_area(a) + box_area(b)
    return F.when(total > 0, box_area(box_hull(a, b)) / F.nullif(total, F.lit(0.0)))


def quarter_boxes(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """South-west, south-east, north-west and north-east quarter of a box, as an array of structs."""
    midx, midy = (minx + maxx) / 2, (miny + maxy) / 2

    def quarter(number: int, a: Column, b: Column, c: Column, d: Column) -> Column:
        return F.struct(
            F.lit(number).alias("quarter"), a.alias("minx"), b.alias("miny"), c.alias("maxx"), d.alias("maxy")
        )

    return F.array(
        quarter(0, minx, miny, midx, midy), quarter(1, midx, miny, maxx, midy),
        quarter(2, minx, midy, midx, maxy), quarter(3, midx, midy, maxx, maxy),
    )


def quadrant(x: Column, y: Column, midx: Column, midy: Column) -> Column:
    """0..3: one for the right half plus two for the upper half; the middle belongs to right and upper."""
    return F.when(x >= midx, 1).otherwise(0) + F.when(y >= midy, 2).otherwise(0)


def starts_within(minimum: Column, split_value: float) -> Column:
    """Rows that belong to the lower side of a cut: their lower edge does not exceed it."""
    return minimum <= F.lit(split_value)
