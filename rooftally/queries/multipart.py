"""Queries on geometry of several parts: overlapping parts, holes, round trips, roles of rings, dissolved outlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import geometry as geo
from rooftally.functions import parts as multi
from rooftally.operators import quality, spatial
from rooftally.operators.dissolve import dissolve
from rooftally.queries.registry import query
from rooftally.queries.spatial import buildings


def ring(*corners: tuple[Column, Column]) -> Column:
    return F.array(*[geo.point(x, y) for x, y in (*corners, corners[0])])


def square(x: Column, y: Column, low: float, high: float, clockwise: bool = False) -> Column:
    """A square from (x + low, y + low) to (x + high, y + high)."""
    corners = [(x + low, y + low), (x + high, y + low), (x + high, y + high), (x + low, y + high)]
    return ring(*(corners[:1] + corners[:0:-1] if clockwise else corners))


def overlapping(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Boundaries of two parts that overlap; the second has a hole that reaches into the first."""
    x, y = F.col("bx"), F.col("bt")
    parts = F.array(F.array(square(x, y, 0.0, 3.0)), F.array(square(x, y, 2.0, 4.5), square(x, y, 2.5, 4.0, True)))
    return view(spark, sf_dir, name).select("boundary_id", "bx", "bt", parts.alias("parts"))


@query(
    "multipart_assign",
    with_views(
        """
        WITH pt AS (SELECT id, height, x0+w/2 AS px, y0+h/2 AS py FROM bld)
        SELECT id, height, boundary_id FROM bnd JOIN pt ON
          (px BETWEEN bx AND bx+3.0 AND py BETWEEN bt AND bt+3.0)
          OR (px BETWEEN bx+2.0 AND bx+4.5 AND py BETWEEN bt+2.0 AND bt+4.5
              AND NOT (px > bx+2.5 AND px < bx+4.0 AND py > bt+2.5 AND py < bt+4.0))""",
        "bld", "bnd",
    ),
)
def multipart_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A building in both parts belongs to the boundary, one in the hole of one part only if the other part covers it."""
    placed = spatial.assign_to_boundary(buildings(spark, sf_dir), overlapping(spark, sf_dir, "bnd"))
    return placed.select("id", "height", "boundary_id")


def _square_sql(low: str, high: str, clockwise: bool = False) -> str:
    corners = [(low, low), (high, low), (high, high), (low, high)]
    corners = corners[:1] + corners[:0:-1] if clockwise else corners
    return "'(' || " + " || ',' || ".join(f"(bx+{a})::VARCHAR || ' ' || (bt+{b})::VARCHAR" for a, b in (*corners, corners[0])) + " || ')'"


@query(
    "multipart_round_trip",
    with_views(
        f"""SELECT boundary_id, 2 AS n_parts, 3 AS n_rings, 'MULTIPOLYGON((' || {_square_sql('0.0', '3.0')} || '),(' || {_square_sql('2.0', '4.5')} || ',' || {_square_sql('2.5', '4.0', True)} || '))' AS wkt,
                   9 + 2*9 + 3*(4+5*16) AS bytes FROM sbnd""",
        "sbnd",
    ),
)
def multipart_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts through text, binary and GeoJSON and back to text, with their roles."""
    rows = overlapping(spark, sf_dir, "sbnd").select("boundary_id", multi.as_wkb(multi.from_wkt(multi.as_wkt(F.col("parts")))).alias("wkb"))
    json = rows.select("boundary_id", F.length("wkb").alias("bytes"), multi.as_geojson(multi.from_wkb("wkb")).alias("json"))
    back = json.select("boundary_id", "bytes", multi.from_geojson(F.get_json_object("json", "$.type"), F.get_json_object("json", "$.coordinates")).alias("parts"))
    return back.select("boundary_id", F.size("parts").alias("n_parts"), F.size(multi.flat(F.col("parts"))).alias("n_rings"), multi.as_wkt(F.col("parts")).alias("wkt"), "bytes")


@query(
    "multipart_validity",
    with_views(
        """SELECT source, count(*) FILTER (id%9 IN (0,3,5,7)) AS valid_count, count(*) FILTER (id%9 IN (1,2,4,6,8)) AS invalid_count, 0 AS error_count FROM bld GROUP BY source""",
        "bld",
    ),
)
def multipart_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine sorts of shapes over the buildings' places, sound and unsound by the roles of their rings."""
    x, y = F.col("x0"), F.col("y0")

    def at(low: float, high: float) -> Column:
        return square(x, y, low, high)

    diamond = ring((x, y + 2.0), (x + 2.0, y), (x + 4.0, y + 2.0), (x + 2.0, y + 4.0))
    shapes = [
        F.array(F.array(at(0.0, 4.0), at(1.0, 2.0))),  # a hole in its shell
        F.array(F.array(at(0.0, 4.0), at(5.0, 6.0))),  # a hole outside its shell
        F.array(F.array(at(0.0, 4.0)), F.array(at(1.0, 2.0))),  # a part within a part
        F.array(F.array(at(0.0, 6.0), at(1.0, 5.0)), F.array(at(2.0, 3.0))),  # a part in another's hole
        F.array(F.array(at(0.0, 6.0), at(1.0, 5.0), at(2.0, 3.0))),  # a hole within a hole
        F.array(F.array(at(0.0, 2.0)), F.array(at(2.0, 4.0))),  # parts that meet in one corner
        F.array(F.array(at(0.0, 4.0), diamond)),  # a hole that cuts the interior into four
        F.array(F.array(at(0.0, 6.0), ring((x, y + 3.0), (x + 2.0, y + 2.0), (x + 2.0, y + 4.0)))),  # a hole that touches its shell once
        F.array(F.array(at(0.0, 3.0)), F.array(at(2.0, 4.0))),  # parts that overlap
    ]
    # one branch per sort: only the shape that is wanted is made
    parts = F.coalesce(*[F.when(F.col("id") % 9 == k, shape) for k, shape in enumerate(shapes)])
    shaped = spatial.once(buildings(spark, sf_dir), F.struct(parts.alias("parts")), drop=["rings"])
    shaped = spatial.once(shaped, F.struct(multi.flat(F.col("parts")).alias("rings")))
    return quality.validity_report(shaped, ["source"])


@query(
    "dissolve",
    with_views("SELECT boundary_id, 2 AS n_rings, 1 AS n_holes, 16 AS n_points, 12.25::DOUBLE AS area, round(bx, 6) AS minx, round(bt+4.5, 6) AS maxy FROM sbnd", "sbnd"),
)
def dissolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outline of the overlapping parts: eight corners around, and what the first part leaves of the second's hole."""
    rings = dissolve(overlapping(spark, sf_dir, "sbnd"), size=1.0)
    area, box = geo.signed_area(F.col("ring")), geo.bounds_of(F.array("ring"))
    told = rings.select("boundary_id", "hole", F.size("ring").alias("points"), area.alias("area"), box.alias("b"))
    return told.groupBy("boundary_id").agg(
        F.count(F.lit(1)).alias("n_rings"), F.count_if("hole").alias("n_holes"), F.sum("points").alias("n_points"), F.round(F.sum("area"), 6).alias("area"),
        F.round(F.min("b.minx"), 6).alias("minx"), F.round(F.max("b.maxy"), 6).alias("maxy"),
    )
