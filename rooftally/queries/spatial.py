"""Queries on buildings, boundaries and the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import geometry as geo
from rooftally.functions import grid
from rooftally.operators import index, quality, spatial
from rooftally.queries.registry import query


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``bld`` view with bounds, rings and representative point."""
    return with_shapes(view(spark, sf_dir, "bld"))


def with_shapes(rows: DataFrame) -> DataFrame:
    """Rows of the ``bld`` view with bounds, rings and representative point."""
    box = [F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")]
    names = ["minx", "miny", "maxx", "maxy"]
    return (
        rows.withColumns(dict(zip(names, box)))
        .withColumns(
            {
                "rings": geo.box_rings(*[F.col(n) for n in names]),
                "rep_x": F.col("x0") + F.col("w") / 2,
                "rep_y": F.col("y0") + F.col("h") / 2,
            }
        )
    )


def boundaries(spark: SparkSession, sf_dir: str, name: str = "bnd") -> DataFrame:
    """The ``bnd`` (or ``sbnd``) view as L-shaped polygons."""
    x, y = F.col("bx"), F.col("bt")
    outline = [
        (x, y), (x + 4.8, y), (x + 4.8, y + 2.0), (x + 2.0, y + 2.0), (x + 2.0, y + 4.8), (x, y + 4.8), (x, y),
    ]
    rings = F.array(F.array(*[geo.point(a, b) for a, b in outline]))
    return view(spark, sf_dir, name).withColumn("rings", rings)


BOX_KEY = ["x0", "y0", "w", "h"]
KEEP_FIRST = ["id", "height", "source"]

IN_L = """px BETWEEN n.bx AND n.bx+4.8 AND py BETWEEN n.bt AND n.bt+4.8
          AND NOT (px > n.bx+2.0 AND py > n.bt+2.0)"""


@query(
    "boundary_stats",
    with_views(
        f"""
        WITH kept AS (
          SELECT * FROM (SELECT b.*, row_number() OVER (PARTITION BY x0,y0,w,h
                         ORDER BY id, height NULLS LAST, source NULLS LAST) AS rn
                         FROM bld b WHERE height IS NULL OR height > 0) d WHERE rn = 1),
        pt AS (SELECT k.*, x0+w/2 AS px, y0+h/2 AS py FROM kept k)
        SELECT n.boundary_id, count(*) AS n_buildings, round(avg(height), 6) AS mean_height
        FROM bnd n JOIN pt ON {IN_L} GROUP BY n.boundary_id""",
        "bld", "bnd",
    ),
)
def boundary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean heights, drop duplicate geometries, assign to boundaries, count and average."""
    clean = quality.drop_non_positive_height(buildings(spark, sf_dir), "height")
    unique = quality.dedup_geometry(clean, KEEP_FIRST, key=BOX_KEY)
    placed = spatial.assign_to_boundary(unique, boundaries(spark, sf_dir))
    return placed.groupBy("boundary_id").agg(
        F.count(F.lit(1)).alias("n_buildings"), F.round(F.avg("height"), 6).alias("mean_height")
    )


@query(
    "boundary_assign",
    with_views(
        f"""WITH pt AS (SELECT *, x0+w/2 AS px, y0+h/2 AS py FROM bld)
            SELECT id, height, n.boundary_id FROM bnd n JOIN pt ON {IN_L}""",
        "bld", "bnd",
    ),
)
def boundary_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = spatial.assign_to_boundary(buildings(spark, sf_dir), boundaries(spark, sf_dir))
    return placed.select("id", "height", "boundary_id")


@query("boundary_buffer")
def boundary_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings within 500 m of each boundary; checked against brute force in the tests."""
    placed = spatial.assign_with_buffer(buildings(spark, sf_dir), boundaries(spark, sf_dir), 500.0)
    return placed.groupBy("boundary_id").agg(F.count(F.lit(1)).alias("n_buildings"))


@query(
    "scan_bbox",
    with_views("SELECT id, height FROM bld WHERE x0<=110 AND x0+w>=105 AND y0<=27.5 AND y0+h>=22", "bld"),
)
def scan_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.scan_bbox(buildings(spark, sf_dir), 105, 22, 110, 27.5).select("id", "height")


@query(
    "bbox_exact",
    with_views(
        """SELECT id, x0, y0 FROM bld WHERE x0<=116 AND x0+w>=104 AND y0<=33 AND y0+h>=21
           AND h*(greatest(104,x0)-x0) + w*(greatest(21,y0)-y0) <= w*h""",
        "bld",
    ),
)
def bbox_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles (lower left half of each box): bounds meet more rectangles than the shapes do."""
    corners = [("minx", "miny"), ("maxx", "miny"), ("minx", "maxy"), ("minx", "miny")]
    rings = F.array(F.array(*[geo.point(F.col(a), F.col(b)) for a, b in corners]))
    triangles = buildings(spark, sf_dir).withColumn("rings", rings)
    return spatial.filter_rectangle(triangles, 104, 21, 116, 33).select("id", "x0", "y0")


@query(
    "grid_cells",
    with_views(
        """
        WITH d AS (SELECT boundary_id, bx, bt, bx+4.8 AS ex, bt+4.8 AS et FROM sbnd),
        r AS (SELECT *, CAST(floor((CAST(CAST(bx AS VARCHAR) AS DECIMAL(30,20))+180)*2) AS INT) AS i0,
                        CAST(ceil((CAST(CAST(ex AS VARCHAR) AS DECIMAL(30,20))+180)*2)-1 AS INT) AS i1,
                        CAST(floor((CAST(CAST(bt AS VARCHAR) AS DECIMAL(30,20))+90)*2) AS INT) AS j0,
                        CAST(ceil((CAST(CAST(et AS VARCHAR) AS DECIMAL(30,20))+90)*2)-1 AS INT) AS j1 FROM d),
        c AS (SELECT *, unnest(generate_series(i0, i1)) AS i FROM r),
        g AS (SELECT *, unnest(generate_series(j0, j1)) AS j FROM c),
        m AS (SELECT *, i*0.5::DOUBLE-180 AS minx, j*0.5::DOUBLE-90 AS miny, (i+1)*0.5::DOUBLE-180 AS maxx, (j+1)*0.5::DOUBLE-90 AS maxy FROM g)
        SELECT boundary_id, printf('GBA_%03d_I%04d_J%04d', 50, i, j) AS grid_id, i AS grid_i, j AS grid_j,
               0.5::DOUBLE AS grid_size, minx, miny, maxx, maxy
        FROM m WHERE (minx<=ex AND maxx>=bx AND miny<=bt+2.0 AND maxy>=bt)
                  OR (minx<=bx+2.0 AND maxx>=bx AND miny<=et AND maxy>=bt)""",
        "sbnd",
    ),
)
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.boundary_to_grid(boundaries(spark, sf_dir, "sbnd"), 0.5)


@query(
    "grid_index",
    with_views(
        """
        WITH q AS (SELECT id, CAST(floor((CAST(CAST(x0 AS VARCHAR) AS DECIMAL(30,20))+180)*4) AS INT) AS i0,
                        CAST(ceil((CAST(CAST(x0+w AS VARCHAR) AS DECIMAL(30,20))+180)*4)-1 AS INT) AS i1,
                        CAST(floor((CAST(CAST(y0 AS VARCHAR) AS DECIMAL(30,20))+90)*4) AS INT) AS j0,
                        CAST(ceil((CAST(CAST(y0+h AS VARCHAR) AS DECIMAL(30,20))+90)*4)-1 AS INT) AS j1 FROM bld)
        SELECT id, i0, i1, j0, j1, printf('GBA_%03d_I%04d_J%04d', 25, i0, j0) AS grid_id,
               i0*0.25::DOUBLE-180 AS minx, (j0+1)*0.25::DOUBLE-90 AS maxy FROM q""",
        "bld",
    ),
)
def grid_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    i0, i1, j0, j1 = grid.cell_ranges(*spatial.box_columns().values(), size=0.25)
    rows = buildings(spark, sf_dir).select("id", i0.alias("i0"), i1.alias("i1"), j0.alias("j0"), j1.alias("j1"))
    bounds = grid.cell_bounds(F.col("i0"), F.col("j0"), 0.25)
    return rows.withColumns(
        {"grid_id": grid.grid_id(F.col("i0"), F.col("j0"), 0.25), "minx": bounds["minx"], "maxy": bounds["maxy"]}
    )


@query(
    "shared_cells",
    with_views(
        """
        WITH d AS (SELECT boundary_id, bx, bt, bx+4.8 AS ex, bt+4.8 AS et FROM sbnd),
        c AS (SELECT *, unnest(generate_series(CAST(floor((CAST(CAST(bx AS VARCHAR) AS DECIMAL(30,20))+180)*2) AS INT),
                                               CAST(ceil((CAST(CAST(ex AS VARCHAR) AS DECIMAL(30,20))+180)*2)-1 AS INT))) AS i FROM d),
        g AS (SELECT *, unnest(generate_series(CAST(floor((CAST(CAST(bt AS VARCHAR) AS DECIMAL(30,20))+90)*2) AS INT),
                                               CAST(ceil((CAST(CAST(et AS VARCHAR) AS DECIMAL(30,20))+90)*2)-1 AS INT))) AS j FROM c),
        m AS (SELECT * FROM g WHERE (i*0.5-180<=ex AND (i+1)*0.5-180>=bx AND j*0.5-90<=bt+2.0 AND (j+1)*0.5-90>=bt)
                                 OR (i*0.5-180<=bx+2.0 AND (i+1)*0.5-180>=bx AND j*0.5-90<=et AND (j+1)*0.5-90>=bt))
        SELECT printf('GBA_%03d_I%04d_J%04d', 50, i, j) AS grid_id, count(*) AS n FROM m GROUP BY i, j HAVING count(*) > 1""",
        "sbnd",
    ),
)
def shared_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that belong to more than one boundary."""
    cells = spatial.boundary_to_grid(boundaries(spark, sf_dir, "sbnd"), 0.5)
    return cells.groupBy("grid_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


MERCATOR_Y = "6378137*ln(tan(radians({0}))+sqrt(tan(radians({0}))*tan(radians({0}))+1))"


@query(
    "mercator_bounds",
    with_views(
        f"""SELECT id, round(6378137*radians(x0),3) AS mx, round({MERCATOR_Y.format('y0')},3) AS my,
                   round(x0+w,7) AS lon, round(y0+h,7) AS lat FROM bld""",
        "bld",
    ),
)
def mercator_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corner to metres, and the other corner to metres and back."""
    x, y = geo.mercator_x(F.col("maxx")), geo.mercator_y(F.col("maxy"))
    return buildings(spark, sf_dir).select(
        "id", F.round(geo.mercator_x(F.col("x0")), 3).alias("mx"), F.round(geo.mercator_y(F.col("y0")), 3).alias("my"),
        F.round(geo.longitude(x), 7).alias("lon"), F.round(geo.latitude(y), 7).alias("lat"),
    )


@query(
    "interior_points",
    with_views("SELECT id, round(x0+w/4,7) AS px, round(y0+h/2,7) AS py FROM bld", "bld"),
)
def interior_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Representative point of a triangle: middle of its width at half height."""
    corners = [("minx", "miny"), ("maxx", "miny"), ("minx", "maxy"), ("minx", "miny")]
    rings = F.array(F.array(*[geo.point(F.col(a), F.col(b)) for a, b in corners]))
    return buildings(spark, sf_dir).withColumn("p", geo.interior_point(rings)).select(
        "id", F.round("p.x", 7).alias("px"), F.round("p.y", 7).alias("py")
    )


@query(
    "layer_bounds",
    with_views(
        f"""SELECT source, round(6378137*radians(min(x0)),3) AS minx, round({MERCATOR_Y.format('min(y0)')},3) AS miny,
                   round(6378137*radians(max(x0+w)),3) AS maxx, round({MERCATOR_Y.format('max(y0+h)')},3) AS maxy
            FROM bld GROUP BY source""",
        "bld",
    ),
)
def layer_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = index.layer_bounds(buildings(spark, sf_dir), ["source"])
    return boxes.select("source", *[F.round(c, 3).alias(c) for c in ("minx", "miny", "maxx", "maxy")])


def distinct_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per id (the geometry depends on the id alone)."""
    unique = view(spark, sf_dir, "bld").groupBy("id", "x0", "y0", "w", "h").agg(F.max("height").alias("height"))
    box = [F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")]
    return unique.select("id", "height", geo.box_rings(*box).alias("rings"))


@query(
    "clip_mask",
    with_views(
        """
        WITH f AS (SELECT id, max(height) AS height, max(x0) AS a, max(y0) AS b, max(x0+w) AS c, max(y0+h) AS d FROM bld GROUP BY id),
        parts AS (SELECT boundary_id, bx AS l, bt AS m, bx+4.8 AS r, bt+2.0 AS t, 1 AS sign FROM bnd
                  UNION ALL SELECT boundary_id, bx, bt, bx+2.0, bt+4.8, 1 FROM bnd
                  UNION ALL SELECT boundary_id, bx, bt, bx+2.0, bt+2.0, -1 FROM bnd)
        SELECT id AS feature_id, height, round(1e8*sum(sign*greatest(least(c,r)-greatest(a,l),0)*greatest(least(d,t)-greatest(b,m),0)),4) AS area
        FROM f JOIN parts ON a<=r AND c>=l AND b<=t AND d>=m GROUP BY id, height""",
        "bld", "bnd",
    ),
)
def clip_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings cut to the union of all boundaries; areas of what is left."""
    features = distinct_buildings(spark, sf_dir).withColumnRenamed("id", "feature_id")
    cut = spatial.clip(features, boundaries(spark, sf_dir))
    # rings of either direction, no holes here: the area is the sum of the ring areas
    area = F.aggregate(
        "rings", F.lit(0.0), lambda total, ring: total + F.abs(geo.signed_area(ring))
    )
    area = F.when(F.col("geom_type") == "POLYGON", area).otherwise(F.lit(0.0))
    return cut.select("feature_id", "height", F.round(F.lit(1e8) * area, 4).alias("area"))


@query(
    "clip_slanted",
    # what a half-plane leaves of a rectangle, in closed form; s is the distance of the lower left corner from the line
    with_views(
        """
        WITH f AS (SELECT id, max(x0) AS a, max(y0) AS b, max(w) AS w, max(h) AS h FROM bld GROUP BY id),
        g AS (SELECT id, 1-(a-90)/40-(b-10)/50 AS s, w/40 AS u, h/50 AS v FROM f),
        p AS (SELECT id, CASE WHEN s>=u+v THEN 1 ELSE (s*s-greatest(s-u,0)*greatest(s-u,0)-greatest(s-v,0)*greatest(s-v,0))/(2*u*v) END AS part
              FROM g WHERE s>0)
        SELECT id AS feature_id, round(CAST(part AS DOUBLE),4) AS part FROM p WHERE part>=0.001""",
        "bld",
    ),
)
def clip_slanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings cut by one long slanted edge, in degrees; the share of each that is left."""
    features = distinct_buildings(spark, sf_dir).withColumnRenamed("id", "feature_id")
    corners = [(90.0, 10.0), (130.0, 10.0), (90.0, 60.0), (90.0, 10.0)]
    mask = spark.range(1).select(F.array(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in corners])).alias("rings"))
    whole = features.withColumn("whole", F.abs(geo.signed_area(F.col("rings")[0])))
    cut = spatial.clip(whole, mask).filter("geom_type = 'POLYGON'")
    area = F.aggregate("rings", F.lit(0.0), lambda total, ring: total + F.abs(geo.signed_area(ring)))
    return spatial.once(cut, F.struct(F.round(area / F.col("whole"), 4).alias("part"))).select("feature_id", "part").filter("part >= 0.001")


@query(
    "clip_boxes",
    with_views(
        """SELECT id, greatest(x0,105) AS minx, greatest(y0,22) AS miny, least(x0+w,118) AS maxx, least(y0+h,35) AS maxy
           FROM bld WHERE x0<=118 AND x0+w>=105 AND y0<=35 AND y0+h>=22""",
        "bld",
    ),
)
def clip_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = spatial.clip_boxes(buildings(spark, sf_dir), 105.0, 22.0, 118.0, 35.0)
    return cut.select("id", "minx", "miny", "maxx", "maxy")
