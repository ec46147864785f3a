"""Queries that run whole jobs: layer processing and the rectangle export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import geometry as geo
from rooftally.plans import build, publish
from rooftally.operators import index
from rooftally.queries.registry import query
from rooftally.queries.spatial import MERCATOR_Y, buildings, with_shapes
from rooftally.queries.tiling import ROUNDS, TARGET, merge_sql, quadtree_sql
from rooftally.session import with_position

METRIC = f"""WITH RECURSIVE metric AS (SELECT *, 6378137*radians(x0) AS a, {MERCATOR_Y.format('y0')} AS b, 6378137*radians(x0+w) AS c, {MERCATOR_Y.format('(y0+h)')} AS d,
                   row_number() OVER (ORDER BY id, height NULLS LAST, source NULLS LAST) AS row_id FROM bld),
             located AS (SELECT *, (a+c)/2 AS px, (b+d)/2 AS py, '' AS node, true AS live FROM metric),"""
# same rounds as the quadtree query, on the metric representative points
TREE = METRIC + quadtree_sql("source")[len("WITH "):].replace(
    "t0 AS (SELECT *, x0+w/2 AS px, y0+h/2 AS py, '' AS node, true AS live FROM bld)", "t0 AS (SELECT * FROM located)"
)
# sizes at which chunks are merged, in buildings, and how near they have to be, in metres
LIMITS = {"minimum": 1300, "maximum": 4000, "distance": 500.0, "ratio": 1.25}
NAMED = f""", leaves AS (SELECT source, node, count(*) AS n, min(a) AS minx, min(b) AS miny, max(c) AS maxx, max(d) AS maxy, min(row_id) AS first FROM t{ROUNDS} GROUP BY 1, 2),
    {merge_sql("leaves", *LIMITS.values())},
    boxes AS (SELECT source, merged, count(*) AS parts, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy, min(first) AS first FROM leaves JOIN g USING (source, node) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY miny, minx, maxy, maxx, first) AS k, sum(parts) OVER (PARTITION BY source) AS chunks FROM boxes),
    names AS (SELECT source, node, CASE WHEN chunks=1 THEN source ELSE concat(source, '_001_', lpad(CAST(k AS VARCHAR), 3, '0')) END AS chunk_name FROM ranked JOIN g USING (source, merged)),
    placed AS (SELECT t.*, chunk_name FROM t{ROUNDS} t JOIN names USING (source, node))"""


def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings with a unique ``row_id`` in a total order."""
    keys = [F.col("id").asc(), F.col("height").asc_nulls_last(), F.col("source").asc_nulls_last()]
    # the narrow rows are ordered, outlines come after
    rows = with_position(view(spark, sf_dir, "bld"), *keys, name="row_id")
    return with_shapes(rows).select("id", "height", "source", "rings", "row_id")


@query(
    "process_layer",
    with_views(
        TREE + NAMED + """, kept AS (SELECT *, row_number() OVER (PARTITION BY chunk_name, x0, y0, w, h ORDER BY row_id) AS rn FROM placed WHERE height IS NULL OR height > 0)
        SELECT id, chunk_name, round(a, 3) AS minx, round(d, 3) AS maxy FROM kept WHERE rn = 1""",
        "bld",
    ),
)
def process_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks with small ones merged, validity, heights, duplicates within the chunk, reprojection."""
    layer, _ = build.process_layer(numbered(spark, sf_dir), dataset="source", height="height", target=TARGET, **LIMITS)
    box = layer.withColumn("b", geo.bounds_of(F.col("rings")))
    return box.select("id", "chunk_name", F.round("b.minx", 3).alias("minx"), F.round("b.maxy", 3).alias("maxy"))


@query(
    "process_report",
    with_views(
        TREE + NAMED + """, shapes AS (SELECT source, chunk_name, x0, y0, w, h, count(*) AS n, count(*) FILTER (height <= 0) AS z FROM placed GROUP BY ALL)
        SELECT source, chunk_name, sum(n) AS input_count, sum(n) AS valid_count, 0 AS invalid_count, sum(z) AS removed_zero_height_count,
               sum(greatest(n-z-1, 0)) AS removed_duplicate_count, count(*) FILTER (n > z) AS output_count FROM shapes GROUP BY 1, 2""",
        "bld",
    ),
)
def process_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.process_layer(numbered(spark, sf_dir), dataset="source", height="height", target=TARGET, **LIMITS)[1]


@query(
    "query_rectangle",
    with_views(
        """WITH f AS (SELECT *, concat(CAST(floor(x0/2) AS INT), '_', CAST(floor(y0/2) AS INT)) AS shard FROM bld WHERE x0<=112.5 AND x0+w>=109.25 AND y0<=30.5 AND y0+h>=28)
           SELECT shard, id, height, source FROM (SELECT *, row_number() OVER (PARTITION BY x0,y0,w,h ORDER BY id, height NULLS LAST, source NULLS LAST) AS rn FROM f) d WHERE rn=1""",
        "bld",
    ),
)
def query_rectangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    shard = F.concat_ws("_", F.floor(F.col("x0") / 2).cast("int").cast("string"), F.floor(F.col("y0") / 2).cast("int").cast("string"))
    features = buildings(spark, sf_dir).withColumn("shard", shard)
    table = index.layer_bounds(features, ["shard"], metric=False)
    found = publish.query_rectangle(table, features, (109.25, 28, 112.5, 30.5), ["id", "height", "source"], on=["shard"])
    return found.select("shard", "id", "height", "source")
