"""Queries on cleaning, duplicates and layer reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import table, view, with_views
from rooftally.functions import geometry as geo
from rooftally.functions import kernels
from rooftally.operators import quality, reports
from rooftally.queries.registry import query
from rooftally.queries.spatial import BOX_KEY, KEEP_FIRST, buildings

RAW_HEIGHT = "CASE WHEN id%7=0 THEN 'unknown' WHEN id%11=0 THEN ' ' ELSE CAST(height AS STRING) END"


def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings as they are fetched: heights as text, some unreadable."""
    return view(spark, sf_dir, "bld").select(
        "id", F.expr(RAW_HEIGHT).alias("height"), (F.col("h") * 1).alias("var"), "source", F.col("x0").alias("unused")
    )


@query(
    "normalize_columns",
    with_views(
        f"""SELECT CAST(id AS VARCHAR) AS "GBA_ID", TRY_CAST({RAW_HEIGHT} AS DOUBLE) AS "Height", h AS "H_VAR", source AS "SOURCE",
                   'GBA_050_I0000_J0000' AS "TILE_ID" FROM bld""",
        "bld",
    ),
)
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_tile_id(quality.normalize_columns(raw_features(spark, sf_dir)), "GBA_050_I0000_J0000")


@query("rename_height", with_views('SELECT id, height AS "Height", source FROM bld', "bld"))
def rename_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rename_height(view(spark, sf_dir, "bld").select("id", "height", "source"))


@query("clean_heights", with_views("SELECT id, height, source FROM bld WHERE height IS NULL OR height > 0", "bld"))
def clean_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = quality.drop_empty_geometry(buildings(spark, sf_dir))
    return quality.drop_non_positive_height(kept, "height").select("id", "height", "source")


@query(
    "scale_height",
    with_views("SELECT id, round(height*0.65::DOUBLE, 9) AS height FROM bld", "bld"),
)
def scale_height(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = quality.scale_height(view(spark, sf_dir, "bld").select("id", "height"), 0.65, "height")
    return scaled.select("id", F.round("height", 9).alias("height"))


@query(
    "scale_report",
    with_views(
        f"""WITH r AS (SELECT {RAW_HEIGHT} AS height FROM bld)
            SELECT count(*) AS feature_count, count(*) FILTER (TRY_CAST(height AS DOUBLE) IS NOT NULL) AS scaled_count,
                   count(*) FILTER (height IS NULL) AS null_count,
                   count(*) FILTER (height IS NOT NULL AND TRY_CAST(height AS DOUBLE) IS NULL) AS non_numeric_count FROM r""",
        "bld",
    ),
)
def scale_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scale_report(raw_features(spark, sf_dir), "height")


@query(
    "dedup_geometry",
    with_views(
        """SELECT id, x0, y0, w, h, height, source FROM (SELECT b.*, row_number() OVER (PARTITION BY x0,y0,w,h
           ORDER BY id, height NULLS LAST, source NULLS LAST) AS rn FROM bld b) d WHERE rn = 1""",
        "bld",
    ),
)
def dedup_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates by the exact rings of each geometry."""
    unique = quality.dedup_geometry(buildings(spark, sf_dir), KEEP_FIRST)
    return unique.select("id", "x0", "y0", "w", "h", "height", "source")


@query(
    "dedup_within",
    with_views(
        """SELECT id, height, source FROM (SELECT b.*, row_number() OVER (PARTITION BY source,x0,y0,w,h
           ORDER BY id, height NULLS LAST) AS rn FROM bld b) d WHERE rn = 1""",
        "bld",
    ),
)
def dedup_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = quality.dedup_geometry(buildings(spark, sf_dir), ["id", "height"], key=BOX_KEY, within=["source"])
    return unique.select("id", "height", "source")


@query(
    "clean_report",
    with_views(
        """WITH k AS (SELECT source, x0, y0, w, h, count(*) AS n, count(*) FILTER (height <= 0) AS z FROM bld GROUP BY ALL)
           SELECT source, sum(n) AS input_count, count(*) FILTER (n > z) AS output_count, 0 AS removed_empty_count,
                  sum(z) AS removed_zero_height_count, sum(greatest(n-z-1, 0)) AS removed_duplicate_count
           FROM k GROUP BY source""",
        "bld",
    ),
)
def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_report(buildings(spark, sf_dir), key=BOX_KEY, within=["source"], height="height")


@query(
    "validity_report",
    with_views(
        """SELECT source, count(*) FILTER (id%10<>0 AND id%3<>0) AS valid_count, count(*) FILTER (id%10<>0 AND id%3=0) AS invalid_count,
                  count(*) FILTER (id%10=0) AS error_count FROM bld GROUP BY source""",
        "bld",
    ),
)
def validity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bow-ties, missing geometries, rectangles and right triangles."""
    x0, y0, x1, y1 = (F.col(c) for c in ("minx", "miny", "maxx", "maxy"))

    def ring(*corners):
        return F.array(F.array(*[geo.point(x, y) for x, y in corners]))

    shape = (
        F.when(F.col("id") % 10 == 0, F.lit(None))
        .when(F.col("id") % 3 == 0, ring((x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0)))
        .when(F.col("id") % 2 == 0, ring((x0, y0), (x1, y0), (x0, y1), (x0, y0)))
        .otherwise(F.col("rings"))
    )
    return quality.validity_report(buildings(spark, sf_dir).withColumn("rings", shape), ["source"])


@query(
    "wkb_round_trip",
    with_views("SELECT id, x0 AS minx, y0+h AS maxy, 93 AS bytes FROM bld", "bld"),
)
def wkb_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every building to well-known binary and back."""
    binary = buildings(spark, sf_dir).select("id", kernels.as_wkb("rings").alias("wkb"))
    back = binary.withColumn("b", geo.bounds_of(kernels.from_wkb("wkb")))
    return back.select("id", "b.minx", "b.maxy", F.length("wkb").alias("bytes"))


@query(
    "size_guard",
    """SELECT l_suppkey, CASE WHEN l_linenumber%2=0 THEN '.dbf' ELSE '.shp' END AS suffix, sum(l_partkey) AS total_bytes,
              sum(l_partkey) <= 300000 AS accepted FROM lineitem GROUP BY 1, 2""",
)
def size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.when(F.col("l_linenumber") % 2 == 0, ".dbf").otherwise(".shp").alias("suffix"), F.col("l_partkey").alias("size")
    )
    return quality.size_guard(parts, 300_000, by=["l_suppkey"])


@query(
    "merge_layers",
    with_views(
        """SELECT id, CASE source WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS layer_no, round(x0,6) AS minx, round(y0+h,6) AS maxy,
                  CASE source WHEN 'R' THEN height END AS extra FROM bld""",
        "bld",
    ),
)
def merge_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layers: without a reference system, in metres, and with a column the others lack."""
    rows = buildings(spark, sf_dir).select("id", "rings", "source", "height")
    first = rows.filter("source = 'A'").drop("source", "height")
    metric = quality.to_srid(rows.filter("source = 'N'").drop("source", "height"), 4326, 3857)
    wider = rows.filter("source = 'R'").drop("source").withColumnRenamed("height", "extra")
    merged = quality.merge_layers([(first, None), (metric, 3857), (wider, 4326)])
    box = merged.withColumn("b", geo.bounds_of(F.col("rings")))
    return box.select("id", "layer_no", F.round("b.minx", 6).alias("minx"), F.round("b.maxy", 6).alias("maxy"), "extra")


@query(
    "overlap_report",
    with_views(
        """
        WITH c AS (SELECT *, x0+w/2 AS px, y0+h/2 AS py FROM bld WHERE x0<=116 AND x0+w>=110 AND y0<=30 AND y0+h>=24),
        k AS (SELECT x0, y0, w, h, count(*) AS n, bool_or(px BETWEEN 110 AND 113 AND py BETWEEN 24 AND 30) AS b,
                     bool_or(x0<110 OR y0<24 OR x0+w>116 OR y0+h>30) AS c, bool_or(coalesce(height>10, false)) AS e FROM c GROUP BY ALL)
        SELECT sum(n) AS raw_count, count(*) AS unique_count, count(*) FILTER (b) AS inside_count, count(*) FILTER (c) AS crossing_count,
               count(*) FILTER (e) AS existing_count, sum(n)-count(*) AS duplicates_removed, count(*)-count(*) FILTER (b) AS outside_count,
               count(*)-count(*) FILTER (e) AS additional_count, round(100.0::DOUBLE*count(*) FILTER (e)/count(*), 4) AS coverage_percent FROM k""",
        "bld",
    ),
)
def overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rooftally.operators.spatial import scan_bbox

    found = scan_bbox(buildings(spark, sf_dir), 110, 24, 116, 30)
    existing = F.coalesce(F.col("height") > 10, F.lit(False))
    return reports.overlap_report(found, (110, 24, 116, 30), reports.inside_box(110, 24, 113, 30), existing, BOX_KEY)


@query("counts_per_source", with_views("SELECT source, count(*) AS n FROM bld GROUP BY source", "bld"))
def counts_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.counts_per_source(view(spark, sf_dir, "bld"))
