"""Queries on tile writing, stamps, sides of a cut, task names and the checks of finished layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import geometry as geo
from rooftally.functions import grid, tables, text
from rooftally.operators import index, spatial, tiling
from rooftally.queries.jobs import new_folder
from rooftally.queries.registry import query
from rooftally.queries.spatial import boundaries, buildings
from rooftally.sources import layers, sinks


@query(
    "write_tiles",
    with_views(
        """WITH c AS (SELECT i, j, printf('GBA_%03d_I%04d_J%04d', 300, i, j) AS grid_id FROM (SELECT unnest(generate_series(92, 102)) AS i), (SELECT unnest(generate_series(35, 45)) AS j)),
                n AS (SELECT CAST(floor((x0+180)/3) AS INT) AS i, CAST(floor((y0+90)/3) AS INT) AS j, count(*) AS n FROM bld GROUP BY 1, 2)
           SELECT grid_id, CASE WHEN n > 0 THEN 'COMPLETE' ELSE 'EMPTY' END AS status, CAST(coalesce(n, 0) AS BIGINT) AS feature_count, coalesce(n, 0) > 0 AS has_files FROM c LEFT JOIN n USING (i, j)""",
        "bld",
    ),
)
def write_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings written by grid cell, and the completion records of all cells of an area, as the ledger holds them."""
    i, j = grid.min_index(F.col("x0"), -180, 3.0), grid.min_index(F.col("y0"), -90, 3.0)
    rows = view(spark, sf_dir, "bld").withColumn("TILE_ID", grid.grid_id(i, j, 3.0))
    corners = [F.lit(float(v)) for v in (96.5, 16.5, 128.5, 46.5)]
    area = spark.range(1).select(F.lit("area").alias("boundary_id"), geo.box_rings(*corners).alias("rings"))
    ledger = new_folder(spark, "ledger")
    sinks.write_tiles(rows, spatial.boundary_to_grid(area, 3.0), new_folder(spark, "tiles"), ledger)
    found = spark.read.parquet(ledger)
    return found.select("grid_id", "status", "feature_count", F.coalesce(F.size("files") > 0, F.lit(False)).alias("has_files"))


@query(
    "stamped_rows",
    with_views(
        """SELECT shp_name, CASE WHEN substr(shp_name, length(shp_name) - 6, 1) IN ('1', '3') THEN minx + 1 ELSE minx END AS minx,
                  CASE WHEN substr(shp_name, length(shp_name) - 6, 1) IN ('1', '3') THEN '2024-05-06T07:08:09' ELSE 'old' END AS updated_at FROM idx""",
        "idx",
    ),
)
def stamped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows put in anew carry the time of the change, the others keep theirs."""
    table = view(spark, sf_dir, "idx").select("shp_name", "minx", F.lit("old").alias("updated_at"))
    changed = table.filter(F.substring("shp_name", -7, 1).isin("1", "3")).withColumn("minx", F.col("minx") + 1).drop("updated_at")
    return index.upsert_rows(table, changed, ["shp_name"], F.lit("2024-05-06T07:08:09"))


@query("side_of_cut", with_views("SELECT id, x0, y0 FROM bld WHERE y0 <= 27.125", "bld"))
def side_of_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.assign_to_side(buildings(spark, sf_dir), 27.125, "y").select("id", "x0", "y0")


@query("polygon_layers", with_views("SELECT id, CASE id%4 WHEN 0 THEN 'Polygon' ELSE 'MULTIPOLYGON' END AS geom_type FROM bld WHERE id%4 IN (0, 3)", "bld"))
def polygon_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only polygons and multi-polygons stay, whatever the case of their name."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("Polygon", "Point", "LINESTRING", "MULTIPOLYGON")]), (F.col("id") % 4 + 1).cast("int"))
    return spatial.polygons_only(view(spark, sf_dir, "bld").select("id", kind.alias("geom_type")))


@query(
    "task_names",
    with_views(
        """SELECT shp_name, concat(continent, '|', country, '|', city) AS task_id, concat('data/', continent, '/', country, '/', replace(city, '_', ' / ')) AS raw,
                  concat('data/', continent, '/', country, '/', replace(city, '_', ' _ ')) AS download_dir FROM idx""",
        "idx",
    ),
)
def task_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier and default folder of a task, with a slash inside a name."""
    city = F.replace("city", F.lit("_"), F.lit(" / "))
    return view(spark, sf_dir, "idx").select(
        "shp_name", text.task_id(F.col("continent"), F.col("country"), F.col("city")).alias("task_id"),
        F.concat_ws("/", F.lit("data"), "continent", "country", city).alias("raw"), text.default_download_dir(F.col("continent"), F.col("country"), city).alias("download_dir"),
    )


@query(
    "query_values",
    """SELECT n_nationkey, CASE WHEN n_nationkey%3=0 THEN n_name END AS state, CASE WHEN n_nationkey%3=1 THEN concat(n_name, '/x') END AS items, CASE WHEN n_nationkey%3=2 THEN n_name END AS text FROM nation""",
)
def query_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place queries as JSON object, JSON array or plain text."""
    name = F.col("n_name")
    value = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit(' {"state": "'), name, F.lit('"} '))).when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit('["'), name, F.lit('", "x"]'))).otherwise(F.concat(F.lit("  "), name, F.lit(" ")))
    parsed = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", text.parse_query_value(value).alias("v"))
    items = F.when(F.col("v.items").isNotNull(), F.array_join("v.items", "/"))
    return parsed.select("n_nationkey", F.try_element_at("v.fields", F.lit("state")).alias("state"), items.alias("items"), F.col("v.text").alias("text"))


@query(
    "verify_layer",
    "SELECT count(*) AS shards, CAST(sum(s_suppkey) AS BIGINT) AS features, 0 AS unreadable, count(*) FILTER (s_suppkey%50=7) AS other_srid, count(*) FILTER (s_suppkey%50=7) = 0 AS ok FROM supplier",
)
def verify_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of which some are in degrees: the layer is not accepted."""
    shards = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("long").alias("records"), F.when(F.col("s_suppkey") % 50 == 7, 4326).otherwise(3857).alias("srid"))
    return layers.verify_output(shards)


@query(
    "cells_of",
    with_views(
        """WITH c AS (SELECT boundary_id, unnest(generate_series(CAST(floor((CAST(CAST(bx AS VARCHAR) AS DECIMAL(30,20))+180)*2) AS INT), CAST(ceil((CAST(CAST(bx+2.0 AS VARCHAR) AS DECIMAL(30,20))+180)*2)-1 AS INT))) AS grid_i, bt FROM sbnd),
                d AS (SELECT boundary_id, grid_i, unnest(generate_series(CAST(floor((CAST(CAST(bt AS VARCHAR) AS DECIMAL(30,20))+90)*2) AS INT), CAST(ceil((CAST(CAST(bt+2.0 AS VARCHAR) AS DECIMAL(30,20))+90)*2)-1 AS INT))) AS grid_j FROM c)
           SELECT boundary_id, printf('GBA_%03d_I%04d_J%04d', 50, grid_i, grid_j) AS grid_id, grid_i, grid_j FROM d""",
        "sbnd",
    ),
)
def cells_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical cells of a box per boundary, by the SQL table function."""
    tables.register(spark)
    boxes = boundaries(spark, sf_dir, "sbnd").select("boundary_id", "bx", "bt")
    return spark.sql("SELECT boundary_id, c.* FROM {boxes}, LATERAL cells_of(bx, bt, bx + 2.0D, bt + 2.0D, 0.5D) c", boxes=boxes)
