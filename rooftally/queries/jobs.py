"""Queries that run jobs which write: what they return is read back from the files, records and tables they leave."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import text
from rooftally.operators import index, spatial
from rooftally.plans import publish
from rooftally.queries.registry import query
from rooftally.queries.spatial import boundaries, buildings
from rooftally.session import shared_folder, stage

VOLUME = 4000


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def record_members(record: DataFrame, members: str) -> DataFrame:
    return record.select(F.from_json("record", members).alias("r")).select("r.*")


@query(
    "deliver_layer",
    with_views(
        f"""WITH t AS (SELECT count(*) AS n FROM bld)
            SELECT 'layer' AS task_id, CASE WHEN n > 0 THEN 'OK' ELSE 'OK_EMPTY' END AS status, n AS feature_count, CAST(ceil(n / {VOLUME}.0) AS INT) AS volumes, n AS stored,
                   'PENDING' AS queue_status, CAST(ceil(n / {VOLUME}.0) AS INT) AS queued_files, 5 AS queue_order FROM t""",
        "bld",
    ),
)
def deliver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All buildings delivered as volumes: the record's members, the rows read back, and the entry in the processing queue."""
    layer = view(spark, sf_dir, "bld").select("id", "height", "source")
    job = spark.createDataFrame([("layer",)], "task_id string")
    tasks = spark.createDataFrame([("layer", "RUNNING", None, None, None)], "task_id string, status string, feature_count long, finished_at string, updated_at string")
    queue = spark.createDataFrame([("old", "OK", 4, "[]", None, None)], "dataset_key string, status string, queue_order long, shp_files string, source_fingerprint string, finished_at string")
    path = new_folder(spark, "volumes")
    table, record, entered = publish.deliver(layer, ["id", "height", "source"], job, tasks, path, VOLUME, queue)
    told = record_members(record, "task_id string, status string, feature_count long, shp_outputs array<string>")
    stored = spark.read.parquet(path).groupBy().agg(F.count(F.lit(1)).alias("stored")).withColumn("task_id", F.lit("layer"))
    waiting = entered.select(F.col("dataset_key").alias("task_id"), F.col("status").alias("queue_status"), text.json_list_size(F.col("shp_files")).alias("queued_files"), "queue_order")
    whole = table.select("task_id", "status", "feature_count").join(told.select("task_id", F.size("shp_outputs").alias("volumes")), "task_id")
    return whole.join(stored, "task_id").join(waiting, "task_id")


@query(
    "backfill_volumes",
    with_views(
        f"""SELECT source AS task_id, count(*) AS stored, CAST(ceil(count(*) / {VOLUME}.0) AS INT) AS volumes, concat('parts=', CAST(ceil(count(*) / {VOLUME}.0) AS INT)) AS detail
            FROM bld WHERE source <> 'N' GROUP BY source""",
        "bld",
    ),
)
def backfill_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of the finished tasks cut into volumes; records and events name them, the files hold every row."""
    layers = stage(view(spark, sf_dir, "bld").select(F.col("source").alias("task_id"), "id", "height"))
    tasks = layers.select("task_id").distinct().withColumn("status", F.when(F.col("task_id") == "N", "FAILED").otherwise("OK"))
    path = new_folder(spark, "backfill")
    records, events = publish.backfill_volumes(tasks, layers, ["id", "height"], path, None, VOLUME)
    told = record_members(records, "task_id string, shp_outputs array<string>").select("task_id", F.size("shp_outputs").alias("volumes"))
    stored = spark.read.parquet(path).groupBy("task_id").agg(F.count(F.lit(1)).alias("stored"))
    return told.join(stored, "task_id").join(events.select("task_id", "detail"), "task_id")


@query(
    "process_one",
    with_views(
        """WITH u AS (SELECT count(*) AS features FROM (SELECT DISTINCT x0, y0, w, h FROM bld WHERE height IS NULL OR height > 0) k)
           SELECT 'layer' AS dataset_key, 'OK' AS status, features AS feature_count, 1 AS tile_count, features AS recorded, 'PROCESS_DONE' AS event, concat('tiles=1 features=', features) AS detail, true AS written_back FROM u""",
        "bld",
    ),
)
def process_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset through the processing job: table, record, event and the folder written back to its task."""
    rows = buildings(spark, sf_dir).select("id", "height", "source", "rings").withColumns({"row_id": F.monotonically_increasing_id(), "dataset": F.lit("layer")})
    table = spark.createDataFrame([("layer", "RUNNING", None, None, None, None, None)], "dataset_key string, status string, feature_count long, tile_count long, last_error string, finished_at string, updated_at string")
    job = spark.createDataFrame([("layer", "t")], "dataset_key string, task_id string")
    downloads = spark.createDataFrame([("t", None)], "task_id string, processed_3857_dir string")
    path = new_folder(spark, "processed")
    out = publish.process_one(stage(rows), "layer", table, path, job, downloads, height="height", target=10_000_000)
    told = record_members(out["record"], "dataset_key string, feature_count long, task_id string").withColumnRenamed("feature_count", "recorded")
    back = out["tasks"].select("task_id", (F.col("processed_3857_dir") == path).alias("written_back"))
    done = out["table"].select("dataset_key", "status", "feature_count", "tile_count").join(told, "dataset_key")
    return done.join(out["events"].select("dataset_key", "event", "detail"), "dataset_key").join(back, "task_id").drop("task_id")


@query(
    "locate_region",
    with_views(
        """SELECT i.continent, i.country, i.city, i.shp_name FROM idx i JOIN (SELECT max(country) AS country FROM idx WHERE city='City_1') m USING (country) WHERE city='City_1'""",
        "idx",
    ),
)
def locate_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the one region of a city's name in the last of the countries that have it."""
    listing = view(spark, sf_dir, "idx").select("continent", "country", "city", "shp_name")
    country = listing.filter("city = 'City_1'").agg(F.max("country")).first()[0]
    return index.locate_region(listing, "City_1", country=country)


@query(
    "cells_of_both",
    with_views(
        """
        WITH d AS (SELECT boundary_id, bx, bt, bx+4.8 AS ex, bt+4.8 AS et FROM bnd WHERE boundary_id IN (6, 7)),
        c AS (SELECT *, unnest(generate_series(CAST(floor((CAST(CAST(bx AS VARCHAR) AS DECIMAL(30,20))+180)*2) AS INT),
                                               CAST(ceil((CAST(CAST(ex AS VARCHAR) AS DECIMAL(30,20))+180)*2)-1 AS INT))) AS i FROM d),
        g AS (SELECT *, unnest(generate_series(CAST(floor((CAST(CAST(bt AS VARCHAR) AS DECIMAL(30,20))+90)*2) AS INT),
                                               CAST(ceil((CAST(CAST(et AS VARCHAR) AS DECIMAL(30,20))+90)*2)-1 AS INT))) AS j FROM c),
        m AS (SELECT * FROM g WHERE (i*0.5-180<=ex AND (i+1)*0.5-180>=bx AND j*0.5-90<=bt+2.0 AND (j+1)*0.5-90>=bt)
                                 OR (i*0.5-180<=bx+2.0 AND (i+1)*0.5-180>=bx AND j*0.5-90<=et AND (j+1)*0.5-90>=bt))
        SELECT printf('GBA_%03d_I%04d_J%04d', 50, i, j) AS grid_id FROM m GROUP BY i, j HAVING count(*) > 1""",
        "bnd",
    ),
)
def cells_of_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid cells that two neighbouring boundaries have in common."""
    return spatial.shared_cells(spatial.boundary_to_grid(boundaries(spark, sf_dir), 0.5), 6, 7)
