"""Streaming jobs: state tables, progress, staleness, incremental tiles. Checkpoints make every restart exact."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rooftally import schemas
from rooftally.operators import tasks
from rooftally.session import stage
from rooftally.sources import sinks
from rooftally.streaming import events


def read_event_stream(spark: SparkSession, path: str, schema: str = schemas.EVENTS, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of an append-only event folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def _start(writer, trigger: dict) -> StreamingQuery:
    return writer.trigger(**trigger).start()


def run_latest_state(
    stream: DataFrame, table_path: str, checkpoint: str, key: str = "dataset_key", buckets: int = 64, trigger: dict | None = None
) -> StreamingQuery:
    """Keep a table of the last event per key, in ``buckets`` folders by key.

    A micro-batch reads and rewrites only the folders of the keys it changed. Merging keeps the larger event id,
    so a batch that runs again after a failure gives the same rows.
    """

    def upsert(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        changed = stage(batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")))
        touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]  # at most ``buckets`` numbers
        try:
            old = spark.read.schema(changed.schema).parquet(table_path).filter(F.col("bucket").isin(touched))
        except AnalysisException:
            old = changed.limit(0)
        merged = stage(events.latest_state(old.unionByName(changed), key))
        sinks.write_parts(merged, table_path, ["bucket"])

    latest = events.latest_state(stream, key)
    writer = latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(upsert)
    return _start(writer, trigger or {"availableNow": True})


def read_latest_state(spark: SparkSession, table_path: str) -> DataFrame:
    """The table kept by ``run_latest_state``."""
    return spark.read.parquet(table_path).drop("bucket")


def read_progress(spark: SparkSession, table_path: str, key: str = "dataset_key") -> DataFrame:
    """The newest row of every log kept by ``run_stage_progress``: one aggregation, whose partial maxima are made in every map task."""
    versions = spark.read.parquet(table_path)
    others = [c for c in versions.columns if c != key]
    newest = versions.groupBy(key).agg(F.max(F.struct("version", *[c for c in others if c != "version"])).alias("_new"))
    return newest.select(key, "_new.*").drop("version")


def run_to_table(result: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append finished windows, sessions or first copies to a Parquet folder."""
    writer = result.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return _start(writer, trigger or {"availableNow": True})


#: Micro-batches after which the progress table is folded to one row per log.
FOLD_EVERY = 100


def run_stage_progress(lines: DataFrame, table_path: str, checkpoint: str, key: str = "dataset_key", trigger: dict | None = None) -> StreamingQuery:
    """Current stage per log, at most every five seconds: a micro-batch adds rows of the logs that it changed, no others.

    Every ``FOLD_EVERY`` batches the newest rows of all logs take the place of the versions before, so the table stays in proportion
    to the logs. A batch that runs again overwrites its own version.
    """

    def rewrite(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/version={number}")
        if number % FOLD_EVERY == FOLD_EVERY - 1:
            spark = batch.sparkSession
            whole = stage(read_progress(spark, table_path, key))
            older = [r[0] for r in spark.read.parquet(table_path).select("version").distinct().collect() if r[0] < number]  # at most FOLD_EVERY
            whole.write.mode("overwrite").parquet(f"{table_path}/version={number}")
            for version in older:
                batch.limit(0).write.mode("overwrite").parquet(f"{table_path}/version={version}")

    writer = events.stage_progress(lines, key).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(rewrite)
    return _start(writer, trigger or {"processingTime": "5 seconds"})


def run_incremental_tiles(stream: DataFrame, cells: DataFrame, tiles_path: str, ledger_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write arriving tiles (rows with ``TILE_ID``) of the expected cells, with their records.

    A micro-batch may bring any part of a tile: its new rows join those the tile holds already, and a newer record
    replaces the tile's older one. A row that the tile holds changes nothing, so a batch that runs again after a failure,
    or a tile that is delivered twice, gives the same rows. Rows of cells that are not expected are passed over.
    """

    def write(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        wanted = cells.select(F.col("grid_id").alias("TILE_ID")).distinct()
        arrived = stage(batch.join(wanted, "TILE_ID", "left_semi").dropDuplicates())
        touched = stage(arrived.select("TILE_ID").distinct())
        try:
            held = spark.read.schema(arrived.schema).parquet(tiles_path).select(arrived.columns).join(touched, "TILE_ID", "left_semi")
        except AnalysisException:  # nothing is written yet
            held = arrived.limit(0)
        held = stage(held)
        more = stage(arrived.exceptAll(held).select("TILE_ID").distinct())  # tiles that get a row they lack
        rows = arrived.unionByName(held).join(more, "TILE_ID", "left_semi").dropDuplicates()
        changed = cells.join(more.withColumnRenamed("TILE_ID", "grid_id"), "grid_id", "left_semi").dropDuplicates(["grid_id"])
        now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        sinks.write_tiles(rows, stage(changed), tiles_path, ledger_path, now)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _start(writer, trigger or {"availableNow": True})


def missing_after(cells: DataFrame, ledger: DataFrame) -> DataFrame:
    """Cells without a valid record when the stream has stopped."""
    return tasks.pending_tiles(cells, tasks.valid_ledger(ledger))
