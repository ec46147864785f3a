"""Writers. Tables are Parquet; a table that is read and written in one job goes through the shared folder first."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.operators import tiling
from rooftally.session import has_at_most, stage
from rooftally.sources.files import file_checksums, list_files


def write_parts(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """One folder per value of ``by``; only the folders that occur are replaced.

    ``rebalance`` lets adaptive execution put small folders together in one task and cut a huge one into several
    files, whatever its share of the rows.
    """
    writer = df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def write_tiles(rows: DataFrame, cells: DataFrame, path: str, ledger_path: str, finished_at: Column | None = None) -> DataFrame:
    """Write fetched rows per grid cell (``TILE_ID``) and a completion record for every cell of ``cells``.

    The record says EMPTY or COMPLETE with its row count and its files (size and digest); it is written only
    after the stored rows were counted again and agree. Returns the new records.
    """
    spark = rows.sparkSession
    kept = stage(rows)
    write_parts(kept, path, ["TILE_ID"])
    wanted = stage(kept.groupBy("TILE_ID").agg(F.count(F.lit(1)).alias("n")))
    if has_at_most(wanted, 0):
        files = spark.createDataFrame([], "grid_id string, files map<string,struct<size:long,sha256:string>>")
    else:
        stored = spark.read.parquet(path).groupBy("TILE_ID").agg(F.count(F.lit(1)).alias("stored"))
        differing = wanted.join(stored, "TILE_ID", "left").filter(~F.col("n").eqNullSafe(F.col("stored")))
        if not has_at_most(differing, 0):
            raise RuntimeError("stored tiles do not hold the rows that were written")
        written = tile_files(spark, path).join(wanted.select(F.col("TILE_ID").alias("grid_id")), "grid_id", "left_semi")
        files = written.groupBy("grid_id").agg(
            F.map_from_entries(F.collect_list(F.struct("name", F.struct("size", "sha256")))).alias("files")
        )
    records = cells.select("grid_id", F.array("minx", "miny", "maxx", "maxy").alias("bbox")).join(
        wanted.withColumnRenamed("TILE_ID", "grid_id"), "grid_id", "left"
    ).join(files, "grid_id", "left")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss") if finished_at is None else finished_at
    records = records.select(
        "grid_id", F.col("grid_id").alias("record_id"), F.when(F.col("n") > 0, "COMPLETE").otherwise("EMPTY").alias("status"),
        F.coalesce("n", F.lit(0)).cast("long").alias("feature_count"), F.lit(fixed.DATA_SEMANTICS).alias("data_semantics_version"),
        F.lit(fixed.GRID_ALGORITHM).alias("grid_algorithm"), "bbox", F.lit("EPSG:4326").alias("crs"), "files",
        stamp.alias("finished_at"),
    )
    records = stage(records)
    records.write.mode("append").parquet(ledger_path)
    return records


def tile_files(spark: SparkSession, path: str) -> DataFrame:
    """Stored files per cell with size and digest, for the comparison with completion records."""
    files = file_checksums(list_files(spark, path, "*.parquet"))
    return files.select(F.regexp_extract("path", r"TILE_ID=([^/]+)/", 1).alias("grid_id"), "name", "size", "sha256")


def write_merged(df: DataFrame, path: str) -> None:
    """Single layer; an empty input leaves an empty table with its columns."""
    df.write.mode("overwrite").parquet(path)


def write_volumes(df: DataFrame, order: list[str], path: str, max_features: int = fixed.VOLUME_MAX_FEATURES) -> DataFrame:
    """Cut into volumes of at most ``max_features`` rows in input order; returns ``part, n, suffix``.

    ``suffix`` is empty for a single volume, else ``_part<k>``.
    """
    numbered = stage(tiling.volumes(df, order, max_features))
    write_parts(numbered, path, ["part"])
    parts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    last = parts.agg(F.max("part")).first()[0] or 0
    suffix = F.concat(F.lit("_part"), F.col("part").cast("string")) if last > 1 else F.lit("")
    return parts.withColumn("suffix", suffix)


def write_chunks(df: DataFrame, path: str) -> None:
    write_parts(df, path, ["chunk_name"])


def write_documents(documents: DataFrame, path: str) -> None:
    """Text files with one JSON document per line."""
    documents.select("document").write.mode("overwrite").text(path)


def write_task_csv(tasks: DataFrame, path: str) -> None:
    """Task list as CSV with header, ordered by its names."""
    names = ["continent", "country", "city", "download_dir", "process_name_prefix"]
    ordered = tasks.select(*names).orderBy("continent", "country", "city")
    ordered.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def completion_record(jobs: DataFrame, key: str, members: list[str] | None = None, more: list[str] | None = None) -> DataFrame:
    """``key, record``: each row as one JSON object, NULL members included.

    ``members`` are what the record always has, in their order, NULL where ``jobs`` has no such column; ``more`` are added
    only where ``jobs`` has them.
    """
    if members is None:
        fields = [F.col(c) for c in jobs.columns]
    else:
        fields = [F.col(c) if c in jobs.columns else F.lit(None).cast("string").alias(c) for c in members]
        fields += [F.col(c) for c in more or [] if c in jobs.columns]
    return jobs.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"))


def stored_counts(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows per value of the partition columns of a written table, read back; an empty table has no folder to read."""
    try:
        return spark.read.parquet(path).groupBy(*columns).agg(F.count(F.lit(1)).alias("stored"))
    except AnalysisException:
        return spark.createDataFrame([], ", ".join([*(f"{c} string" for c in columns), "stored long"]))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a table with rows that may have been read from it."""
    stage(df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def create_index_table(spark: SparkSession, name: str = "footprint_index") -> None:
    """Create the footprint index if it is absent; its key is checked on every write, boxes prune by min/max."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (shp_name STRING, minx DOUBLE, miny DOUBLE, maxx DOUBLE, maxy DOUBLE, srid INT,
        updated_at TIMESTAMP, city STRING, continent STRING, country STRING) USING parquet PARTITIONED BY (continent, country)"""
    )


def grid_manifest(grid: DataFrame, boundary: DataFrame, size: float, source: str | None = None) -> DataFrame:
    """One row: versions, size, origin, digest of the boundary, expected count and the ordered cell ids.

    The ids of one region are a few thousand at most (the whole world has 259 200 cells of half a degree).
    """
    from rooftally.functions import kernels

    ids = grid.agg(
        F.count(F.lit(1)).alias("expected_tile_count"),
        F.transform(F.array_sort(F.collect_list(F.struct("grid_i", "grid_j", "grid_id"))), lambda c: c["grid_id"]).alias("grid_ids"),
    )
    shapes = boundary.select(F.hex(kernels.as_wkb("rings")).alias("wkb"))
    digest = shapes.agg(F.sha2(F.concat_ws("", F.array_sort(F.collect_list("wkb"))), 256).alias("boundary_sha256")).first()[0]
    return ids.select(
        F.lit(fixed.GRID_ALGORITHM).alias("grid_algorithm"), F.lit(fixed.DATA_SEMANTICS).alias("data_semantics_version"),
        F.lit(float(size)).alias("grid_size"), F.array(F.lit(-180.0), F.lit(-90.0)).alias("origin"), F.lit(source).alias("boundary_source"),
        F.lit(digest).alias("boundary_sha256"), "expected_tile_count", "grid_ids",
    )


__all__ = [
    "completion_record", "create_index_table", "grid_manifest", "replace_table", "stored_counts", "tile_files", "write_chunks",
    "write_documents", "write_merged", "write_parts", "write_task_csv", "write_tiles", "write_volumes",
]
