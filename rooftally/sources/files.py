"""Listings of data folders, and control files: manifests, overrides, marks, records, logs, completion records."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rooftally import fixed_values as fixed
from rooftally import schemas
from rooftally.functions import text
from rooftally.operators.index import REGION_KEY, assert_unique
from rooftally.operators.regions import clean_overrides
from rooftally.session import has_at_most


# --- listings -------------------------------------------------------------------------------------------------

def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``path, name, size, modified`` of all files below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    found = reader.load(root).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return found.withColumn("name", text.file_name(F.col("path")))


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, whatever scheme prefix the file system adds."""
    bare = root.split(":", 1)[-1].strip("/")
    return F.regexp_replace(path, r"^[a-zA-Z0-9+.-]*:?/*" + _quoted(bare) + "/+", "")


def _quoted(value: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in value)


def scan_region_tree(spark: SparkSession, root: str, pattern: str = "*.shp") -> DataFrame:
    """Files under ``root/continent/country/city/…`` with those names and the file's stem as ``shp_name``."""
    files = list_files(spark, root, pattern).withColumn("_parts", F.split(relative_path(F.col("path"), root), "/"))
    part = {c: F.get("_parts", F.lit(i)) for i, c in enumerate(REGION_KEY)}
    named = files.filter(F.size("_parts") >= 4).withColumns(part)
    return named.withColumn("shp_name", text.file_stem(F.col("name"))).drop("_parts")


def list_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Folders that hold a dataset: ``directory, shp_files, has_gpkg, file_count, total_bytes``.

    Folders whose name (or a parent's name) starts with a dot or an underscore are skipped.
    """
    files = list_files(spark, root).withColumn("_rel", relative_path(F.col("path"), root))
    files = files.withColumn("directory", F.when(F.col("_rel").contains("/"), text.parent_folder(F.col("_rel"))).otherwise(F.lit("")))
    visible = files.filter(~F.exists(F.split("directory", "/"), lambda p: p.rlike("^[._]")))
    dataset = F.col("name").rlike(f"{fixed.DATASET_STEM_SUFFIX}.*\\.shp$")
    layer = F.col("name").rlike(f"{fixed.DATASET_STEM_SUFFIX}\\.gpkg$")
    folders = visible.groupBy("directory").agg(
        F.array_sort(F.collect_list(F.when(dataset, F.col("_rel")))).alias("shp_files"),
        F.max(layer).alias("has_gpkg"), F.count(F.lit(1)).alias("file_count"), F.sum("size").alias("total_bytes"),
    )
    return folders.filter((F.size("shp_files") > 0) | F.col("has_gpkg"))


def has_merged_data(tasks: DataFrame, datasets: DataFrame) -> DataFrame:
    """Tasks whose ``download_dir`` holds a merged layer."""
    whole = datasets.filter(
        F.col("has_gpkg") | F.exists("shp_files", lambda f: f.rlike(fixed.DATASET_STEM_SUFFIX + r"\.shp$"))
    )
    return tasks.join(whole.select(F.col("directory").alias("download_dir")), "download_dir", "left_semi")


def tree_size(files: DataFrame, by: list[str]) -> DataFrame:
    return files.groupBy(*by).agg(F.sum("size").alias("total_bytes"), F.count(F.lit(1)).alias("files"))


def component_bytes(files: DataFrame, by: list[str]) -> DataFrame:
    """Bytes per component suffix."""
    return tree_size(files.withColumn("suffix", text.file_suffix(F.col("path"))), [*by, "suffix"])


def open_file(path: str):
    """Random-access file handle for a path as Spark lists it (local or any store Arrow knows)."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return fs.LocalFileSystem().open_input_file(path)


@F.arrow_udf(T.StringType())
def file_sha256(paths: pa.Array) -> pa.Array:
    """Digest of each file, read in pieces of one megabyte."""

    def digest(path: str) -> str:
        running = hashlib.sha256()
        with open_file(path) as handle:
            while piece := handle.read(1 << 20):
                running.update(piece)
        return running.hexdigest()

    return pa.array([digest(p.as_py()) for p in paths], pa.string())


def file_checksums(files: DataFrame) -> DataFrame:
    """Listing with ``sha256``; the files are spread over all tasks first, as one row is much work."""
    spread = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(spread, "path").withColumn("sha256", file_sha256("path"))


# --- control files --------------------------------------------------------------------------------------------

def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, all text, UTF-8 (with or without mark) or GBK; ``row_no`` counts from 2 as in the file.

    The file is split byte by byte (Latin-1), which is safe because the second byte of a GBK character is never a
    comma, quote or line end; then all cells are read as UTF-8 if every one of them is valid, else as GBK.
    """
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    raw = reader.option("encoding", "ISO-8859-1").csv(path)
    names = [c.encode("latin-1") for c in raw.columns]
    cells = raw.select(*[F.encode(f"`{c}`", "ISO-8859-1").alias(f"_{i}") for i, c in enumerate(raw.columns)])
    # a control file is one partition, so the running id counts its rows
    cells = cells.withColumn("row_no", F.monotonically_increasing_id() + 2)
    columns = [f"_{i}" for i in range(len(names))]

    def has_any(test: list[Column]) -> bool:
        broken = F.lit(False)
        for column in test:
            broken = broken | F.coalesce(column, F.lit(False))
        return not has_at_most(cells.filter(broken), 0)

    if has_any([~F.is_valid_utf8(F.col(c).cast("string")) for c in columns]):
        if has_any([decode_gbk(c).contains("\ufffd") for c in columns]):
            raise ValueError(f"{path} is neither UTF-8 nor GBK")
        made, header = [decode_gbk(c) for c in columns], [n.decode("gbk") for n in names]
    else:
        made, header = [F.col(c).cast("string") for c in columns], [n.decode("utf-8-sig") for n in names]
    return cells.select("row_no", *[m.alias(h) for m, h in zip(made, header)])


def read_task_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Task manifest: names with single blanks, blank rows left out, ``manifest_order`` from 0.

    Missing columns or values, repeated tasks and an empty file are errors.
    """
    raw = _read_csv(spark, path)
    required = ["continent", "country", "city", "download_dir"]
    missing = [c for c in required if c not in raw.columns]
    if missing:
        raise ValueError(f"the manifest lacks the columns {missing}")
    optional = [c for c in ("process_name_prefix",) if c in raw.columns]
    rows = raw.select("row_no", *[text.collapse_spaces(F.col(c)).alias(c) for c in (*required, *optional)])
    blank = F.concat(*required) == ""
    rows = rows.filter(~blank)
    gaps = rows.filter(F.exists(F.array(*required), lambda v: v == "")).select("row_no").take(1)
    if gaps:
        raise ValueError(f"row {gaps[0]['row_no']} of the manifest lacks a value")
    rows = rows.withColumns(
        {"download_dir": text.normalize_download_dir(F.col("download_dir")), "task_id": text.task_id(*[F.col(c) for c in REGION_KEY])}
    )
    checked = assert_unique(rows, ["task_id"], "tasks of the manifest", allow_empty=False)
    from rooftally.session import with_position

    return with_position(checked, "row_no", name="_position").withColumn("manifest_order", F.col("_position") - 1).drop("_position")


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    raw = _read_csv(spark, path).withColumnRenamed("row_no", "pos")
    for column in ("continent", "country", "city", "kind", "value", "note"):
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(""))
    return clean_overrides(raw)


def _records(spark: SparkSession, path: str, record: str, wrapper: str | None) -> DataFrame:
    """``dataset_key, r`` of a JSON map of objects; entries of another type are left out."""
    if wrapper:
        table = spark.read.schema(f"{wrapper} map<string,string>").json(path, multiLine=True).select(F.explode(wrapper))
    else:
        whole = spark.read.text(path, wholetext=True)
        table = whole.select(F.explode(F.from_json("value", "map<string,string>")))
    objects = table.filter(F.trim("value").startswith("{"))
    return objects.select(F.col("key").alias("dataset_key"), F.from_json("value", record).alias("r"))


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """Delivery marks: ``dataset_key, updated, updated_at, note`` texts whole."""
    rows = _records(spark, path, schemas.MARK, "rows")
    return rows.select(
        "dataset_key", F.coalesce("r.updated", F.lit(False)).alias("updated"),
        F.coalesce("r.updated_at", F.lit("")).alias("updated_at"),
        F.coalesce("r.note", F.lit("")).alias("note"),
    )


def read_copy_records(spark: SparkSession, path: str) -> DataFrame:
    return _records(spark, path, schemas.COPY_RECORD, "rows").select("dataset_key", "r.*")


def read_import_records(spark: SparkSession, path: str) -> DataFrame:
    return _records(spark, path, schemas.IMPORT_RECORD, None).select("dataset_key", "r.*")


def read_completion_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All ``<cell>.done.json`` records; ``grid_id`` is the file's cell, ``record_id`` what the record says."""
    reader = spark.read.schema(schemas.TILE_LEDGER).option("multiLine", "true").option("mode", "DROPMALFORMED")
    records = reader.option("pathGlobFilter", "*.done.json").option("recursiveFileLookup", "true").json(folder)
    cell = F.regexp_replace(text.file_name(F.col("_metadata.file_path")), r"\.done\.json$", "")
    return records.withColumn("record_id", F.col("grid_id")).withColumn("grid_id", cell)


# --- log lines ------------------------------------------------------------------------------------------------

@F.arrow_udf(T.StringType())
def decode_gbk(lines: pa.Array) -> pa.Array:
    return pa.array([None if v is None else v.decode("gbk", errors="replace") for v in lines.to_pylist()], pa.string())


def decode_text(raw: Column) -> Column:
    """Bytes read as text: valid UTF-8 stays, anything else is taken as GBK with replacement."""
    valid = F.is_valid_utf8(raw)
    return F.when(valid, raw).otherwise(decode_gbk(F.when(~valid, raw.cast("binary"))))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, line_no, line`` of log files; large files are read by several tasks.

    ``line_no`` is a struct (start of the file block, number in it): it orders the lines of a file.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    raw = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), nth.alias("nth")).alias("line_no"), "value",
    )
    return raw.select("path", "line_no", decode_text(F.col("value")).alias("line"))
