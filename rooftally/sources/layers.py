"""Vector layers: GeoJSON, shapefiles, well-known binary tables, administrative layers and the footprint index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally import schemas
from rooftally.functions import geometry as geo
from rooftally.functions import parts as multi
from rooftally.functions import text
from rooftally.functions.parts import parts_to_arrow, shells_with_holes
from rooftally.operators.quality import to_srid
from rooftally.sources.files import list_files, open_file


# --- GeoJSON --------------------------------------------------------------------------------------------------

def read_geojson_features(spark: SparkSession, path: str, lines: bool = False, properties: dict[str, str] | None = None) -> DataFrame:
    """One row per feature: ``feature_id, properties`` (map, or the given typed columns), ``geom_type, rings, parts, srid``.

    ``parts`` keeps what belongs together: each polygon's shell and holes; ``rings`` are all of them.

    Collections are read one document per task; with ``lines`` the input is one feature per line and splits
    freely. ``matched`` repeats the collection's total, which may exceed the features it holds.
    """
    if lines:
        rows = spark.read.schema(schemas.FEATURE).json(path).withColumn("matched", F.lit(None).cast("long"))
        features = rows.select("matched", F.struct("id", "properties", "geometry").alias("f"))
    else:
        documents = spark.read.schema(schemas.FEATURE_COLLECTION).json(path, multiLine=True)
        features = documents.select(F.col("numberMatched").alias("matched"), F.explode("features").alias("f"))
    flat = features.select("matched", F.col("f.id").alias("feature_id"), "f.properties", "f.geometry")
    parted = flat.withColumn("parts", multi.from_geojson(F.col("geometry.type"), F.col("geometry.coordinates")))
    shaped = parted.select(
        "feature_id", "properties", F.col("geometry.type").alias("geom_type"), multi.flat(F.col("parts")).alias("rings"), "parts",
        F.lit(4326).alias("srid"), "matched",
    )
    return shaped if properties is None else typed(shaped, "properties", properties)


def typed(df: DataFrame, attributes: str, columns: dict[str, str]) -> DataFrame:
    """Replace a map of texts by typed columns; unreadable values become NULL."""
    made = [F.try_element_at(attributes, F.lit(name)).try_cast(kind).alias(name) for name, kind in columns.items()]
    return df.select(*[c for c in df.columns if c != attributes], *made)


def read_boundary(spark: SparkSession, path: str, boundary_id: str = "boundary", srid: int | None = None) -> DataFrame:
    """Boundary polygons in degrees, a row per part: GeoJSON, or a Parquet table with ``wkb``, ``wkt``, ``parts`` or ``rings``."""
    if path.rstrip("/").endswith((".json", ".geojson")):
        rows = read_geojson_features(spark, path).select("parts")
    else:
        table = spark.read.parquet(path)
        readers = {"wkb": multi.from_wkb("wkb"), "wkt": multi.from_wkt(F.col("wkt")), "parts": F.col("parts"), "rings": multi.single(F.col("rings"))}
        rows = table.select(next(reader for name, reader in readers.items() if name in table.columns).alias("parts"))
    polygons = multi.polygon_rows(rows).filter(geo.has_geometry(F.col("rings")))
    return to_srid(polygons, srid or 4326, 4326).select(F.lit(boundary_id).alias("boundary_id"), "rings")


# --- tables ---------------------------------------------------------------------------------------------------

def read_footprint_index(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame:
    """The index from Parquet, or over JDBC with options that come from the caller."""
    return spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()


def load_admin_layer(spark: SparkSession, folder: str, level: int) -> DataFrame | None:
    """Administrative layer (``row_pos`` and name columns), None when it was not built."""
    try:
        return spark.read.parquet(f"{folder}/admin{level}")
    except AnalysisException:
        return None


# --- shapefiles -----------------------------------------------------------------------------------------------

SHAPE_KINDS = {1: "POINT", 11: "POINT", 21: "POINT", 3: "LINESTRING", 13: "LINESTRING", 23: "LINESTRING", 5: "POLYGON", 15: "POLYGON", 25: "POLYGON"}
SHAPE_SCHEMA = f"path string, record_no long, geom_type string, parts {multi.PARTS}, attributes map<string,string>"


def shard_table(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Shapefiles below ``root``: ``path`` (without suffix), ``records`` from the index size, size and own path of each component.

    Components belong together whatever the case of their suffix.
    """
    files = list_files(spark, root, pattern)
    parts = files.select(
        F.regexp_replace("path", r"\.[^./\\]*$", "").alias("path"), text.file_suffix(F.col("path")).alias("suffix"), "size", F.col("path").alias("file")
    )
    shards = parts.groupBy("path").agg(
        *[F.max(F.when(F.col("suffix") == s, F.col("size"))).alias(s[1:] + "_bytes") for s in (".shp", ".shx", ".dbf", ".prj")],
        *[F.max(F.when(F.col("suffix") == s, F.col("file"))).alias(s[1:] + "_path") for s in (".shp", ".shx", ".dbf")],
    )
    return shards.filter("shp_bytes is not null").withColumn("records", F.floor((F.col("shx_bytes") - 100) / 8))


def read_shard_stats(spark: SparkSession, root: str, chosen: DataFrame | None = None) -> DataFrame:
    """Record count and SRID per shapefile without reading it: index size and the short ``.prj`` text beside it.

    ``srid`` is NULL without a ``.prj`` (``prj_bytes`` is NULL then) and for a system that is not recognised.
    """
    shards = shard_table(spark, root)
    if chosen is not None:
        shards = shards.join(chosen.select("path"), "path", "left_semi")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][rR][jJ]").load(root)
    systems = found.select(F.regexp_replace("path", r"\.[^./\\]*$", "").alias("path"), F.col("content").cast("string").alias("value"))
    metric = F.col("value").rlike("(?i)3857|pseudo.?mercator|web.?mercator")
    degrees = F.col("value").rlike("(?i)^\\s*GEOGCS") | F.col("value").contains("4326")
    systems = systems.groupBy("path").agg(F.max(F.when(metric, 3857).when(degrees, 4326)).alias("srid"))
    return shards.withColumn("stem", text.file_name(F.col("path"))).join(systems, "path", "left")


def verify_output(stats: DataFrame) -> DataFrame:
    """One row: shards, features in total, and whether there are any, all readable and all in EPSG:3857."""
    totals = stats.agg(
        F.count(F.lit(1)).alias("shards"), F.coalesce(F.sum("records"), F.lit(0)).alias("features"),
        F.count_if(F.col("records").isNull()).alias("unreadable"), F.count_if(~F.col("srid").eqNullSafe(3857)).alias("other_srid"),
    )
    return totals.withColumn("ok", (F.col("shards") > 0) & (F.col("unreadable") == 0) & (F.col("other_srid") == 0))


def read_shapefiles(spark: SparkSession, root: str, pattern: str = "*", records_per_task: int = 20_000, chosen: DataFrame | None = None) -> DataFrame:
    """Features of all shapefiles below ``root``: ``path, record_no, geom_type, rings, parts, attributes``.

    With ``chosen`` (``path`` without suffix) only those are opened. Clockwise rings are shells, the others holes of the shell around them, so ``parts`` keeps what belongs together.

    Files are cut by record ranges (the ``.shx`` gives the byte range of each record, ``.dbf`` rows have a fixed
    length), so a large file is read by many tasks and none holds a whole file.
    """
    shards = shard_table(spark, root, pattern).filter("records > 0 AND shx_path IS NOT NULL")
    if chosen is not None:
        shards = shards.join(chosen.select("path"), "path", "left_semi")
    step = F.lit(records_per_task).cast("long")
    files = ["path", "shp_path", "shx_path", "dbf_path"]
    ranges = shards.select(*files, "records", F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1, step)).alias("first"))
    ranges = ranges.withColumn("last", F.least("records", F.col("first") + step)).drop("records")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = ranges.repartition(spread, "path", "first").mapInArrow(_read_ranges, SHAPE_SCHEMA)
    return read.select("path", "record_no", "geom_type", multi.flat(F.col("parts")).alias("rings"), "parts", "attributes")


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            kinds, shapes = _read_shapes(row["shx_path"], row["shp_path"], row["first"], row["last"])
            keep, attributes = _read_attributes(row["dbf_path"], row["first"], row["last"])
            numbers = np.arange(row["first"], row["last"])
            chosen = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["path"]] * len(chosen)), pa.array(numbers[chosen], pa.int64()),
                    pa.array([kinds[i] for i in chosen], pa.string()), parts_to_arrow([shapes[i] for i in chosen]),
                    pa.array([list(attributes[i].items()) for i in chosen], pa.map_(pa.string(), pa.string())),
                ],
                names=["path", "record_no", "geom_type", "parts", "attributes"],
            )


def _read_shapes(index_path: str, shape_path: str, first: int, last: int) -> tuple[list[str | None], list[list[list[np.ndarray]] | None]]:
    with open_file(index_path) as handle:
        index = np.frombuffer(handle.read_at((last - first) * 8, 100 + first * 8), ">i4").reshape(-1, 2).astype(np.int64) * 2
    start, stop = int(index[:, 0].min()), int((index[:, 0] + index[:, 1]).max()) + 8
    with open_file(shape_path) as handle:
        data = handle.read_at(stop - start, start)
    kinds, shapes = [], []
    for at in index[:, 0] - start + 8:
        kind = int(np.frombuffer(data, "<i4", 1, at)[0])
        name = SHAPE_KINDS.get(kind)
        if name is None:
            shape = None
        elif name == "POINT":
            shape = [[np.frombuffer(data, "<f8", 2, at + 4).reshape(1, 2)]]
        else:
            parts, points = np.frombuffer(data, "<i4", 2, at + 36)
            bounds = [*np.frombuffer(data, "<i4", parts, at + 44), points]
            flat = np.frombuffer(data, "<f8", 2 * points, at + 44 + 4 * parts).reshape(-1, 2)
            rings = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
            shape = shells_with_holes(rings) if name == "POLYGON" else [[line] for line in rings]
        kinds.append(name)
        shapes.append(shape)
    return kinds, shapes


def _read_attributes(path: str | None, first: int, last: int) -> tuple[np.ndarray, list[dict[str, str | None]]]:
    """(rows that are not marked deleted, texts per field) from the fixed-length table."""
    if path is None:
        return np.ones(last - first, bool), [{} for _ in range(first, last)]
    with open_file(path) as handle:
        head = handle.read_at(32, 0)
        head_length, row_length = (int(v) for v in np.frombuffer(head, "<u2", 2, 8))
        fields = handle.read_at(head_length - 32, 32)
        rows = np.frombuffer(handle.read_at((last - first) * row_length, head_length + first * row_length), "S1").reshape(-1, row_length)
    columns, at = [], 1
    for k in range(0, len(fields) - 31, 32):
        if fields[k] == 0x0D:
            break
        width = fields[k + 16]
        columns.append((fields[k : k + 11].split(b"\0")[0].decode("utf-8", "replace"), at, at + width))
        at += width

    def read(cell: bytes) -> str | None:
        try:
            value = cell.decode("utf-8")
        except UnicodeDecodeError:
            value = cell.decode("gbk", "replace")
        return value.strip(" \0") or None

    texts = {name: [read(bytes(c)) for c in np.ascontiguousarray(rows[:, a:b]).view(f"S{b - a}").ravel()] for name, a, b in columns if b > a}
    return rows[:, 0] != b"*", [{name: values[i] for name, values in texts.items()} for i in range(len(rows))]
