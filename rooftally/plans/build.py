"""Building a region: from landed features to one clean layer of a boundary."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.functions import geometry as geo
from rooftally.operators import index, quality, regions, spatial, tasks, tiling
from rooftally.session import lookup_join, stage
from rooftally.sources import sinks


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def tile_coverage(cells: DataFrame, ledger: DataFrame | None, files: DataFrame | None = None) -> dict[str, DataFrame]:
    """Valid records, pending cells and counts of the expected cells (one row per boundary)."""
    if ledger is None:
        valid = cells.select("grid_id", F.lit("COMPLETE").alias("status")).limit(0)
    else:
        # the newest record of a cell counts
        newest = ledger.groupBy("grid_id").agg(F.max_by(F.struct(*[c for c in ledger.columns if c != "grid_id"]), "finished_at").alias("r"))
        valid = tasks.valid_ledger(newest.select("grid_id", "r.*"), files)
    return {"valid": valid, "pending": tasks.pending_tiles(cells, valid), "progress": tasks.grid_progress(cells, valid, ["boundary_id"])}


def features_of_cells(features: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """Features with the id of every given cell their bounds meet; one on a seam belongs to several cells."""
    # closed bounds: a feature that ends on a grid line also meets the cell behind it
    i0 = F.floor((F.col("minx") + 180) / size).cast("int") - F.when((F.col("minx") + 180) % size == 0, 1).otherwise(0)
    j0 = F.floor((F.col("miny") + 90) / size).cast("int") - F.when((F.col("miny") + 90) % size == 0, 1).otherwise(0)
    i1, j1 = F.floor((F.col("maxx") + 180) / size).cast("int"), F.floor((F.col("maxy") + 90) / size).cast("int")
    spread = features.withColumn("grid_i", F.explode(F.sequence(i0, i1))).withColumn("grid_j", F.explode(F.sequence(j0, j1)))
    wanted = cells.select("grid_id", "grid_i", "grid_j").distinct()
    return lookup_join(spread, wanted, ["grid_i", "grid_j"]).withColumnRenamed("grid_id", "TILE_ID")


def merge_tiles(tiles: DataFrame, cells: DataFrame, boundary: DataFrame | None, buffer_m: float = 0.0) -> DataFrame:
    """Rows of the expected tiles, kept by representative point, first copy of every geometry (tile order)."""
    order = cells.select(F.col("grid_id").alias("TILE_ID"), "grid_i", "grid_j").distinct()
    rows = lookup_join(tiles, order, ["TILE_ID"])
    if boundary is not None:
        spot = geo.interior_point(F.col("rings"))
        placed = rows.filter(geo.has_geometry(F.col("rings"))).withColumn("_p", spot)
        placed = placed.withColumns({"rep_x": F.col("_p.x"), "rep_y": F.col("_p.y")}).drop("_p")
        one = boundary.select(F.lit(0).alias("_boundary"), "rings")
        rows = spatial.assign_with_buffer(placed, one, buffer_m, key="_boundary").drop("_boundary", "rep_x", "rep_y")
    return quality.dedup_geometry(rows, ["grid_i", "grid_j", "src_pos"]).drop("grid_i", "grid_j")


def build_region(
    features: DataFrame, boundary: DataFrame, out: str, size: float = 0.5, boundary_filter: bool = True, buffer_m: float = 0.0
) -> DataFrame:
    """Grid, pending cells, tiles with records, completeness, merge. Returns the merged layer.

    ``features``: raw properties, ``rings`` and ``src_pos`` (order of arrival); ``boundary``: ``boundary_id,
    rings``. Below ``out`` the folders tiles, ledger and merged are kept; a second run only works on cells
    without a valid record.
    """
    spark = features.sparkSession
    cells = stage(spatial.boundary_to_grid(boundary, size))
    ledger = read_ledger(spark, f"{out}/ledger")
    stored = sinks.tile_files(spark, f"{out}/tiles") if ledger is not None and _has_folder(spark, f"{out}/tiles") else None
    pending = stage(tile_coverage(cells, ledger, stored)["pending"])
    bounded = spatial.with_bounds(features.filter(geo.has_geometry(F.col("rings"))))
    fetched = features_of_cells(bounded, pending, size)
    rows = quality.normalize_columns(fetched, keep=["src_pos", "minx", "miny", "maxx", "maxy"])
    sinks.write_tiles(rows, pending, f"{out}/tiles", f"{out}/ledger")
    valid = tile_coverage(cells, read_ledger(spark, f"{out}/ledger"))["valid"]
    tasks.assert_no_missing(cells, valid)
    tiles = spark.read.parquet(f"{out}/tiles") if _has_folder(spark, f"{out}/tiles") else rows.limit(0)
    merged = merge_tiles(tiles, cells, boundary if boundary_filter else None, buffer_m)
    sinks.write_merged(merged, f"{out}/merged")
    return spark.read.parquet(f"{out}/merged")


def _has_folder(spark: SparkSession, path: str) -> bool:
    return read_ledger(spark, path) is not None


def build_bbox(features: DataFrame, rectangle: tuple[float, float, float, float]) -> DataFrame:
    """Features whose bounds meet a rectangle, in delivered columns."""
    bounded = spatial.with_bounds(features.filter(geo.has_geometry(F.col("rings"))))
    return quality.normalize_columns(spatial.scan_bbox(bounded, *rectangle))


def build_place(features: DataFrame, gazetteer: DataFrame, place: str, out: str, **options) -> DataFrame:
    """As ``build_region`` with the boundary a gazetteer (``query, rings``) has for the place."""
    boundary = gazetteer.filter(F.col("query") == place).select(F.lit(place).alias("boundary_id"), "rings")
    if not boundary.take(1):
        raise ValueError(f"the gazetteer does not know {place!r}")
    return build_region(features, boundary, out, **options)


def build_many(
    features: DataFrame, boundaries: DataFrame, tokens: DataFrame, summary: DataFrame, stamp: str, dry_run: bool = False,
    done: DataFrame | None = None, require_boundary: bool = True, out: str | None = None, options: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(layers, summary) of many regions in one job.

    ``tokens`` name provinces; ``boundaries`` are keyed by slug (``boundary_id``; ``boundary_file`` says where they came from); ``done`` lists slugs whose
    layer exists. States: FAILED without a boundary, SKIPPED, DRY_RUN, OK. All regions share one pass over the
    features, so they share its duration; duplicates are removed per region. With ``out`` the layers are written below it, one folder per
    region, and read back. The summary has the columns of ``schemas.RUN_SUMMARY``, with ``options`` (``grid_size``, ``page_size``, ``tile_format``, ``merge_format``).
    """
    started = time.time()
    aliases = regions.province_aliases(features.sparkSession)
    wanted = regions.resolve_alias(tokens, aliases).select("slug").distinct()
    known = boundaries.select(F.col("boundary_id").alias("slug"), F.lit(True).alias("_b")).distinct()
    state = wanted.join(known, "slug", "left")
    skip = F.lit(False)
    if done is not None:
        state = state.join(done.select("slug", F.lit(True).alias("_d")).distinct(), "slug", "left")
        skip = F.coalesce("_d", F.lit(False))
    missing = F.col("_b").isNull() & F.lit(require_boundary)
    state = stage(
        state.select(
            "slug",
            F.when(missing, "FAILED").when(skip, "SKIPPED").when(F.lit(dry_run), "DRY_RUN").otherwise("OK").alias("status"),
            F.when(missing, "missing-boundary").when(skip, "skip-existing-merge").otherwise("boundary").alias("mode"),
        )
    )
    chosen = boundaries.join(state.filter("status = 'OK'").select(F.col("slug").alias("boundary_id")), "boundary_id", "left_semi")
    spot = geo.interior_point(F.col("rings"))
    placed = features.filter(geo.has_geometry(F.col("rings"))).withColumn("_p", spot)
    placed = placed.withColumns({"rep_x": F.col("_p.x"), "rep_y": F.col("_p.y")}).drop("_p")
    inside = spatial.assign_to_boundary(placed, chosen).drop("rep_x", "rep_y")
    layers = quality.dedup_geometry(inside, ["src_pos"], within=["boundary_id"])
    ran = F.col("status") == "OK"
    if out is not None:
        layers = stage(layers)
        sinks.write_parts(layers, f"{out}/merged", ["boundary_id"])
        layers = features.sparkSession.read.schema(layers.schema).parquet(f"{out}/merged").select(layers.columns).join(
            state.filter(ran).select(F.col("slug").alias("boundary_id")), "boundary_id", "left_semi"
        )
    files = boundaries.groupBy(F.col("boundary_id").alias("province")).agg(
        (F.max("boundary_file") if "boundary_file" in boundaries.columns else F.lit("")).alias("boundary_file")
    )
    seconds = time.time() - started
    finished = F.date_format(F.to_timestamp(F.lit(stamp)) + F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)")), "yyyy-MM-dd'T'HH:mm:ss")
    made = {
        "exit_code": F.when(F.col("status") == "FAILED", "2").when(ran, "0").otherwise(""),
        "output_dir": F.lit(out or ""), "merge_output": F.when(F.lit(out is not None), F.concat(F.lit(f"{out}/merged/boundary_id="), "province")).otherwise(""),
        "started_at": F.lit(stamp), "finished_at": F.when(ran, finished).otherwise(F.lit(stamp)),
        "duration_seconds": F.when(ran, F.lit(str(int(seconds)))).otherwise("0"), "boundary_file": F.coalesce("boundary_file", F.lit("")),
    }
    made |= {name: F.lit((options or {}).get(name, "")) for name in ("grid_size", "page_size", "tile_format", "merge_format")}
    rows = state.select(F.col("slug").alias("province"), "mode", "status").join(files, "province", "left").withColumns(made)
    return layers, index.upsert_rows(summary, rows, ["province", "started_at"])


# --- processing -----------------------------------------------------------------------------------------------

def process_layer(
    df: DataFrame, row_id: str = "row_id", dataset: str = "dataset", height: str | None = None, srid: int = 4326, **limits
) -> tuple[DataFrame, DataFrame]:
    """(layer, report): chunks, valid geometry, non-empty, positive height, first copies per chunk, EPSG:3857.

    ``df`` holds whole layers in degrees with ``dataset``, a unique ``row_id`` (input order), ``rings`` and
    attributes. The report has one row per chunk. Duplicates are removed within a chunk, after invalid geometry.
    """
    scope = [dataset, "chunk_name"]
    name = height or quality.height_column(df.columns)
    # the layer and the report both start from the chunks with their validity, rectangles as their corners
    shaped = tiling.spatial_chunks(quality.flag_validity(df, "_ok"), row_id, dataset, packed=True, **limits)
    key = [*geo.CORNERS, "rings"]
    valid = shaped.filter("_ok").drop("_ok")
    clean = valid if name is None else valid.filter(~quality.non_positive(F.col(name)))
    unique = quality.dedup_geometry(clean, [row_id], key=key, within=scope)
    layer = quality.reproject(tiling.unpacked(unique), srid)
    return layer, process_report(shaped, scope, name, key)


def process_report(shaped: DataFrame, scope: list[str], height: str | None, key: list[str] | None = None) -> DataFrame:
    """Counts of every step per chunk, from one aggregation per distinct geometry (``key``, by default its rings) and one on top of it."""
    columns = key or ["rings"]
    flat = F.lit(False) if height is None else quality.non_positive(F.col(height))
    flagged = shaped.select(*scope, *columns, "_ok", (F.col("_ok") & flat).alias("_flat"))
    shapes = flagged.groupBy(*scope, F.xxhash64(*columns).alias("_h"), *columns).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_ok").alias("_valid"), F.count_if("_flat").alias("_flat")
    )
    kept = F.col("_valid") - F.col("_flat")
    return shapes.groupBy(*scope).agg(
        F.sum("_n").alias("input_count"), F.sum("_valid").alias("valid_count"), F.sum(F.col("_n") - F.col("_valid")).alias("invalid_count"),
        F.sum("_flat").alias("removed_zero_height_count"), F.sum(F.greatest(kept - 1, F.lit(0))).alias("removed_duplicate_count"),
        F.count_if(kept > 0).alias("output_count"),
    )

