"""Delivering layers, keeping the footprint index, and the jobs around the task tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import text
from rooftally.operators import index, quality, regions, reports, spatial, tasks
from rooftally.plans.build import process_layer
from rooftally.session import stage
from rooftally.sources import files, layers, sinks


# --- index ----------------------------------------------------------------------------------------------------

def index_rows(spark: SparkSession, root: str, regions: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """One box in EPSG:3857 per shapefile below ``root/continent/country/city``; NULL box for an empty file.

    With ``regions`` only files of those are opened, with ``known`` (an index) only files that it does not hold. A file without ``.prj`` is in degrees; one whose system is not recognised fails the job.
    """
    tree = files.scan_region_tree(spark, root).withColumn("path", F.regexp_replace("path", r"\.[^./\\]*$", ""))
    if regions is not None:
        tree = tree.join(regions.select(*index.REGION_KEY).distinct(), index.REGION_KEY, "left_semi")
    if known is not None:
        tree = tree.join(known.select(*index.INDEX_KEY), index.INDEX_KEY, "left_anti")
    chosen = None if regions is None and known is None else stage(tree.select("path").distinct())
    unknown = F.raise_error(F.concat(F.lit("coordinate system not recognised: "), "path")).cast("int")
    known_srid = F.when(F.col("prj_bytes").isNull(), F.lit(4326)).otherwise(F.coalesce("srid", unknown))
    systems = layers.read_shard_stats(spark, root, chosen).select("path", known_srid.alias("srid"))
    boxes = spatial.with_bounds(layers.read_shapefiles(spark, root, chosen=chosen)).groupBy("path").agg(
        *[F.min(c).alias(c) for c in ("minx", "miny")], *[F.max(c).alias(c) for c in ("maxx", "maxy")]
    )
    joined = tree.select("path", *index.INDEX_KEY).join(systems, "path", "left").join(boxes, "path", "left")
    from rooftally.functions import geometry as geo

    degrees = F.col("srid") == 4326
    metric = {
        "minx": F.when(degrees, geo.mercator_x(F.col("minx"))).otherwise(F.col("minx")),
        "miny": F.when(degrees, geo.mercator_y(F.col("miny"))).otherwise(F.col("miny")),
        "maxx": F.when(degrees, geo.mercator_x(F.col("maxx"))).otherwise(F.col("maxx")),
        "maxy": F.when(degrees, geo.mercator_y(F.col("maxy"))).otherwise(F.col("maxy")),
    }
    return index.with_bbox_wkt(joined.withColumns(metric).drop("path", "srid"))


def refresh_index(table: DataFrame, root: str, regions_to_refresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(index, counts): boxes of the given regions recomputed from their files and put in place of the old rows.

    A region without any shapefile is an error, not an empty region.
    """
    rows = stage(index_rows(table.sparkSession, root, regions_to_refresh))
    absent = regions_to_refresh.select(*index.REGION_KEY).distinct().join(rows.select(*index.REGION_KEY).distinct(), index.REGION_KEY, "left_anti").take(5)
    if absent:
        raise ValueError(f"no shapefile in {[tuple(r) for r in absent]}")
    counts = index.replace_counts(table, rows, regions_to_refresh)
    usable = rows.filter("minx is not null").select(*[c for c in table.columns if c in rows.columns])
    stamp = F.current_timestamp() if "updated_at" in table.columns else None
    return index.replace_region(table, usable, regions_to_refresh, stamp), counts


def index_new_regions(table: DataFrame, root: str, blocked_continents: list[str]) -> DataFrame:
    """Index plus the shards it does not hold yet, some continents left out."""
    tree = files.scan_region_tree(table.sparkSession, root)
    open_regions = tree.filter(~F.col("continent").isin(blocked_continents)) if blocked_continents else tree
    wanted = index_rows(table.sparkSession, root, open_regions, table).filter("minx is not null")
    return index.insert_if_absent(table, wanted.select(*[c for c in table.columns if c in wanted.columns]))


def export_tasks(table: DataFrame, path: str) -> DataFrame:
    """Task list of the index: distinct regions with one prefix each, as CSV."""
    rows = index.assert_unique(index.distinct_tasks(table), index.REGION_KEY, "prefixes of a task", allow_empty=False)
    listed = rows.withColumn("download_dir", text.plain_download_dir(*[F.col(c) for c in index.REGION_KEY]))
    sinks.write_task_csv(listed, path)
    return listed


def query_rectangle(
    table: DataFrame, features: DataFrame, rectangle: tuple[float, float, float, float], order: list[str], on: list[str] | None = None
) -> DataFrame:
    """Features that meet a rectangle, found through the index, first copies only."""
    return quality.dedup_geometry(index.export_rectangle(table, features, rectangle, on or index.INDEX_KEY), order)


# --- delivery -------------------------------------------------------------------------------------------------

def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")


def _assert_stored(expected: DataFrame, path: str, by: list[str]) -> None:
    """Every part that was counted lies in the written table with as many rows, and nothing else does."""
    found = sinks.stored_counts(expected.sparkSession, path, by)
    keys = [F.col(c).cast("string").alias(c) for c in by]
    both = expected.select(*keys, "n").join(found.select(*keys, "stored"), by, "full")
    if both.filter(~F.col("n").eqNullSafe(F.col("stored"))).take(1):
        raise ValueError(f"{path} does not hold the rows that were written")


def deliver(
    layer: DataFrame, order: list[str], job: DataFrame, tasks_table: DataFrame, path: str, max_features: int = fixed.VOLUME_MAX_FEATURES, queue: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(task table, completion record, processing queue): volumes written and read back, their names recorded, the task set to OK or OK_EMPTY.

    ``job`` is one row with ``task_id`` and what the record shall keep. A layer with features enters the processing queue, if one is given, with
    its volumes; an empty one leaves the queue as it is.
    """
    parts = stage(sinks.write_volumes(layer, order, path, max_features))
    _assert_stored(parts, path, ["part"])
    task = job.first()["task_id"]
    names = F.transform(F.array_sort(F.collect_list("part")), lambda part: F.concat(F.lit(f"{path}/part="), part.cast("string")))
    # one row, also without parts: a volume holds a million rows, so even a billion buildings have a thousand names
    totals = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("feature_count"), names.alias("shp_outputs")).withColumn("task_id", F.lit(task))
    made = job.drop("feature_count", "shp_outputs", "status", "finished_at", "runner_exit_code").join(totals, "task_id")
    status = F.when(F.col("feature_count") > 0, "OK").otherwise("OK_EMPTY")
    done = stage(made.withColumns({"status": status, "finished_at": _now(), "runner_exit_code": F.lit(0)}))
    record = sinks.completion_record(done, "task_id", fixed.DELIVERY_RECORD, [*fixed.TILE_RECORD, "merge_sha256"])
    kept = [c for c in ("merge_output", "boundary_source", "duration_seconds", "finished_at") if c in tasks_table.columns and c in done.columns]
    updates = done.select("task_id", "status", F.col("feature_count").cast("long").alias("feature_count"), *kept)
    table = tasks.apply_status(tasks_table, updates, "task_id", stamp=_now())
    if queue is not None:
        entered = done.filter("status = 'OK'").select(
            F.col("task_id").alias("dataset_key"), F.lit("PENDING").alias("status"), F.to_json("shp_outputs").alias("shp_files"),
            F.lit(None).cast("string").alias("source_fingerprint"), F.lit(None).cast("string").alias("source_updated_at"), F.col("finished_at").alias("download_finished_at"),
        )
        queue = tasks.upsert_source(queue, entered)
    return table, record, queue


def volume_numbers(tasks_table: DataFrame, layers_by_task: DataFrame, order: list[str], max_features: int = fixed.VOLUME_MAX_FEATURES) -> DataFrame:
    """Volume number of every row of the finished tasks' layers: ``task_id`` plus ``part`` counted per task.

    All tasks are cut in one pass: rows are numbered over all layers, and a task counts from its first row.
    """
    from rooftally.session import lookup_join, with_position

    finished = tasks_table.filter(F.col("status").isin(fixed.SUCCESS_STATUSES)).select("task_id")
    rows = layers_by_task.join(finished, "task_id", "left_semi")
    numbered = with_position(rows, "task_id", *order, name="_position")
    first = numbered.groupBy("task_id").agg(F.min("_position").alias("_first"))
    placed = lookup_join(numbered, stage(first), ["task_id"])
    return placed.withColumn("part", (F.floor((F.col("_position") - F.col("_first")) / max_features) + 1).cast("int")).drop("_position", "_first")


def backfill_volumes(
    tasks_table: DataFrame, layers_by_task: DataFrame, order: list[str], path: str, records: DataFrame | None = None, max_features: int = fixed.VOLUME_MAX_FEATURES
) -> tuple[DataFrame, DataFrame]:
    """(records, events) of the finished tasks with a layer: their volumes are written below ``path``, read back, and named in the records.

    ``records`` (``task_id`` and columns of the completion record) keep what else they hold; a task without one gets one of its names only.
    """
    numbered = stage(volume_numbers(tasks_table, layers_by_task, order, max_features).withColumn("task", F.col("task_id")))
    sinks.write_parts(numbered, path, ["task", "part"])
    counts = stage(numbered.groupBy("task", "part").agg(F.count(F.lit(1)).alias("n")))
    _assert_stored(counts, path, ["task", "part"])
    # the folder as Spark names it, with signs that no folder takes escaped
    folder = F.concat(F.lit(f"{path}/task="), F.col("task"), F.lit("/part="))
    names = F.transform(F.array_sort(F.collect_list("part")), lambda part: F.concat(F.first(folder), part.cast("string")))
    outputs = counts.groupBy("task").agg(names.alias("shp_outputs")).withColumnRenamed("task", "task_id")
    known = outputs if records is None else outputs.join(records.drop("shp_outputs"), "task_id", "left")
    events = outputs.select("task_id", F.lit("SHP_EXPORT").alias("event"), F.concat(F.lit("parts="), F.size("shp_outputs").cast("string")).alias("detail"), F.current_timestamp().alias("created_at"))
    kept = [c for c in (*fixed.DELIVERY_RECORD, *fixed.TILE_RECORD) if c in known.columns]
    return sinks.completion_record(known, "task_id", kept), events


# --- processing queue -----------------------------------------------------------------------------------------

def process_one(df: DataFrame, key: str, table: DataFrame, out: str, job: DataFrame | None = None, tasks_table: DataFrame | None = None, **limits) -> dict[str, DataFrame | None]:
    """One dataset processed, written by chunk, read back and recorded: ``table`` (processing table), ``report``, ``record``, ``events`` and ``tasks``.

    ``job`` is one row with what the record shall keep (``task_id``, ``process_name_prefix``, ``source_dir``...); the finished folder is written back to the row of
    ``tasks_table`` that its ``task_id`` names. A failure is a state with its message and an event, and leaves no record.
    """
    spark = df.sparkSession
    values = {"status": "OK", "feature_count": None, "tile_count": None, "last_error": None}
    report = record = None
    try:
        layer, report = process_layer(df, **limits)
        sinks.write_chunks(layer, out)
        report = stage(report)
        _assert_stored(report.filter("output_count > 0").select("chunk_name", F.col("output_count").alias("n")), out, ["chunk_name"])
        totals = report.agg(F.count(F.lit(1)).alias("tiles"), F.sum("output_count").alias("features")).first()
        if not totals["tiles"]:
            raise ValueError("no chunk was written")
        values |= {"feature_count": totals["features"], "tile_count": totals["tiles"]}
    except Exception as error:  # the queue goes on with the next dataset
        report = None
        values |= {"status": "FAILED", "last_error": str(error)}
    kinds = "dataset_key string, status string, feature_count long, tile_count long, last_error string"
    result = spark.createDataFrame([(key, *values.values())], kinds).withColumns({"finished_at": _now(), "output_dir": F.lit(out)})
    updates = result.select("dataset_key", "status", "feature_count", "tile_count", "last_error", *[c for c in ("finished_at",) if c in table.columns])
    done = tasks.apply_status(table, updates, "dataset_key", fixed.PROCESS_STATUSES, _now(), fixed.PROCESS_FIELDS)
    detail = F.concat(F.lit("tiles="), F.col("tile_count").cast("string"), F.lit(" features="), F.col("feature_count").cast("string"))
    events = result.select(
        "dataset_key", F.when(F.col("status") == "OK", "PROCESS_DONE").otherwise("PROCESS_FAILED").alias("event"), F.coalesce(detail, "last_error").alias("detail"), F.current_timestamp().alias("created_at")
    )
    if values["status"] == "OK":
        told = result if job is None else result.join(job.drop(*[c for c in result.columns if c in job.columns and c != "dataset_key"]), "dataset_key", "left")
        record = sinks.completion_record(told, "dataset_key", fixed.PROCESS_RECORD)
        if tasks_table is not None and job is not None:
            tasks_table = tasks.write_back_path(tasks_table, told.select("task_id", F.col("output_dir").alias("path")))
    return {"table": done, "report": report, "record": record, "events": events, "tasks": tasks_table}


def sync_processing(table: DataFrame, candidates: DataFrame, listing: DataFrame, manifest: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Processing table after a discovery: sources merged, prefixes and fingerprints attached, changed datasets
    waiting again, orphans waiting for download.

    ``candidates`` as for ``discover_sources`` plus ``download_finished_at``; ``listing``: files with ``path,
    size, mtime_ns``; ``manifest``: ``task_id, process_name_prefix``.
    """
    sources = tasks.discover_sources(candidates)
    sources = regions.prefix_lookup(sources, manifest)
    if tokens:
        sources = sources.filter(tasks.matches_filters(tokens, "dataset_key", "task_id", "directory", "display_name", "process_name_prefix"))
    stems = sources.select("dataset_key", F.explode("shp_files").alias("shp")).withColumn("stem", F.regexp_replace("shp", r"\.[^./\\]*$", ""))
    parts = listing.withColumn("stem", F.regexp_replace("path", r"\.[^./\\]*$", "")).join(stems.select("dataset_key", "stem"), "stem")
    marks = tasks.source_fingerprint(parts.filter(text.file_suffix(F.col("path")).isin([".shp", *fixed.SIDECAR_SUFFIXES])))
    newest = F.timestamp_micros((F.col("latest_mtime_ns") / 1000).cast("long")).cast("timestamp")
    marks = marks.withColumn("source_updated_at", F.date_format(newest, "yyyy-MM-dd'T'HH:mm:ss"))
    found = sources.join(marks, "dataset_key", "left").select(
        "dataset_key", "status", F.to_json("shp_files").alias("shp_files"), "source_fingerprint", "source_updated_at", "download_finished_at"
    )
    found = stage(found)
    merged = stage(tasks.upsert_source(table, found))
    return tasks.reconcile_orphans(merged, found, listing, tokens)


def sync_existing(tasks_table: DataFrame, datasets: DataFrame, country_keys: list[str], status: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(task table, unmatched folders): dataset folders recorded on the tasks of the same city name."""
    ordered = tasks.queue_order(tasks_table, name="order_no")
    matched = stage(regions.match_existing_datasets(datasets, ordered, country_keys))
    paths = matched.filter("task_id is not null").groupBy("task_id").agg(F.max("directory").alias("path"))
    table = tasks.write_back_path(tasks_table, paths, "existing_data_dir")
    if status:
        table = tasks.apply_status(table, paths.select("task_id", F.lit(status).alias("status")), "task_id")
    return table, matched.filter("task_id is null").select("directory")


# --- folders of layers ----------------------------------------------------------------------------------------

def clip_layers(layers_by_name: dict[str, tuple[DataFrame, int | None]], masks: DataFrame, out: str, mask_srid: int | None = None) -> dict[str, str]:
    """Clip every layer with the mask brought to its system; a failing layer is reported and the others go on."""
    result = {}
    for name, (layer, srid) in layers_by_name.items():
        try:
            mask = quality.to_srid(masks, mask_srid or 4326, srid or 4326)
            size = 0.25 if (srid or 4326) == 4326 else 25_000.0
            sinks.write_merged(spatial.clip(layer, mask, size=size), f"{out}/{name}")
            result[name] = "OK"
        except Exception as error:  # reported per layer
            result[name] = f"FAILED: {error}"
    return result


def scale_layers(layers_by_name: dict[str, DataFrame], factor: float, out: str, field: str = "HEIGHT") -> DataFrame:
    """Scale the heights of every layer; returns one report row per layer. No layer at all is an error."""
    if not layers_by_name:
        raise ValueError("no layer to scale")
    report = None
    for name, layer in layers_by_name.items():
        sinks.write_merged(quality.scale_height(layer, factor, field), f"{out}/{name}")
        row = quality.scale_report(layer, field).select(F.lit(name).alias("layer"), "*")
        report = row if report is None else report.unionByName(row)
    return report


def merge_parts(parts: list[DataFrame], components: DataFrame, path: str, limit: float = fixed.MERGE_LIMIT_BYTES) -> DataFrame:
    """Put ordered volumes of a dataset back together; at least two, and no component beyond the limit.

    The merged table is complete before the caller may drop the parts.
    """
    if len(parts) < 2:
        raise ValueError("merging needs at least two parts")
    refused = quality.size_guard(components, limit).filter(~F.col("accepted")).select("suffix").take(5)
    if refused:
        raise ValueError(f"the merged component would be too large: {[r['suffix'] for r in refused]}")
    merged = quality.merge_layers([(p, None) for p in parts])
    sinks.write_merged(merged, path)
    return parts[0].sparkSession.read.parquet(path)


# --- reports --------------------------------------------------------------------------------------------------

def download_report(tasks_table: DataFrame, names: DataFrame | None = None, limit: int = 10, offset: int = 0, keyword: str = "") -> dict[str, DataFrame]:
    """Counts, state, one page of the queue, newest finished and failed tasks."""
    table = tasks_table if names is None else tasks_table.join(names, "task_id", "left")
    columns = ("city", "city_zh") if "city_zh" in table.columns else ("city",)
    return {
        "counts": reports.status_counts(tasks_table), "state": reports.batch_state(tasks_table),
        "queue": tasks.queue_search_pages(table, keyword, columns, offset, limit),
        "recent": reports.recent_done(tasks_table, limit), "failed": reports.recent_failed(tasks_table, limit, at="finished_at"),
    }


def processing_report(table: DataFrame, events: DataFrame, limit: int = 10) -> dict[str, DataFrame]:
    """As the download report for the processing table, with the last merge event of datasets in parts."""
    merges = tasks.latest_event(events, list(fixed.MERGE_EVENT_STATES), fixed.MERGE_EVENT_STATES)
    errors = merges.filter("state = 'error'").select("dataset_key", F.col("state").alias("merge_state"), F.col("detail").alias("merge_error"))
    waiting = reports.listed(table, "PENDING", *tasks.queue_keys("queue_order", "dataset_key"))
    queue = waiting.withColumn("shp_count", text.json_list_size(F.col("shp_files"))).join(errors, "dataset_key", "left")
    several = F.col("shp_count") >= 2
    queue = queue.withColumns({c: F.when(several, F.col(c)) for c in ("merge_state", "merge_error")})
    return {
        "counts": reports.status_counts(table), "state": reports.batch_state(table), "queue": queue,
        "recent": reports.recent_done(table, limit, key="dataset_key", states=["OK"]),
        "blocked": reports.listed(table, "BLOCKED_NO_SHP", F.col("dataset_key")),
    }


def delivery_report(table: DataFrame, marks: DataFrame, copies: DataFrame, tasks_table: DataFrame, imports: DataFrame | None = None, jobs: DataFrame | None = None) -> dict[str, DataFrame]:
    rows = reports.attach_delivery(table, marks, copies, imports, jobs)
    at_hand = reports.available_keys(table, marks)
    return {"rows": rows, "counts": reports.delivery_counts(rows), "continents": reports.continent_stats(tasks_table, at_hand)}


def stamp_now() -> Column:
    """Second-precision ISO text of now, as the state tables keep it."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
