"""Status, delivery and coverage reports on task, event, mark and copy tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import geometry as geo
from rooftally.functions import text
from rooftally.session import lookup_join


# --- counts ---------------------------------------------------------------------------------------------------

def status_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.count(F.lit(1)).alias("total"))


def batch_state(tasks: DataFrame) -> DataFrame:
    """One row: total and running / stopped / done (no state for an empty table)."""
    totals = tasks.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "RUNNING").alias("running"),
        F.count_if(F.col("status") == "PENDING").alias("pending"),
    )
    state = F.when(F.col("running") > 0, "running").when(F.col("pending") > 0, "stopped").when(F.col("total") > 0, "done")
    return totals.withColumn("batch_state", state)


def available_keys(processing: DataFrame, marks: DataFrame) -> DataFrame:
    """Datasets whose buildings are at hand: processed, or marked as delivered."""
    done = processing.filter(F.col("status") == "OK").select("dataset_key")
    return done.union(marks.filter("updated").select("dataset_key")).distinct()


def with_availability(tasks: DataFrame, available: DataFrame) -> DataFrame:
    keys = available.select(F.col("dataset_key").alias("task_id"), F.lit(True).alias("available"))
    return lookup_join(tasks, keys, ["task_id"], "left").withColumn("available", F.coalesce("available", F.lit(False)))


def continent_stats(tasks: DataFrame, available: DataFrame) -> DataFrame:
    """Per continent label: total, downloaded, not downloaded (waiting and not available) and other."""
    marked = with_availability(tasks, available)
    done = F.col("available") | F.col("status").isin(fixed.SUCCESS_STATUSES)
    waiting = ~done & (F.col("status") == "PENDING")
    return marked.groupBy(text.continent_label(F.col("continent")).alias("continent")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("downloaded"),
        F.count_if(waiting).alias("not_downloaded"), F.count_if(~done & ~waiting).alias("other"),
    )


def not_downloaded(tasks: DataFrame, available: DataFrame, continent: str | None = None) -> DataFrame:
    """Waiting tasks without data, with the keys their list is sorted by."""
    waiting = tasks.filter(F.col("status") == "PENDING")
    if continent is not None:
        waiting = waiting.filter(text.continent_label(F.col("continent")) == continent)
    missing = waiting.join(available.select(F.col("dataset_key").alias("task_id")), "task_id", "left_anti")
    return missing.withColumns(not_downloaded_keys())


def not_downloaded_keys() -> dict[str, Column]:
    status = F.col("status")
    priority = F.when(status == "RUNNING", 0).when(status == "PENDING", 1).when(status == "FAILED", 2).when(status == "SKIPPED", 3)
    return {
        "sort_status": priority.otherwise(9),
        "sort_queue": F.coalesce("queue_order", F.lit(fixed.MISSING_ORDER)),
        "sort_manifest": F.coalesce("manifest_order", F.lit(fixed.MISSING_ORDER)),
    }


def completed(tasks: DataFrame, available: DataFrame, continent: str | None = None) -> DataFrame:
    """Finished tasks and those whose data is at hand, with ``completed_at``."""
    marked = with_availability(tasks, available).filter(F.col("available") | F.col("status").isin(fixed.SUCCESS_STATUSES))
    if continent is not None:
        marked = marked.filter(text.continent_label(F.col("continent")) == continent)
    updated = F.col("updated_at") if "updated_at" in tasks.columns else F.lit(None).cast("string")
    return marked.withColumn("completed_at", text.completion_time(F.col("finished_at").cast("string"), updated.cast("string"))).drop("available")


# --- lists ----------------------------------------------------------------------------------------------------

def recent_done(tasks: DataFrame, limit: int = 10, offset: int = 0, key: str = "task_id", states: list[str] | None = None) -> DataFrame:
    """Newest finished rows, a page of them (top-k, no full sort)."""
    done = tasks.filter(F.col("status").isin(states or fixed.SUCCESS_STATUSES))
    return done.orderBy(F.col("finished_at").desc_nulls_last(), F.col(key).desc()).offset(offset).limit(limit)


def recent_failed(tasks: DataFrame, k: int = 10, at: str = "updated_at", key: str = "task_id") -> DataFrame:
    """Newest failed rows with their whole error; the key breaks ties."""
    failed = tasks.filter(F.col("status") == "FAILED").orderBy(F.col(at).desc_nulls_last(), F.col(key)).limit(k)
    return failed.withColumn("last_error", F.coalesce("last_error", F.lit("")))


def listed(tasks: DataFrame, status: str, *order: Column, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows of one state in an order: all of them, or the page that ``limit`` and ``offset`` name."""
    rows = tasks.filter(F.col("status") == status).orderBy(*order)
    rows = rows.offset(offset) if offset else rows
    return rows if limit is None else rows.limit(limit)


# --- progress -------------------------------------------------------------------------------------------------

def seconds_since(started: Column, now: Column) -> Column:
    """Whole seconds from a time to ``now``, never negative, NULL when the time cannot be read."""
    at = started.try_cast("timestamp")
    seconds = F.floor((F.unix_micros(now) - F.unix_micros(at)) / 1_000_000).cast("long")
    return F.when(at.isNotNull(), F.greatest(F.lit(0).cast("long"), seconds))


def progress_columns(done: Column, total: Column, elapsed: Column, updated_age: Column, stale_minutes: float = 10) -> dict[str, Column]:
    """Share done, remaining seconds (only while something but not all is done) and the stale flag."""
    share = F.when(total > 0, F.least(done / total, F.lit(1.0)))
    eta = F.when((done > 0) & (total > done) & elapsed.isNotNull(), F.floor(elapsed / done * (total - done)).cast("long"))
    return {"progress": share, "eta_seconds": eta, "stale": F.coalesce(updated_age > stale_minutes * 60, F.lit(False))}


# --- delivery -------------------------------------------------------------------------------------------------

def copy_state(job: Column, record: Column, has_record: Column, updated: Column, shards: Column) -> Column:
    """State of a dataset in the shared folder.

    A running job decides first; then a finished record, a delivered dataset, a failed record; a record that
    says ``copying`` without a job was interrupted; else shards that remain mean it was not copied.
    """
    from_job = F.when(job == "done", "done").when(job == "error", "error").otherwise("copying")
    return (
        F.when(job.isNotNull(), from_job)
        .when(has_record & (record == "done"), "done")
        .when(updated, "done")
        .when(has_record & record.isin("error", "copying"), "error")
        .when(shards > 0, "not_copied")
        .otherwise("unknown")
    )


def copy_error(job_error: Column, job: Column, record: Column, record_error: Column, updated: Column) -> Column:
    interrupted = F.when(record == "copying", fixed.INTERRUPTED_COPY).when(record == "error", record_error)
    return F.when(job.isNotNull(), job_error).when(~updated, interrupted)


def attach_delivery(processing: DataFrame, marks: DataFrame, copies: DataFrame, imports: DataFrame | None = None, jobs: DataFrame | None = None) -> DataFrame:
    """Finished datasets with mark, copy state, import counts and continent label.

    ``processing`` needs ``dataset_key, status, shards``; every other side has one row per ``dataset_key``.
    """
    rows = processing.filter(F.col("status") == "OK")
    rows = rows.join(marks.select("dataset_key", "updated", F.col("updated_at").alias("marked_at"), F.col("note").alias("mark_note")), "dataset_key", "left")
    rows = rows.join(copies.select("dataset_key", F.col("state").alias("_state"), "copied", "total", F.lit(True).alias("_rec")), "dataset_key", "left")
    if jobs is not None:
        rows = rows.join(jobs.select("dataset_key", F.col("state").alias("_job")), "dataset_key", "left")
    else:
        rows = rows.withColumn("_job", F.lit(None).cast("string"))
    if imports is not None:
        kept = imports.select("dataset_key", "deleted", "inserted", "skipped", F.col("state").alias("import_state"))
        rows = rows.join(kept, "dataset_key", "left")
    updated = F.coalesce("updated", F.lit(False))
    state = copy_state(F.col("_job"), F.col("_state"), F.coalesce("_rec", F.lit(False)), updated, F.col("shards"))
    first = F.split_part("dataset_key", F.lit("|"), F.lit(1))
    label = F.when(F.upper(first) == "EXT", fixed.EXTERNAL_CONTINENT).otherwise(text.continent_label(first))
    # a delivered dataset without a usable record shows no copied files
    plain = F.col("_job").isNull() & ((F.col("_state") != "done") | F.col("_state").isNull()) & updated
    return rows.withColumns(
        {
            "updated": updated, "marked_at": F.coalesce("marked_at", F.lit("")), "mark_note": F.coalesce("mark_note", F.lit("")),
            "copy_state": state, "continent_label": label,
            "copied": F.when(plain, 0).otherwise(F.coalesce("copied", F.lit(0))),
            "total": F.when(plain, 0).when(state == "not_copied", F.col("shards")).otherwise(F.coalesce("total", F.lit(0))),
        }
    ).drop("_state", "_rec", "_job")


def delivery_counts(rows: DataFrame) -> DataFrame:
    """One row: total, updated, pending and a count for every copy state (0 when it does not occur)."""
    states = [F.count_if(F.col("copy_state") == s).alias("copy_" + s) for s in fixed.COPY_STATES]
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("updated").alias("updated"), F.count_if(~F.col("updated")).alias("pending"), *states
    )


def import_summary(lines: DataFrame, key: str = "dataset_key", line: str = "line", line_no: str = "line_no") -> DataFrame:
    """Counts of the last import per log: of its last marker line, else of the first line that has them in words."""
    marker = text.import_marker_json(F.col(line))
    words = text.import_counts(F.col(line))
    found = lines.select(key, line_no, marker.alias("m"), words.alias("w"))
    best = found.groupBy(key).agg(
        F.max(F.when(F.col("m").isNotNull(), F.struct(line_no, "m"))).alias("m"),
        F.min(F.when(F.col("w").isNotNull(), F.struct(line_no, "w"))).alias("w"),
    )
    answer = F.coalesce(F.col("m.m"), F.col("w.w"))
    return best.select(key, answer["deleted"].alias("deleted"), answer["inserted"].alias("inserted"), answer["skipped"].alias("skipped"))


def stage_progress(lines: DataFrame, key: str = "dataset_key", line: str = "line", line_no: str = "line_no") -> DataFrame:
    """Per log: last announced stage with its line, and the tiles announced so far."""
    read = lines.select(key, line_no, F.col(line).alias("line"), text.parse_stage(F.col(line)).alias("stage"), text.added_tiles(F.col(line)).alias("tiles"))
    return read.filter("stage is not null").groupBy(key).agg(
        F.max(F.struct(line_no, "stage", "line")).alias("last"), F.sum("tiles").alias("tiles_total")
    ).select(key, F.col("last.stage").alias("stage"), F.col("last.line").alias("stage_detail"), "tiles_total")


# --- coverage -------------------------------------------------------------------------------------------------

def overlap_report(
    features: DataFrame, rectangle: tuple[float, float, float, float], boundary: Column, existing: Column, key: list[str]
) -> DataFrame:
    """One row on the features that meet a rectangle: raw and duplicate rows, inside / outside a boundary,
    crossing the rectangle's edge, already exported, and the coverage in per cent.

    ``boundary`` and ``existing`` are conditions on a feature; ``key`` is its exact geometry.
    """
    minx, miny, maxx, maxy = rectangle
    crosses = (F.col("minx") < minx) | (F.col("miny") < miny) | (F.col("maxx") > maxx) | (F.col("maxy") > maxy)
    flagged = features.select(*key, boundary.alias("_b"), crosses.alias("_c"), existing.alias("_e"))
    shapes = flagged.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_b").alias("_b"), F.max("_c").alias("_c"), F.max("_e").alias("_e")
    )
    total = shapes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_count"), F.count(F.lit(1)).alias("unique_count"),
        F.count_if("_b").alias("inside_count"), F.count_if("_c").alias("crossing_count"), F.count_if("_e").alias("existing_count"),
    )
    share = F.round(F.lit(100.0) * F.col("existing_count") / F.nullif("unique_count", F.lit(0)), 4)
    return total.withColumns(
        {
            "duplicates_removed": F.col("raw_count") - F.col("unique_count"),
            "outside_count": F.col("unique_count") - F.col("inside_count"),
            "additional_count": F.col("unique_count") - F.col("existing_count"),
            "coverage_percent": share,
        }
    )


def counts_per_source(features: DataFrame, source: str = "source") -> DataFrame:
    return features.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def inside_box(minx: float, miny: float, maxx: float, maxy: float) -> Column:
    """Representative point within a rectangle, edges included."""
    return geo.boxes_meet(
        {"minx": F.col("rep_x"), "maxx": F.col("rep_x"), "miny": F.col("rep_y"), "maxy": F.col("rep_y")},
        {"minx": F.lit(minx), "miny": F.lit(miny), "maxx": F.lit(maxx), "maxy": F.lit(maxy)},
    )
