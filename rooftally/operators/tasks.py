"""Task tables: selection, queue order, state changes and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import text
from rooftally.session import lookup_join, with_position

def queue_keys(*columns: str) -> list[Column]:
    """Queue order: given position (missing ones last), then the other columns."""
    first, *rest = columns
    return [F.col(first).asc_nulls_last(), *[F.col(c).asc() for c in rest]]


# --- selection ------------------------------------------------------------------------------------------------

def select_tasks(
    tasks: DataFrame, only: list[str] | None = None, continents: list[str] | None = None, countries: list[str] | None = None,
    statuses: list[str] | None = None, max_tasks: int = 0,
) -> DataFrame:
    """Tasks that fit all given lists (ignoring case); ``only`` are parts of the task id.

    With ``max_tasks`` the first ones in queue order are taken.
    """

    def cleaned(values: list[str] | None, fold) -> list[str]:
        return [fold(v.strip()) for v in values or [] if v.strip()]

    chosen = tasks
    if names := cleaned(statuses, str.upper):
        chosen = chosen.filter(F.upper("status").isin(names))
    if names := cleaned(continents, str.lower):
        chosen = chosen.filter(F.lower(F.trim("continent")).isin(names))
    if names := cleaned(countries, str.lower):
        chosen = chosen.filter(F.lower(F.trim("country")).isin(names))
    if parts := cleaned(only, str.lower):
        chosen = chosen.filter(_any_part(F.lower("task_id"), parts))
    if max_tasks > 0:
        chosen = chosen.orderBy(*queue_keys("queue_order", "manifest_order", "task_id")).limit(max_tasks)
    return chosen


def _any_part(haystack: Column, parts: list[str]) -> Column:
    test = F.lit(False)
    for part in parts:
        test = test | haystack.contains(part)
    return test


def matches_filters(tokens: list[str], *columns: str) -> Column:
    """Any token occurs, case included, in the columns joined by blanks; no token fits everything."""
    joined = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    return _any_part(joined, tokens) if tokens else F.lit(True)


def status_filter(explicit: list[str] | None = None, force: bool = False, retry_failed: bool = False) -> list[str]:
    """States a download run works on; an empty list means all."""
    if explicit:
        return explicit
    if force:
        return []
    return ["PENDING", "RUNNING", *(["FAILED"] if retry_failed else [])]


def select_processing(
    tasks: DataFrame, tokens: list[str] | None = None, retry_failed: bool = False, force: bool = False, limit: int = 0
) -> DataFrame:
    """Processing rows to work on: waiting ones, failed ones on retry, finished ones when forced."""
    states = ["PENDING", *(["FAILED"] if retry_failed else []), *(["OK"] if force else [])]
    columns = [c for c in ("dataset_key", "task_id", "source_dir", "display_name", "process_name_prefix") if c in tasks.columns]
    chosen = tasks.filter(F.col("status").isin(states) & matches_filters(tokens or [], *columns))
    return chosen.orderBy(*queue_keys("queue_order", "dataset_key")).limit(limit) if limit > 0 else chosen


def split_runnable(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can run and rows that first need their two or more shards merged (with ``shp_count``)."""
    counted = tasks.withColumn("shp_count", text.json_list_size(F.col("shp_files")))
    return counted.filter("shp_count < 2").drop("shp_count"), counted.filter("shp_count >= 2")


def search(df: DataFrame, keyword: str, *columns: str, limit: int = 0, order: list[Column] | None = None) -> DataFrame:
    """Rows whose columns, joined by blanks, contain the keyword (ignoring case)."""
    needle = " ".join(keyword.split()).lower()
    if not needle:
        return df.limit(0)
    joined = F.lower(F.concat_ws(" ", *[text.collapse_spaces(F.col(c)) for c in columns]))
    found = df.filter(joined.contains(needle))
    if limit:
        return (found.orderBy(*order) if order else found).limit(limit)
    return found


def find_task(df: DataFrame, continent: str, country: str, city: str) -> DataFrame:
    """Rows whose three names equal the given ones, ignoring case and extra blanks."""
    test = F.lit(True)
    for column, value in zip(("continent", "country", "city"), (continent, country, city)):
        test = test & (F.lower(text.collapse_spaces(F.col(column))) == " ".join(value.split()).lower())
    return df.filter(test)


# --- order ----------------------------------------------------------------------------------------------------

def queue_order(tasks: DataFrame, *columns: str, name: str = "position") -> DataFrame:
    """Number tasks in queue order (default columns: queue_order, manifest_order, task_id)."""
    return with_position(tasks, *queue_keys(*(columns or ("queue_order", "manifest_order", "task_id"))), name=name)


def queue_search_pages(tasks: DataFrame, keyword: str = "", columns: tuple[str, ...] = ("city",), offset: int = 0, limit: int = 15) -> DataFrame:
    """One page of the waiting queue after a search: ``global_order`` before it, ``page_order`` after it."""
    numbered = queue_order(tasks.filter(F.col("status") == "PENDING"), name="global_order")
    found = search(numbered, keyword, *columns) if keyword.strip() else numbered
    # the page is found by a top-k sort; only its rows reach the one task that numbers them
    page = found.orderBy("global_order").offset(offset).limit(limit)
    return page.withColumn("page_order", F.row_number().over(Window.orderBy("global_order")) + offset)


def front_insert(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """New tasks (``task_id, manifest_order``) take 1..k in manifest order; existing positions move up by k.

    A task id that the table already has, or that repeats in ``new``, is not added again.
    """
    fresh = new.groupBy("task_id").agg(F.min("manifest_order").alias("manifest_order")).join(tasks.select("task_id"), "task_id", "left_anti")
    placed = with_position(fresh, "manifest_order", "task_id", name="queue_order")
    moved = tasks.withColumn("queue_order", F.col("queue_order") + F.lit(placed.count()))
    return moved.select("task_id", "manifest_order", "queue_order").unionByName(
        placed.select("task_id", "manifest_order", F.col("queue_order").cast("long").alias("queue_order"))
    )


def next_order(table: DataFrame, new: DataFrame, *order: str) -> DataFrame:
    """New rows with ``queue_order`` continuing after the largest of the table."""
    last = table.agg(F.max("queue_order")).first()[0] or 0
    return with_position(new, *order, name="_order_no").withColumn("queue_order", F.lit(last) + F.col("_order_no")).drop("_order_no")


# --- events ---------------------------------------------------------------------------------------------------

def latest_event(events: DataFrame, kinds: list[str], states: dict[str, str], key: str = "dataset_key") -> DataFrame:
    """Last event of the given kinds per key, with the state it stands for (default ``done``)."""
    chosen = events.filter(F.col("event").isin(kinds))
    last = chosen.groupBy(key).agg(
        F.max(F.struct("created_at", "event_id", "event", F.coalesce("detail", F.lit("")).alias("detail"))).alias("e")
    )
    state = F.coalesce(text.lookup(states, F.col("e.event")), F.lit("done"))
    return last.select(key, state.alias("state"), F.col("e.detail").alias("detail"), F.col("e.event_id").alias("event_id"))


def recent_events(events: DataFrame, n: int = 10, key: str = "dataset_key") -> DataFrame:
    """Last ``n`` events per key; the rank filter already cuts every map task's share before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("event_id").desc()))
    return events.withColumn("nth", rank).filter(F.col("nth") <= n)


def tail_lines(lines: DataFrame, n: int = 3, key: str = "path", max_chars: int | None = None) -> DataFrame:
    """Last ``n`` non-blank lines per file in one text, joined by `` | ``; ``max_chars`` cuts it for display."""
    stripped = F.regexp_replace("line", r"(?U)^\s+|\s+$", "")
    kept = lines.select(key, "line_no", stripped.alias("line")).filter("line <> ''")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("line_no").desc()))
    last = kept.withColumn("_n", rank).filter(F.col("_n") <= n)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"])
    tail = F.concat_ws(" | ", ordered)
    return last.groupBy(key).agg((tail if max_chars is None else F.left(tail, F.lit(max_chars))).alias("tail"))


# --- state changes --------------------------------------------------------------------------------------------

def checked_status(status: Column, legal: list[str]) -> Column:
    problem = F.raise_error(F.concat(F.lit("unknown status: "), F.coalesce(status, F.lit("NULL")))).cast("string")
    return F.when(status.isin(legal), status).otherwise(problem)


def refused_fields(fields: list[str], columns: list[str], allowed: list[str] | None = None) -> list[str]:
    """Those of ``fields`` that an update must not set: not in the list of task fields, or not in the table."""
    settable = fixed.TASK_FIELDS if allowed is None else allowed
    return [c for c in fields if c not in settable or c not in columns]


def apply_status(table: DataFrame, updates: DataFrame, key: str, legal: list[str] | None = None, stamp: Column | None = None, allowed: list[str] | None = None) -> DataFrame:
    """Keyed partial update. ``updates``: key, ``status`` and any of ``allowed`` fields of the table; one row per key.

    A field column overwrites, NULL included; fields not given stay. Illegal states and fields that must not be set
    fail the job. ``stamp`` goes to ``updated_at`` of the changed rows.
    """
    fields = [c for c in updates.columns if c not in (key, "status")]
    unknown = refused_fields(fields, table.columns, allowed)
    if unknown:
        raise ValueError(f"fields that cannot be updated: {sorted(unknown)}")
    changes = updates.select(
        key, checked_status(F.col("status"), legal or fixed.TASK_STATUSES).alias("_status"),
        *[F.col(c).alias("_u_" + c) for c in fields], F.lit(True).alias("_hit"),
    )
    joined = table.join(changes, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    new = {"status": F.when(hit, F.col("_status")).otherwise(F.col("status"))}
    new |= {c: F.when(hit, F.col("_u_" + c)).otherwise(F.col(c)) for c in fields}
    if "updated_at" in table.columns and stamp is not None:
        new["updated_at"] = F.when(hit, stamp).otherwise(F.col("updated_at"))
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in table.columns])


def reset_running(
    tasks: DataFrame, ids: DataFrame | None = None, key: str = "task_id", event: str = "BATCH_REQUEUE", detail: str = "", stamp: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(table, events): running rows, all or the listed ones, wait again with their run data cleared.

    Attempts and queue position stay; ``stamp`` is the time of the change (now by default).
    """
    running = F.col("status") == "RUNNING"
    if ids is None:
        marked = tasks.withColumn("_hit", running)
    else:
        listed = ids.select(key).distinct().withColumn("_l", F.lit(True))
        marked = lookup_join(tasks, listed, [key], "left").withColumn("_hit", running & F.coalesce("_l", F.lit(False))).drop("_l")
    cleared = ["exit_code", "feature_count", "started_at", "finished_at", "duration_seconds", "stage", "stage_detail", "tiles_done", "tiles_total"]
    at = F.current_timestamp() if stamp is None else stamp
    new = {"status": F.when(F.col("_hit"), "PENDING").otherwise(F.col("status"))}
    for column in cleared:
        if column in tasks.columns:
            new[column] = F.when(~F.col("_hit"), F.col(column))
    if "last_error" in tasks.columns:
        new["last_error"] = F.when(F.col("_hit"), F.lit(detail or None)).otherwise(F.col("last_error"))
    if "updated_at" in tasks.columns:
        textual = tasks.schema["updated_at"].dataType.typeName() == "string"
        changed = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss") if textual else at
        new["updated_at"] = F.when(F.col("_hit"), changed).otherwise(F.col("updated_at"))
    table = marked.select(*[new.get(c, F.col(c)).alias(c) for c in tasks.columns])
    events = marked.filter("_hit").select(key, F.lit(event).alias("event"), F.lit(detail).alias("detail"), at.alias("created_at"))
    return table, events


def write_back_path(tasks: DataFrame, processed: DataFrame, column: str = "processed_3857_dir") -> DataFrame:
    """Record a finished folder (``task_id, path``) on the task rows that exist."""
    paths = processed.select("task_id", F.col("path").alias("_path"))
    return tasks.join(paths, "task_id", "left").withColumn(column, F.coalesce("_path", F.col(column))).drop("_path")


# --- manifest and sources -------------------------------------------------------------------------------------

def manifest_diff(manifest: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per manifest row: ``added``, ``updated`` (any field or the order differs), ``reset`` (folder changed on a
    finished task). Both sides have ``task_id, download_dir, manifest_order``; the table also ``status``."""
    compared = [c for c in ("continent", "country", "city", "download_dir", "manifest_order") if c in manifest.columns and c in tasks.columns]
    old = tasks.select("task_id", "status", *[F.col(c).alias("_" + c) for c in compared], F.lit(True).alias("_has"))
    joined = manifest.join(old, "task_id", "left")
    known = F.coalesce("_has", F.lit(False))
    differs = F.lit(False)
    for c in compared:
        differs = differs | ~F.col(c).eqNullSafe(F.col("_" + c))
    moved = ~F.col("download_dir").eqNullSafe(F.col("_download_dir")) & F.col("status").isin(fixed.SUCCESS_STATUSES)
    return joined.select(
        *manifest.columns, (~known).alias("added"), (known & differs).alias("updated"), (known & differs & moved).alias("reset")
    )


def sync_manifest(manifest: DataFrame, tasks: DataFrame, new_only: bool = False) -> DataFrame:
    """Task table after the manifest is applied: new tasks in front, changed ones updated, moved ones reset."""
    compared = ["continent", "country", "city", "download_dir", "manifest_order"]
    diff = manifest_diff(manifest, tasks)
    changes = diff.filter("not added" if not new_only else "false").select(
        "task_id", *[F.col(c).alias("_n_" + c) for c in compared], F.col("reset").alias("_reset"), F.col("updated").alias("_updated")
    )
    added = with_position(diff.filter("added").select("task_id", *compared), "manifest_order", "task_id", name="queue_order")
    added = added.withColumns({"status": F.lit("PENDING"), "queue_order": F.col("queue_order").cast("long")})
    joined = tasks.join(changes, "task_id", "left")
    updated, reset = F.coalesce("_updated", F.lit(False)), F.coalesce("_reset", F.lit(False))
    new = {c: F.when(updated, F.col("_n_" + c)).otherwise(F.col(c)) for c in compared}
    new["status"] = F.when(reset, "PENDING").otherwise(F.col("status"))
    new["queue_order"] = (F.col("queue_order") + F.lit(added.count())).cast("long")
    for c in ("feature_count", "merge_output", "last_error"):
        if c in tasks.columns:
            new[c] = F.when(~reset, F.col(c))
    kept = joined.select(*[new.get(c, F.col(c)).alias(c) for c in tasks.columns])
    return kept.unionByName(added, allowMissingColumns=True)


def source_change(rows: DataFrame) -> Column:
    """Why a finished dataset has to be processed again, NULL when it has not.

    Expects the state columns ``status, finished_at, source_fingerprint`` and the discovered ones
    ``new_download_finished_at, new_fingerprint, new_source_updated_at`` in ``rows``.
    """
    old, new = rows["source_fingerprint"], rows["new_fingerprint"]
    blank_old = F.coalesce(old, F.lit("")) == ""
    blank_new = F.coalesce(new, F.lit("")) == ""
    return F.when(
        rows["status"] == "OK",
        F.when(text.is_later(rows["new_download_finished_at"], rows["finished_at"]), "download")
        .when(~blank_old & ~blank_new & (old != new), "fingerprint")
        .when(blank_old & text.is_later(rows["new_source_updated_at"], rows["finished_at"]), "files"),
    )


def upsert_source(table: DataFrame, discovered: DataFrame) -> DataFrame:
    """Processing table after a discovery: new keys at the end of the queue, known keys refreshed.

    A known row keeps its state unless its source changed, or it waited for shards that now exist; then it waits
    for processing again. ``table``: ``dataset_key, status, queue_order, shp_files, source_fingerprint,
    finished_at``; ``discovered``: ``dataset_key, status, shp_files, source_fingerprint, source_updated_at,
    download_finished_at`` (one row per key). The result has ``change`` (added, the reason, resumed, or NULL).
    """
    found = discovered.select(
        "dataset_key", F.col("status").alias("_status"), F.col("shp_files").alias("_files"),
        F.col("source_fingerprint").alias("new_fingerprint"), F.col("source_updated_at").alias("new_source_updated_at"),
        F.col("download_finished_at").alias("new_download_finished_at"), F.lit(True).alias("_found"),
    )
    joined = table.withColumn("_known", F.lit(True)).join(found, "dataset_key", "full")
    known, seen = F.coalesce("_known", F.lit(False)), F.coalesce("_found", F.lit(False))
    reason = source_change(joined)
    resumed = F.col("status").isin("BLOCKED_NO_SHP", "WAITING_DOWNLOAD") & (text.json_list_size(F.col("_files")) > 0)
    change = F.when(~known, "added").when(seen, F.coalesce(reason, F.when(resumed, "resumed")))
    state = F.when(~known, F.coalesce("_status", F.lit("PENDING"))).when(seen & (reason.isNotNull() | resumed), "PENDING").otherwise(F.col("status"))
    merged = joined.select(
        "dataset_key", state.alias("status"), "queue_order",
        F.when(seen, F.col("_files")).otherwise(F.col("shp_files")).alias("shp_files"),
        F.when(seen, F.col("new_fingerprint")).otherwise(F.col("source_fingerprint")).alias("source_fingerprint"),
        F.when(seen & known & reason.isNotNull(), F.lit(None)).otherwise(F.col("finished_at")).alias("finished_at"),
        change.alias("change"),
    )
    fresh = next_order(table, merged.filter("change = 'added'").drop("queue_order"), "dataset_key")
    kept = merged.filter("change is null or change <> 'added'").withColumn("queue_order", F.col("queue_order").cast("long"))
    return kept.unionByName(fresh.withColumn("queue_order", F.col("queue_order").cast("long")))


def reconcile_orphans(table: DataFrame, discovered: DataFrame, existing: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Waiting rows that were not discovered and have no existing file go to WAITING_DOWNLOAD.

    ``discovered``: dataset_key; ``existing``: file ``path``; ``shp_files`` of the table is a JSON array.
    """
    files = F.from_json("shp_files", "array<string>")
    waiting = table.filter((F.col("status") == "PENDING") & matches_filters(tokens or [], "dataset_key"))
    waiting = waiting.join(discovered.select("dataset_key"), "dataset_key", "left_anti")
    with_file = waiting.select("dataset_key", F.explode(files).alias("path")).join(existing.select("path").distinct(), "path", "left_semi")
    orphans = waiting.join(with_file.select("dataset_key").distinct(), "dataset_key", "left_anti").select("dataset_key", F.lit(True).alias("_orphan"))
    joined = table.join(orphans, "dataset_key", "left")
    orphan = F.coalesce("_orphan", F.lit(False))
    new = {
        "status": F.when(orphan, "WAITING_DOWNLOAD").otherwise(F.col("status")),
        "shp_files": F.when(orphan, "[]").otherwise(F.col("shp_files")),
    }
    if "last_error" in table.columns:
        new["last_error"] = F.when(orphan, fixed.SOURCE_MISSING).otherwise(F.col("last_error"))
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in table.columns])


def discover_sources(candidates: DataFrame) -> DataFrame:
    """Priority union of dataset folders: one row per key, the first source wins.

    ``candidates``: ``prio`` (existing data, finished download, scan, extra), ``directory``, ``task_id``,
    ``shp_files ARRAY``, ``has_gpkg`` and optional extra columns. Folders under ``.x`` or ``_x`` are left out; a
    scanned folder that a task already owns is left out; a folder with neither shards nor layer is left out; one
    with only a layer is blocked.
    """
    parts = F.split("directory", "/")
    visible = candidates.filter(~F.exists(parts, lambda p: p.rlike("^[._]"))).filter((F.size("shp_files") > 0) | F.col("has_gpkg"))
    owned = visible.filter("prio <= 2").select("directory").distinct()
    scanned = visible.filter("prio = 3").join(owned, "directory", "left_anti")
    pool = visible.filter("prio <> 3").unionByName(scanned)
    key = F.coalesce("task_id", F.concat(F.lit("EXT|"), "directory"))
    blocked = F.size("shp_files") == 0
    keyed = pool.withColumns(
        {
            "dataset_key": key,
            "display_name": text.file_name(F.col("directory")),
            "status": F.when(blocked, "BLOCKED_NO_SHP").otherwise("PENDING"),
            "last_error": F.when(blocked, fixed.NO_DELIVERY_SHP),
        }
    )
    rank = F.row_number().over(Window.partitionBy("dataset_key").orderBy("prio", "directory"))
    return keyed.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "prio", "has_gpkg")


def source_fingerprint(files: DataFrame, key: str = "dataset_key", content: bool = False) -> DataFrame:
    """sha256 over the sorted JSON list of ``[path, size, mtime]`` per dataset, and the newest ``mtime``.

    ``files``: key, ``path, size, mtime_ns`` (or ``sha256`` with ``content``). A dataset has a few files of up to
    2 GB each, so the list that is digested stays a few kilobytes per terabyte.
    """
    stamp = F.concat(F.lit('"'), F.col("sha256"), F.lit('"')) if content else F.col("mtime_ns").cast("string")
    quoted = F.substring(F.to_json(F.array("path")), 2, 1 << 30)
    record = F.concat(F.lit("["), F.rtrim(F.regexp_replace(quoted, r"\]$", "")), F.lit(","), F.col("size").cast("string"), F.lit(","), stamp, F.lit("]"))
    order = [F.lower(text.parent_folder(F.col("path"))), F.lower(text.file_stem(F.col("path"))), _suffix_rank(F.col("path")), F.col("path")]
    entry = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], record.alias("record"))
    listing = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["record"])
    return files.groupBy(key).agg(
        F.sha2(F.concat(F.lit("["), F.concat_ws(",", listing), F.lit("]")), 256).alias("source_fingerprint"),
        F.max("mtime_ns").alias("latest_mtime_ns"), F.count(F.lit(1)).alias("files"),
    )


def _suffix_rank(path: Column) -> Column:
    order = [".shp", *fixed.SIDECAR_SUFFIXES]
    suffix = text.file_suffix(path)
    rank = F.lit(len(order))
    for i, name in reversed(list(enumerate(order))):
        rank = F.when(suffix == name, i).otherwise(rank)
    return rank


# --- checks ---------------------------------------------------------------------------------------------------

def compare_sets(expected: DataFrame, actual: DataFrame, name: str = "name", by: list[str] | None = None) -> DataFrame:
    """Missing and extra counts and whether both sets are equal and not empty; one row, or one per ``by``."""
    keys = [*(by or []), name]
    left = expected.select(*keys).distinct().withColumn("_e", F.lit(1))
    right = actual.select(*keys).distinct().withColumn("_a", F.lit(1))
    both = left.join(right, keys, "full")
    totals = both.groupBy(*(by or [])).agg(
        F.count("_e").alias("expected"), F.count("_a").alias("actual"),
        F.count_if(F.col("_e").isNotNull() & F.col("_a").isNull()).alias("missing"),
        F.count_if(F.col("_e").isNull() & F.col("_a").isNotNull()).alias("extra"),
    )
    return totals.withColumn("consistent", (F.col("expected") > 0) & (F.col("missing") == 0) & (F.col("extra") == 0))


def publish_ready(sources: DataFrame, shared: DataFrame, by: list[str]) -> DataFrame:
    """Per dataset: how many source files are missing in the shared folder or differ in size, and readiness.

    Both sides have ``by, name, size``; a dataset without any shared ``.shp`` is not ready.
    """
    there = shared.select(*by, "name", F.col("size").alias("_size"))
    joined = sources.join(there, [*by, "name"], "left")
    checked = joined.groupBy(*by).agg(F.count_if(~F.col("size").eqNullSafe(F.col("_size"))).alias("missing"), F.count(F.lit(1)).alias("files"))
    shapes = shared.filter(F.lower("name").endswith(".shp")).groupBy(*by).agg(F.count(F.lit(1)).alias("_shapes"))
    ready = (F.col("missing") == 0) & F.col("_shapes").isNotNull()
    return checked.join(shapes, by, "left").withColumn("ready", ready).drop("_shapes")


def verify_success(tasks: DataFrame, markers: DataFrame, available: DataFrame) -> DataFrame:
    """Finished tasks whose completion record is missing or disagrees, and whose data is not available elsewhere.

    ``tasks``: ``task_id, status, download_dir, merge_output, merge_size, boundary_filter, buffer_m``;
    ``markers``: ``task_id, status, download_dir, merge_output, merge_size, boundary_filter, buffer_m``.
    """
    compared = ["download_dir", "merge_output", "boundary_filter", "buffer_m"]
    records = markers.select(
        "task_id", F.col("status").alias("_status"), F.col("merge_size").alias("_size"), *[F.col(c).alias("_" + c) for c in compared]
    )
    joined = tasks.filter(F.col("status").isin(fixed.SUCCESS_STATUSES)).join(records, "task_id", "left")
    good = F.coalesce(F.col("_status").isin(fixed.SUCCESS_STATUSES), F.lit(False))
    for column in compared:
        good = good & F.col(column).eqNullSafe(F.col("_" + column))
    good = good & F.col("merge_size").isNotNull() & (F.col("_size").isNull() | (F.col("_size") == F.col("merge_size")))
    broken = joined.filter(~good).select(*tasks.columns)
    return broken.join(available.select(F.col("dataset_key").alias("task_id")), "task_id", "left_anti")


# --- tiles ----------------------------------------------------------------------------------------------------

def valid_ledger(ledger: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Completion records that count: right versions, EMPTY with no row, COMPLETE with exactly its files.

    ``ledger``: ``grid_id, record_id, status, feature_count, data_semantics_version, grid_algorithm, files`` (MAP
    name -> STRUCT<size, sha256>); ``files``: ``grid_id, name, size, sha256`` found in storage.
    """
    current = ledger.filter(
        (F.col("data_semantics_version") == fixed.DATA_SEMANTICS)
        & (F.col("grid_algorithm") == fixed.GRID_ALGORITHM)
        & (F.col("record_id") == F.col("grid_id"))
    )
    empty = current.filter((F.col("status") == "EMPTY") & (F.coalesce("feature_count", F.lit(0)) == 0))
    complete = current.filter(F.col("status") == "COMPLETE")
    if files is None:
        return empty.unionByName(complete)
    wanted = complete.filter(F.size("files") > 0).select("grid_id", F.explode("files").alias("name", "f"))
    there = files.select("grid_id", "name", F.col("size").alias("_size"), F.col("sha256").alias("_sha"), F.lit(1).alias("_t"))
    both = wanted.withColumn("_w", F.lit(1)).join(there, ["grid_id", "name"], "full")
    same = F.col("_w").isNotNull() & F.col("_t").isNotNull() & (F.col("f.size") == F.col("_size")) & (F.col("f.sha256") == F.col("_sha"))
    sound = both.groupBy("grid_id").agg(F.min(F.coalesce(same, F.lit(False))).alias("_sound")).filter("_sound").select("grid_id")
    return empty.unionByName(complete.join(sound, "grid_id", "left_semi"))


def pending_tiles(grid: DataFrame, valid: DataFrame) -> DataFrame:
    """Expected cells without a valid record."""
    return grid.join(valid.select("grid_id").distinct(), "grid_id", "left_anti")


def assert_no_missing(grid: DataFrame, valid: DataFrame) -> None:
    """Fail naming ten cells when expected ones have no record."""
    missing = [r["grid_id"] for r in pending_tiles(grid, valid).select("grid_id").orderBy("grid_id").limit(10).collect()]
    if missing:
        raise ValueError(f"grid cells without a result: {missing}")


def grid_progress(grid: DataFrame, valid: DataFrame, by: list[str]) -> DataFrame:
    """Expected, complete, empty, done and missing cells (expected cells count once)."""
    state = valid.groupBy("grid_id").agg(F.min("status").alias("_state"))
    cells = grid.select(*by, "grid_id").distinct().join(state, "grid_id", "left")
    totals = cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if(F.col("_state") == "COMPLETE").alias("complete"), F.count_if(F.col("_state") == "EMPTY").alias("empty"),
    )
    done = F.col("complete") + F.col("empty")
    return totals.withColumns({"done": done, "missing": F.greatest(F.col("expected") - done, F.lit(0))})
