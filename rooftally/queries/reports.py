"""Queries on status, delivery and event reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import table, view, with_views
from rooftally.operators import reports
from rooftally.queries.registry import query

AVAILABLE = "av AS (SELECT dataset_key FROM ptasks WHERE status='OK' UNION SELECT dataset_key FROM marks WHERE updated)"
# tasks of this report are the processing datasets, so that availability has something to match
SEEN = """st AS (SELECT dataset_key AS task_id, CASE continent WHEN 'ASIA' THEN 'Asia' WHEN 'AFRICA' THEN '非洲' ELSE continent END AS continent,
                 CASE c_custkey%5 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'OK' WHEN 2 THEN 'FAILED' WHEN 3 THEN 'RUNNING' ELSE 'OK_EMPTY' END AS status, queue_order, c_custkey AS manifest_order, finished_at FROM ptasks)"""
LABEL = "CASE continent WHEN 'Asia' THEN 'Asia(亚洲)' WHEN '非洲' THEN 'Africa(非洲)' ELSE continent END"


def seen_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    continent = F.when(F.col("continent") == "ASIA", "Asia").when(F.col("continent") == "AFRICA", "非洲").otherwise(F.col("continent"))
    status = F.when(n % 5 == 0, "PENDING").when(n % 5 == 1, "OK").when(n % 5 == 2, "FAILED").when(n % 5 == 3, "RUNNING").otherwise("OK_EMPTY")
    return view(spark, sf_dir, "ptasks").select(
        F.col("dataset_key").alias("task_id"), continent.alias("continent"), status.alias("status"), "queue_order", n.alias("manifest_order"), "finished_at"
    )


def available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.available_keys(view(spark, sf_dir, "ptasks"), view(spark, sf_dir, "marks"))


@query("status_counts", with_views("SELECT status, count(*) AS total FROM tasks GROUP BY status", "tasks"))
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_counts(view(spark, sf_dir, "tasks"))


@query(
    "batch_state",
    with_views(
        """SELECT count(*) AS total, count(*) FILTER (status='RUNNING') AS running, count(*) FILTER (status='PENDING') AS pending,
                  CASE WHEN count(*) FILTER (status='RUNNING')>0 THEN 'running' WHEN count(*) FILTER (status='PENDING')>0 THEN 'stopped' ELSE 'done' END AS batch_state FROM tasks""",
        "tasks",
    ),
)
def batch_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batch_state(view(spark, sf_dir, "tasks"))


@query("available_keys", with_views(f"WITH {AVAILABLE} SELECT dataset_key FROM av", "ptasks", "marks"))
def available_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available(spark, sf_dir)


@query(
    "continent_stats",
    with_views(
        f"""WITH {AVAILABLE}, {SEEN}, m AS (SELECT st.*, {LABEL} AS label, status IN ('OK','OK_EMPTY') OR task_id IN (SELECT dataset_key FROM av) AS done FROM st)
            SELECT label AS continent, count(*) AS total, count(*) FILTER (done) AS downloaded, count(*) FILTER (NOT done AND status='PENDING') AS not_downloaded,
                   count(*) FILTER (NOT done AND status<>'PENDING') AS other FROM m GROUP BY label""",
        "ptasks", "marks",
    ),
)
def continent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.continent_stats(seen_tasks(spark, sf_dir), available(spark, sf_dir))


@query(
    "not_downloaded",
    with_views(
        f"""WITH {AVAILABLE}, {SEEN} SELECT task_id, 1 AS sort_status, coalesce(queue_order, 1000000000) AS sort_queue, manifest_order AS sort_manifest FROM st
            WHERE status='PENDING' AND {LABEL}='Asia(亚洲)' AND task_id NOT IN (SELECT dataset_key FROM av)""",
        "ptasks", "marks",
    ),
)
def not_downloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.not_downloaded(seen_tasks(spark, sf_dir), available(spark, sf_dir), "Asia(亚洲)")
    return rows.select("task_id", "sort_status", "sort_queue", "sort_manifest")


@query(
    "completed",
    with_views(f"WITH {AVAILABLE}, {SEEN} SELECT task_id, finished_at AS completed_at FROM st WHERE status IN ('OK','OK_EMPTY') OR task_id IN (SELECT dataset_key FROM av)", "ptasks", "marks"),
)
def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.completed(seen_tasks(spark, sf_dir), available(spark, sf_dir)).select("task_id", "completed_at")


@query(
    "recent_done",
    with_views("SELECT task_id, finished_at FROM tasks WHERE status IN ('OK','OK_EMPTY') ORDER BY finished_at DESC NULLS LAST, task_id DESC LIMIT 50 OFFSET 20", "tasks"),
)
def recent_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.recent_done(view(spark, sf_dir, "tasks"), 50, 20).select("task_id", "finished_at")


@query(
    "recent_failed",
    with_views(
        """SELECT task_id, repeat(task_id, 20) AS last_error FROM tasks WHERE status='FAILED' ORDER BY finished_at DESC NULLS LAST, task_id LIMIT 30""", "tasks"
    ),
)
def recent_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "tasks").withColumn("last_error", F.repeat("task_id", 20))
    return reports.recent_failed(rows, 30, at="finished_at").select("task_id", "last_error")


@query(
    "blocked_list",
    with_views("SELECT dataset_key FROM ptasks WHERE status='BLOCKED_NO_SHP' ", "ptasks"),
)
def blocked_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.listed(view(spark, sf_dir, "ptasks"), "BLOCKED_NO_SHP", F.col("dataset_key")).select("dataset_key")


@query("pending_list", with_views("SELECT task_id, queue_order FROM tasks WHERE status='PENDING'", "tasks"))
def pending_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All waiting tasks, thousands of rows: the list has no limit of its own."""
    order = [F.col("queue_order").asc_nulls_last(), F.col("task_id")]
    return reports.listed(view(spark, sf_dir, "tasks"), "PENDING", *order).select("task_id", "queue_order")


@query(
    "progress_eta",
    """WITH p AS (SELECT event_id, user_id%7 AS done, event_id%13 AS total, CASE WHEN event_id%5=0 THEN NULL ELSE greatest(0, epoch_us(TIMESTAMP '2024-01-15 12:00:00')-epoch_us(ts))//1000000 END AS elapsed FROM events)
       SELECT event_id, elapsed AS elapsed_seconds, CASE WHEN total>0 THEN round(least(done/total, 1.0), 9) END AS progress,
              CASE WHEN done>0 AND total>done AND elapsed IS NOT NULL THEN CAST(floor(elapsed::DOUBLE/done*(total-done)) AS BIGINT) END AS eta_seconds, coalesce(elapsed>600, false) AS stale FROM p""",
)
def progress_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 7).alias("done"), (F.col("event_id") % 13).alias("total"), "ts")
    started = F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("string")).otherwise("soon")
    now = F.lit("2024-01-15 12:00:00").cast("timestamp")
    rows = rows.withColumn("elapsed_seconds", reports.seconds_since(started, now))
    made = reports.progress_columns(F.col("done"), F.col("total"), F.col("elapsed_seconds"), F.col("elapsed_seconds"))
    made["progress"] = F.round(made["progress"], 9)
    return rows.withColumns(made).select("event_id", "elapsed_seconds", "progress", "eta_seconds", "stale")


# --- delivery -------------------------------------------------------------------------------------------------

DELIVERY = """
    d AS (SELECT p.dataset_key, p.shards, coalesce(m.updated, false) AS updated, c.state, c.dataset_key IS NOT NULL AS rec, c.copied, c.total, p.continent
          FROM ptasks p LEFT JOIN marks m ON p.dataset_key=m.dataset_key LEFT JOIN copies c ON p.dataset_key=c.dataset_key WHERE p.status='OK'),
    e AS (SELECT *, CASE WHEN rec AND state='done' THEN 'done' WHEN updated THEN 'done' WHEN rec AND state IN ('error','copying') THEN 'error' WHEN shards>0 THEN 'not_copied' ELSE 'unknown' END AS copy_state FROM d)"""


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.attach_delivery(view(spark, sf_dir, "ptasks"), view(spark, sf_dir, "marks"), view(spark, sf_dir, "copies"))


@query(
    "copy_state",
    with_views(
        f"""WITH {DELIVERY} SELECT dataset_key, updated, copy_state,
                   CASE WHEN updated AND coalesce(state,'')<>'done' THEN 0 ELSE coalesce(copied,0) END AS copied,
                   CASE WHEN updated AND coalesce(state,'')<>'done' THEN 0 WHEN copy_state='not_copied' THEN shards ELSE coalesce(total,0) END AS total FROM e""",
        "ptasks", "marks", "copies",
    ),
)
def copy_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery(spark, sf_dir).select("dataset_key", "updated", "copy_state", "copied", "total")


@query(
    "delivery_counts",
    with_views(
        f"""WITH {DELIVERY} SELECT count(*) AS total, count(*) FILTER (updated) AS updated, count(*) FILTER (NOT updated) AS pending, count(*) FILTER (copy_state='done') AS copy_done,
                   count(*) FILTER (copy_state='copying') AS copy_copying, count(*) FILTER (copy_state='error') AS copy_error, count(*) FILTER (copy_state='not_copied') AS copy_not_copied,
                   count(*) FILTER (copy_state='unknown') AS copy_unknown FROM e""",
        "ptasks", "marks", "copies",
    ),
)
def delivery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.delivery_counts(delivery(spark, sf_dir))


# --- batch twins of the streams -------------------------------------------------------------------------------

@query(
    "event_windows",
    with_views("SELECT date_trunc('hour', created_at) AS window_start, event, count(*) AS n FROM task_events GROUP BY 1, 2", "task_events"),
)
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rooftally.streaming.events import events_per_window

    return events_per_window(view(spark, sf_dir, "task_events"), "1 hour").select("window_start", "event", "n")


@query(
    "latest_state",
    with_views("SELECT dataset_key, event, event_id, created_at FROM (SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY event_id DESC) AS rn FROM task_events) q WHERE rn=1", "task_events"),
)
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rooftally.streaming.events import latest_state as latest

    return latest(view(spark, sf_dir, "task_events")).select("dataset_key", "event", "event_id", "created_at")


@query(
    "activity_sessions",
    with_views(
        """WITH g AS (SELECT *, CASE WHEN created_at < lag(created_at) OVER w + INTERVAL 600 SECOND THEN 0 ELSE 1 END AS fresh FROM task_events WINDOW w AS (PARTITION BY dataset_key ORDER BY created_at)),
                s AS (SELECT *, sum(fresh) OVER (PARTITION BY dataset_key ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS no FROM g)
           SELECT dataset_key, min(created_at) AS first_at, max(created_at) AS last_at, count(*) AS n FROM s GROUP BY dataset_key, no""",
        "task_events",
    ),
)
def activity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of activity that a silence of ten minutes ends."""
    from rooftally.streaming.events import activity_sessions as sessions

    return sessions(view(spark, sf_dir, "task_events"), "10 minutes")


