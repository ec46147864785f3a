"""Event-table reports that run the same on a batch DataFrame and on a stream.

Each function is a plain transformation; ``with_watermark`` turns on the bound for late rows where the input is a
stream. State stays one row per key (or per open window), kept in the state store of the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rooftally.functions import text


def with_watermark(events: DataFrame, delay: str = "10 minutes", at: str = "created_at") -> DataFrame:
    return events.withWatermark(at, delay) if events.isStreaming else events


def latest_state(events: DataFrame, key: str = "dataset_key") -> DataFrame:
    """Last event per key, by event id (output mode update)."""
    names = [c for c in events.columns if c not in (key, "event_id")]
    last = events.groupBy(key).agg(F.max(F.struct("event_id", *names)).alias("last"))
    return last.select(key, "last.*")


def events_per_window(events: DataFrame, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts per event kind in tumbling (or sliding) windows; rows later than the watermark are dropped."""
    span = F.window("created_at", size, slide) if slide else F.window("created_at", size)
    counts = with_watermark(events, delay).groupBy(span.alias("w"), "event").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event", "n")


def stage_progress(lines: DataFrame, key: str = "dataset_key") -> DataFrame:
    """Last announced stage and tiles announced so far, per log (``line_no, line``)."""
    read = lines.withColumns({"stage": text.parse_stage(F.col("line")), "tiles": text.added_tiles(F.col("line"))})
    totals = read.filter("stage is not null").groupBy(key).agg(
        F.max(F.struct("line_no", "stage", "line")).alias("last"), F.sum("tiles").alias("tiles_total")
    )
    return totals.select(key, F.col("last.stage").alias("stage"), F.col("last.line").alias("stage_detail"), "tiles_total")


def activity_sessions(events: DataFrame, gap: str = "10 minutes", key: str = "dataset_key", delay: str = "10 minutes") -> DataFrame:
    """Spans of activity per key. A span is emitted once its gap has passed: from then on the key is stale."""
    spans = with_watermark(events, delay).groupBy(F.session_window("created_at", gap).alias("w"), key).agg(
        F.count(F.lit(1)).alias("n"), F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at")
    )
    return spans.select(key, "first_at", "last_at", "n")


def dedup_geometry(features: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """First arrival of every geometry within the watermark delay."""
    if not features.isStreaming:
        others = [F.col(c).asc_nulls_last() for c in features.columns if c != at and c not in key]
        rank = F.row_number().over(Window.partitionBy(F.xxhash64(*key), *key).orderBy(F.col(at).asc_nulls_last(), *others))
        return features.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return features.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)
