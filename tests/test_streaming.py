"""Streams run to the end of their input and are compared with the batch answer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rooftally.operators import spatial
from rooftally.streaming import events, jobs
from tests.shapes import RINGS, box

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, dataset_key string, event string, detail string, created_at timestamp"


@pytest.fixture
def log(spark, tmp_path):
    """An event folder of several files, and the same rows as a batch."""
    rows = [(i, f"k{i % 7}", ["a", "b", "c"][i % 3], "d", START + dt.timedelta(minutes=3 * i)) for i in range(300)]
    path = str(tmp_path / "events")
    for k in range(3):
        spark.createDataFrame(rows[k * 100 : (k + 1) * 100], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path, spark.createDataFrame(rows, SCHEMA)


def test_latest_state(spark, log, tmp_path):
    path, batch = log
    table, checkpoint = str(tmp_path / "state"), str(tmp_path / "cp")
    jobs.run_latest_state(jobs.read_event_stream(spark, path, files_per_trigger=1), table, checkpoint).awaitTermination()
    want = {tuple(r) for r in events.latest_state(batch).collect()}
    assert {tuple(r) for r in jobs.read_latest_state(spark, table).collect()} == want
    # more events arrive, the stream goes on from its checkpoint
    extra = [(1000, "k1", "z", "d", START + dt.timedelta(days=2)), (1001, "new", "z", "d", START + dt.timedelta(days=2))]
    spark.createDataFrame(extra, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    jobs.run_latest_state(jobs.read_event_stream(spark, path), table, checkpoint).awaitTermination()
    want = {tuple(r) for r in events.latest_state(batch.union(spark.createDataFrame(extra, SCHEMA))).collect()}
    assert {tuple(r) for r in jobs.read_latest_state(spark, table).collect()} == want


def test_windows_and_sessions(spark, log, tmp_path):
    path, batch = log
    stream = jobs.read_event_stream(spark, path)
    out = str(tmp_path / "windows")
    jobs.run_to_table(events.events_per_window(stream), out, str(tmp_path / "cp1")).awaitTermination()
    got = {tuple(r) for r in spark.read.schema("window_start timestamp, window_end timestamp, event string, n long").parquet(out).collect()}
    everything = {tuple(r) for r in events.events_per_window(batch).collect()}
    limit = START + dt.timedelta(minutes=3 * 299 - 10)
    assert got == {r for r in everything if r[1] <= limit}
    # silence of ten minutes ends a session: every key speaks every 21 minutes
    out = str(tmp_path / "sessions")
    jobs.run_to_table(events.activity_sessions(stream), out, str(tmp_path / "cp2")).awaitTermination()
    closed = spark.read.schema("dataset_key string, first_at timestamp, last_at timestamp, n long").parquet(out)
    assert closed.agg(F.max("n")).first()[0] == 1 and 280 <= closed.count() < 300
    sliding = events.events_per_window(batch, "1 hour", "30 minutes")
    assert sliding.agg(F.sum("n")).first()[0] == 600


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [[(1, "k", "a", "", START)], [(2, "k", "a", "", START + dt.timedelta(hours=5))], [(3, "k", "a", "", START + dt.timedelta(minutes=1))], [(4, "k", "a", "", START + dt.timedelta(hours=9))]]
    out = str(tmp_path / "w")
    for part in rows:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        jobs.run_to_table(events.events_per_window(jobs.read_event_stream(spark, path)), out, str(tmp_path / "cp")).awaitTermination()
    got = {(r["window_start"], r["n"]) for r in spark.read.schema("window_start timestamp, window_end timestamp, event string, n long").parquet(out).collect()}
    assert (START, 1) in got and (START, 2) not in got


def test_first_copies(spark, tmp_path):
    schema = "geom_wkb string, arrived timestamp, src_pos int"
    path = str(tmp_path / "tiles")
    for k in range(2):
        spark.createDataFrame([(f"g{i % 5}", START + dt.timedelta(seconds=k * 10 + i), k * 10 + i) for i in range(10)], schema).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_event_stream(spark, path, schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    jobs.run_to_table(events.dedup_geometry(stream, ["geom_wkb"], "arrived", "1 hour"), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["geom_wkb"] for r in spark.read.schema(schema).parquet(out).collect()) == [f"g{i}" for i in range(5)]


def test_stage_progress(spark, tmp_path):
    schema = "dataset_key string, line_no long, line string"
    lines = [("j", 1, "Starting pipeline: x"), ("j", 2, "Split f into 3 chunk(s)"), ("j", 3, "Skipping split for g"), ("j", 4, "Cleaning valid output: f")]
    path = str(tmp_path / "log")
    spark.createDataFrame(lines, schema).write.parquet(path)
    table = str(tmp_path / "progress")
    jobs.run_stage_progress(jobs.read_event_stream(spark, path, schema), table, str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
    r = jobs.read_progress(spark, table).first()
    assert (r["stage"], r["tiles_total"]) == ("CLEAN", 4)


def test_stage_progress_adds_changed_logs_only(spark, tmp_path, monkeypatch):
    """A batch writes the logs it changed; folding leaves one row per log and the same answer."""
    monkeypatch.setattr(jobs, "FOLD_EVERY", 3)
    schema = "dataset_key string, line_no long, line string"
    path, table = str(tmp_path / "log"), str(tmp_path / "progress")
    steps = [[("j", 1, "Starting pipeline: x"), ("k", 1, "Starting pipeline: y")], [("j", 2, "Split f into 3 chunk(s)")], [("j", 3, "Cleaning valid output: f")], [("k", 2, "Split f into 2 chunk(s)")]]
    for n, lines in enumerate(steps, 1):
        spark.createDataFrame(lines, schema).coalesce(1).write.mode("append").parquet(path)
        jobs.run_stage_progress(jobs.read_event_stream(spark, path, schema), table, str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
        rows = spark.read.parquet(table).count()
        assert rows == {1: 2, 2: 3, 3: 2, 4: 3}[n]
        assert {r["dataset_key"] for r in jobs.read_progress(spark, table).collect()} == {"j", "k"}
    assert {r["dataset_key"]: (r["stage"], r["tiles_total"]) for r in jobs.read_progress(spark, table).collect()} == {"j": ("CLEAN", 3), "k": ("SPLIT", 2)}


def test_incremental_tiles(spark, tmp_path):
    unit = spark.createDataFrame([("u", box(0.1, 0.1, 1.4, 0.4))], f"boundary_id string, rings {RINGS}")
    cells = spatial.boundary_to_grid(unit, 0.5)
    ids = [r["grid_id"] for r in cells.orderBy("grid_i").collect()]
    schema = "TILE_ID string, src_pos int, v double"
    inbox, tiles, ledger, checkpoint = (str(tmp_path / n) for n in ("in", "tiles", "ledger", "cp"))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        jobs.run_incremental_tiles(jobs.read_event_stream(spark, inbox, schema), cells, tiles, ledger, checkpoint).awaitTermination()

    arrive([(ids[0], 1, 1.0), (ids[0], 2, 2.0), ("elsewhere", 1, 0.0)])
    records = spark.read.parquet(ledger)
    assert [(r["grid_id"], r["feature_count"]) for r in records.collect()] == [(ids[0], 2)]
    assert sorted(r["grid_id"] for r in jobs.missing_after(cells, records).collect()) == ids[1:]
    arrive([(ids[0], 9, 9.0), (ids[0], 1, 1.0), (ids[1], 1, 1.0)])  # a late row of the first cell, and one that it holds
    assert sorted(r["src_pos"] for r in spark.read.parquet(tiles).filter(F.col("TILE_ID") == ids[0]).collect()) == [1, 2, 9]
    newest = spark.read.parquet(ledger).filter(F.col("grid_id") == ids[0]).orderBy(F.desc("finished_at")).first()
    assert newest["feature_count"] == 3
    assert sorted(r["grid_id"] for r in jobs.missing_after(cells, spark.read.parquet(ledger)).collect()) == ids[2:]
