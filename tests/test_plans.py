"""Physical plans: what reaches the scan, what is broadcast, what is cut before the shuffle."""

import pytest
from pyspark.sql import functions as F

from rooftally.operators import index, quality, spatial, tasks
from rooftally.session import fits_broadcast, lookup_join, shared_folder, stage
from tests.shapes import RINGS, box


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bbox_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, "x")], "id int, minx double, miny double, maxx double, maxy double, note string").write.parquet(str(tmp_path / "b"))
    found = spatial.scan_bbox(spark.read.parquet(str(tmp_path / "b")), 0, 0, 2, 2).select("id")
    text = plan(found)
    pushed = text.split("PushedFilters:")[1]
    assert "LessThanOrEqual(minx,2.0)" in pushed and "note" not in pushed


def test_lookup_broadcasts_only_what_was_counted(spark):
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(lookup_join(big, small, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Broadcast" not in plan(lookup_join(big, small, ["k"], max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check_counts_nested_bytes(spark):
    df = spark.range(10).withColumn("shape", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: i.cast("double")))
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=9) and not fits_broadcast(df, max_bytes=20_000)
    assert fits_broadcast(df.limit(0))


def test_assignment_does_not_shuffle_the_features(spark):
    features = spark.createDataFrame([(i, i / 10, 0.5) for i in range(20)], "id int, rep_x double, rep_y double")
    unit = spark.createDataFrame([(1, box(0, 0, 1, 1))], f"boundary_id int, rings {RINGS}")
    text = plan(spatial.assign_to_boundary(features, unit))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "CartesianProduct" not in text


def test_no_cartesian_products(spark):
    table = spark.createDataFrame([("a", "PENDING", 1, 1, "x")], "task_id string, status string, queue_order int, manifest_order int, city string")
    for df in (tasks.queue_order(table), tasks.front_insert(table, table.select("task_id", "manifest_order")), tasks.queue_search_pages(table)):
        assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoopJoin" not in plan(df)


def test_recent_events_cut_before_the_shuffle(spark):
    log = spark.range(100).select((F.col("id") % 3).alias("dataset_key"), F.col("id").alias("event_id"), F.lit("x").alias("event"))
    assert "WindowGroupLimit" in plan(tasks.recent_events(log, 2))


def test_shared_folder_is_the_one_the_session_names():
    from types import SimpleNamespace

    def session(named, used, master):
        conf = SimpleNamespace(get=lambda key, default: named)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: used, master=master, setCheckpointDir=lambda _: None))

    assert shared_folder(session("hdfs://x/cp", None, "yarn")) == "hdfs://x/cp"
    assert shared_folder(session(None, "hdfs://y/cp", "yarn")) == "hdfs://y/cp"
    with pytest.raises(ValueError):
        shared_folder(session(None, None, "yarn"))  # no local folder on a cluster


def test_stage_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, [[(0.0, 0.0)]], None)], f"id int, rings {RINGS}, note string")
    again = stage(df)
    assert again.collect() == df.collect() and again.dtypes == df.dtypes


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "feature_id int, rings " + RINGS)
    unit = spark.createDataFrame([(1, box(0, 0, 1, 1))], f"boundary_id int, rings {RINGS}")
    assert spatial.clip(none, unit).count() == 0
    located = none.withColumns({"rep_x": F.lit(0.0), "rep_y": F.lit(0.0)})
    assert spatial.assign_to_boundary(located, unit).count() == 0
    assert spatial.assign_to_boundary(located, unit.limit(0)).count() == 0
    assert quality.dedup_geometry(none, ["feature_id"]).count() == 0
    assert index.duplicate_keys(none, ["feature_id"]).count() == 0


@pytest.mark.parametrize("name", ["localCheckpoint", "crossJoin", "collect_set("])
def test_words_that_must_not_be_used(name):
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "rooftally"
    assert not [str(p) for p in root.rglob("*.py") if name in p.read_text()]
