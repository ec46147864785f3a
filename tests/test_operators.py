"""Literal cases for cleaning, index, names, tasks and reports."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import text
from rooftally.operators import index, quality, regions, reports, spatial, tasks
from tests.shapes import RINGS, box


def one(df):
    (row,) = df.collect()
    return row


# --- cleaning -------------------------------------------------------------------------------------------------

def test_clean_heights(rows):
    df = rows(f"feature_id int, HEIGHT double, rings {RINGS}", [(i, h, box(i, 0, i + 0.8, 0.8)) for i, h in enumerate([12.0, 0.0, -3.0, None])])
    assert sorted(r["feature_id"] for r in quality.drop_non_positive_height(df).collect()) == [0, 3]
    r = one(quality.clean_report(df))
    assert (r["input_count"], r["output_count"], r["removed_zero_height_count"], r["removed_duplicate_count"]) == (4, 2, 2, 0)
    lower = df.withColumnRenamed("HEIGHT", "height")
    assert quality.drop_non_positive_height(lower).count() == 4  # this spelling is not recognised
    words = rows("HEIGHT string", [("tall",), ("0",), (" -1",), ("2.5",), (None,)])
    assert sorted(str(r[0]) for r in quality.drop_non_positive_height(words).collect()) == ["2.5", "None", "tall"]


def test_clean_report_counts_empty(rows):
    df = rows(f"HEIGHT double, rings {RINGS}", [(1.0, box(0, 0, 1, 1)), (2.0, box(0, 0, 1, 1)), (3.0, None), (0.0, []), (0.0, box(5, 5, 6, 6))])
    r = one(quality.clean_report(df))
    assert (r["removed_empty_count"], r["removed_zero_height_count"], r["removed_duplicate_count"], r["output_count"]) == (2, 1, 1, 1)


def test_scale_height(rows):
    df = rows("HEIGHT double, NAME string", [(10.0, "a"), (None, "b"), (20.0, "c")])
    assert [r["HEIGHT"] for r in quality.scale_height(df, 0.65).orderBy("NAME").collect()] == [6.5, None, 13.0]
    mixed = rows("HEIGHT string", [("5",), ("n/a",), ("15",), (None,)])
    assert sorted(str(r[0]) for r in quality.scale_height(mixed, 0.65).collect()) == ["3.25", "9.75", "None", "n/a"]
    r = one(quality.scale_report(mixed))
    assert (r["feature_count"], r["scaled_count"], r["null_count"], r["non_numeric_count"]) == (4, 2, 1, 1)
    with pytest.raises(ValueError):
        quality.scale_height(df, 2, "Missing")


def test_dedup_keeps_first(rows):
    shapes = [box(0, 0, 1, 1), box(1, 0, 2, 1), box(2, 0, 3, 1), box(0, 0, 1, 1)]
    df = rows(f"GBA_ID string, src_pos int, rings {RINGS}", [(f"b{i}", i, s) for i, s in enumerate(shapes)])
    assert sorted(r["GBA_ID"] for r in quality.dedup_geometry(df, ["src_pos"]).collect()) == ["b0", "b1", "b2"]
    # -0.0 and 0.0 are the same place
    signed = rows(f"src_pos int, rings {RINGS}", [(1, [[(-0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (-0.0, 0.0)]]), (2, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]])])
    assert quality.dedup_geometry(signed, ["src_pos"]).count() == 1


def test_dedup_of_a_hot_geometry_cuts_before_the_shuffle(spark):
    df = spark.range(9000).withColumn("k", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")))
    unique = quality.dedup_geometry(df, ["id"], key=["k"])
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert unique.count() == 3000


def test_columns(rows):
    raw = rows("id int, height string, var string, extra int, region string", [(7, "12.5", "x", 1, "r")])
    out = quality.with_tile_id(quality.normalize_columns(raw), "T")
    assert out.columns == ["GBA_ID", "Height", "H_VAR", "REGION", "TILE_ID"]
    assert tuple(out.first()) == ("7", 12.5, None, "r", "T")
    assert quality.rename_height(rows("HEIGHT int, a int", [(1, 2)])).columns == ["Height", "a"]
    assert quality.rename_height(rows("Height int, x int", [(1, 2)])).columns == ["Height", "x"]
    assert quality.height_column(["height"]) is None and quality.height_column(["Height", "HEIGHT"]) == "HEIGHT"


def test_size_guard_is_per_component(rows):
    parts = rows("suffix string, size long", [(".shp", 100), (".dbf", 200)] * 2)
    assert all(r["accepted"] for r in quality.size_guard(parts, 500).collect())
    assert [r["suffix"] for r in quality.size_guard(parts, 300).filter("not accepted").collect()] == [".dbf"]


def test_merge_layers(rows):
    a = rows(f"src_pos int, rings {RINGS}", [(1, box(0, 0, 1, 1))])
    b = rows(f"src_pos int, rings {RINGS}, note string", [(1, box(0, 0, 1, 1), "a"), (2, box(2, 2, 3, 3), "b")])
    merged = quality.merge_layers([(a, 4326), (b, None)], dedup_order=["src_pos"])
    assert merged.count() == 2 and "note" in merged.columns
    with pytest.raises(ValueError):
        quality.merge_layers([])
    with pytest.raises(ValueError):
        quality.reproject(a, None)
    with pytest.raises(ValueError):
        spatial.polygons_only(rows("geom_type string", [("POINT",)]))


# --- index ----------------------------------------------------------------------------------------------------

INDEX = "continent string, country string, city string, shp_name string, minx double, miny double, maxx double, maxy double"


def test_index_updates(rows):
    table = rows(INDEX, [("A", "B", "C", "s1", 0.0, 0.0, 1.0, 1.0), ("A", "B", "D", "s2", 5.0, 5.0, 6.0, 6.0)])
    new = rows(INDEX, [("A", "B", "C", "s3", 0.0, 0.0, 2.0, 2.0), ("A", "B", "X", "s4", 0.0, 0.0, 2.0, 2.0)])
    region = rows("continent string, country string, city string", [("A", "B", "C")])
    assert sorted(r["shp_name"] for r in index.replace_region(table, new, region).collect()) == ["s2", "s3"]
    with pytest.raises(ValueError):
        index.replace_region(table, new.union(new), region).collect()
    assert sorted(r["shp_name"] for r in index.insert_if_absent(table, new.union(new)).collect()) == ["s1", "s2", "s3", "s4"]
    assert [r["shp_name"] for r in index.shards_intersecting(table, 1, 1, 4, 4).collect()] == ["s1"]  # touching counts
    with pytest.raises(ValueError):
        index.locate_region(table, "Z")
    assert index.locate_region(table, "C").count() == 1
    assert one(index.shard_list_json(table.limit(0)))["document"] == '{"list":[]}'
    assert one(index.shard_list_json(table))["document"] == '{"list":["A/B/C/s1","A/B/D/s2"]}'


def test_exporter_rejects_two_prefixes(rows):
    table = rows(INDEX, [("A", "B", "C", "p_1", 0.0, 0.0, 1.0, 1.0), (" A", "B", "C ", "q_1", 0.0, 0.0, 1.0, 1.0), ("A", "", "C", "z_1", 0.0, 0.0, 1.0, 1.0)])
    listed = index.distinct_tasks(table)
    assert sorted(r["process_name_prefix"] for r in listed.collect()) == ["p", "q"]
    with pytest.raises(ValueError):
        index.assert_unique(listed, index.REGION_KEY)
    with pytest.raises(ValueError):
        index.assert_unique(listed.limit(0), index.REGION_KEY, allow_empty=False)


def test_feature_collection_is_json(rows):
    import json

    table = rows(INDEX, [("A", 'B "q"', "C", f"s{i}", 0.0, 0.0, 1.0, 1.0) for i in range(5)])
    geometry = F.lit('{"type":"Point","coordinates":[0,0]}')
    pages = index.to_feature_collection(table, geometry, ["minx", "miny", "maxx", "maxy"], ["shp_name"], page_size=2).orderBy("page").collect()
    documents = [json.loads(p["document"]) for p in pages]
    assert [len(d["features"]) for d in documents] == [2, 2, 1]
    assert documents[0]["crs"]["properties"]["name"] == "EPSG:3857" and documents[0]["features"][0]["properties"]["country"] == 'B "q"'


# --- names ----------------------------------------------------------------------------------------------------

def test_names(rows):
    df = rows("v string", [("São_Tomé-and  Príncipe’s",), ("内蒙古自治区",), ("省",), (None,)])
    out = df.select(text.normalize_name("v").alias("n"), text.strip_admin_suffix(F.col("v")).alias("s"), text.slug(F.col("v")).alias("g"))
    got = {tuple(r) for r in out.collect()}
    assert ("sao tome and principes", "São_Tomé-and Príncipe’s", "São_Tomé-and_Príncipe’s") in got
    assert ("内蒙古自治区", "内蒙古", "内蒙古自治区") in got
    assert ("省", "省", "省") in got and ("", "", "task") in got


def test_small_values(rows):
    df = rows("v string", [("1,2,3,4",), ("1,2,1,4",), ("1,2,3",), ("a,2,3,4",)])
    assert [r[0] for r in df.select(text.bbox_problem(F.col("v"))).collect()] == [None, "range", "count", "number"]
    assert [r[0] is None for r in df.select(text.parse_bbox(F.col("v"), strict=False)).collect()] == [False, True, True, True]
    with pytest.raises(PySparkException):
        df.select(text.parse_bbox(F.col("v"))).collect()
    folders = rows("v string", [("\\data\\\\a/b/",), ("a/../b",), ("",)])
    assert [r[0] for r in folders.select(text.download_dir_problem(F.col("v"))).collect()] == [None, "parent", "empty"]
    assert folders.limit(1).select(text.normalize_download_dir(F.col("v"))).first()[0] == "data/a/b"
    assert [r[0] for r in rows("v string", [("[1,2]",), ("{}",), ("x",), ("",), (None,)]).select(text.json_list_size(F.col("v"))).collect()] == [2, 0, 0, 0, 0]
    lists = rows("v string", [("【‘海南省’，“上海市”】",), ("a, b ,",), ("",)])
    assert [r[0] for r in lists.select(text.province_list(F.col("v"))).collect()] == [["海南省", "上海市"], ["a", "b"], []]
    values = rows("v string", [('{"city": "London"}',), ('["a","b"]',), ("London ",)]).select(text.parse_query_value(F.col("v")).alias("q")).collect()
    assert values[0]["q"]["fields"] == {"city": "London"} and values[1]["q"]["items"] == ["a", "b"] and values[2]["q"]["text"] == "London"


def test_query_candidates(rows):
    df = rows("country string, city string", [("burkinafaso", "Burkinafaso"), ("USA", "New_York")])
    got = [[text for text in r[0]] for r in df.select(F.transform(text.query_candidates(F.col("country"), F.col("city")), text.query_text)).collect()]
    assert got[0] == ["country=Burkina Faso", "Burkina Faso"]
    assert got[1] == ["state=New York&country=United States", "city=New York&country=United States", "New York, United States", "New York"]


ADMIN0 = [(0, "China", "China", "China", "China", "中国"), (1, "France", "France", "France", "France", "法国"), (2, "Greenland", "Greenland", "Greenland", "Denmark", None)]
ADMIN1 = [(0, "China", "Fujian", "福建省"), (1, "France", "Corse|Corsica", "科西嘉"), (2, "Spain", "Madrid", "马德里")]


def test_cascade(rows):
    admin0 = rows("row_pos int, NAME string, NAME_LONG string, ADMIN string, SOVEREIGNT string, NAME_ZH string", ADMIN0)
    admin1 = rows("row_pos int, admin string, name string, name_zh string", ADMIN1)
    places = [
        ("t1", "Asia", "中国", "中国"), ("t2", "Asia", "China", "福建"), ("t3", "Europe", "france", "Corsica"), ("t4", "Europe", "France", "Madrid"),
        ("t5", "Europe", "Atlantis", "Madrid"), ("t6", "Europe", "France", "Nowhere"), ("t7", "X", "corse", "Y"),
    ]
    df = rows("task_id string, continent string, country string, city string", places)
    got = {r["task_id"]: (r["level"], r["matched_name"]) for r in regions.match_local_boundary(df, admin0, admin1).collect()}
    assert got == {
        "t1": ("admin0", "China"), "t2": ("admin1", "Fujian"), "t3": ("admin1", "Corse|Corsica"), "t4": ("admin1_global", "Madrid"),
        "t5": ("admin1_fallback", "Madrid"), "t6": (None, None), "t7": ("admin1_fallback", "Corse|Corsica"),
    }
    zh = {r["task_id"]: (r["country_zh"], r["city_zh"]) for r in regions.chinese_names(df, admin0, admin1).collect()}
    assert zh["t2"] == ("中国", "福建省") and zh["t1"] == ("中国", "中国") and zh["t6"] == ("法国", "")


def test_overrides(rows):
    raw = rows("pos int, continent string, country string, city string, kind string, value string, note string", [
        (1, "", "Indonesia", "Indonesia_west", "bbox", "95,-11,115,6", ""), (2, "Asia", "indonesia", "", "skip", "", "later"), (3, "", "", "", "", "x", "")])
    table = regions.clean_overrides(raw)
    df = rows("task_id string, continent string, country string, city string", [("a", "Asia", "Indonesia", "indonesia west"), ("b", "Asia", "Indonesia", "Bali"), ("c", "Asia", "Laos", "Laos")])
    got = {r["task_id"]: r["override_kind"] for r in regions.match_override(df, table).collect()}
    assert got == {"a": "bbox", "b": "skip", "c": None}
    with pytest.raises(PySparkException):
        regions.clean_overrides(raw.withColumn("kind", F.lit("other"))).collect()


def test_aliases(rows, spark):
    table = regions.province_aliases(spark)
    tokens = rows("token string", [(" 四川省 ",), ("Inner Mongolia",), ("tibet",), ("shanghai",)])
    got = regions.resolve_alias(tokens, table, rows("token string", [("上海",)]))
    assert sorted(r["slug"] for r in got.collect()) == ["inner_mongolia", "sichuan", "xizang"]
    with pytest.raises(PySparkException):
        regions.resolve_alias(rows("token string", [("mars",)]), table).collect()


# --- tasks ----------------------------------------------------------------------------------------------------

def test_status_changes(rows):
    table = rows("task_id string, status string, attempts int, last_error string, updated_at string", [("a", "RUNNING", 2, "e", "t0"), ("b", "OK", 1, None, "t0")])
    with pytest.raises(PySparkException):
        tasks.apply_status(table, rows("task_id string, status string", [("a", "DONE")]), "task_id").collect()
    with pytest.raises(ValueError):
        tasks.apply_status(table, rows("task_id string, status string, colour string", [("a", "OK", "x")]), "task_id")
    with pytest.raises(ValueError):  # a column of the table that is no task field
        tasks.apply_status(table.withColumn("continent", F.lit("x")), rows("task_id string, status string, continent string", [("a", "OK", "x")]), "task_id")
    changed = tasks.apply_status(table, rows("task_id string, status string, last_error string", [("a", "FAILED", None)]), "task_id", stamp=F.lit("t1"))
    assert {tuple(r) for r in changed.collect()} == {("a", "FAILED", 2, None, "t1"), ("b", "OK", 1, None, "t0")}
    table, log = tasks.reset_running(table, detail="stopped")
    assert {r["task_id"]: (r["status"], r["attempts"], r["last_error"]) for r in table.collect()} == {"a": ("PENDING", 2, "stopped"), "b": ("OK", 1, None)}
    assert [r["task_id"] for r in log.collect()] == ["a"]


def test_source_change_rules(rows):
    cases = [
        ("a", "OK", "2024-01-02T00:00:00", "f1", "2024-01-03T00:00:00", "f1", None, "download"),
        ("b", "OK", "2024-01-02T00:00:00", "f1", "2024-01-01T00:00:00", "f2", None, "fingerprint"),
        ("c", "OK", "2024-01-02T00:00:00", None, None, "f2", "2024-01-05T00:00:00", "files"),
        ("d", "OK", "2024-01-02T00:00:00", "f1", None, None, "2024-01-05T00:00:00", None),
        ("e", "FAILED", "2024-01-02T00:00:00", "f1", "2024-01-03T00:00:00", "f2", None, None),
        ("f", "OK", "then", "f1", "until", "f1", None, "download"),  # compared as text
    ]
    df = rows("k string, status string, finished_at string, source_fingerprint string, new_download_finished_at string, new_fingerprint string, new_source_updated_at string, want string", cases)
    for r in df.select("k", "want", tasks.source_change(df).alias("got")).collect():
        assert r["got"] == r["want"], r["k"]


def test_fingerprint_text(rows):
    import hashlib

    df = rows("dataset_key string, path string, size long, mtime_ns long", [("d", "x/b.shp", 5, 7), ("d", "x/a.dbf", 3, 9), ("d", 'x/a.shp', 2, 8)])
    want = hashlib.sha256('[["x/a.shp",2,8],["x/a.dbf",3,9],["x/b.shp",5,7]]'.encode()).hexdigest()
    r = one(tasks.source_fingerprint(df))
    assert (r["source_fingerprint"], r["latest_mtime_ns"]) == (want, 9)


def test_ledger(rows):
    good = {"f": (5, "h")}
    base = ("coverage-v2", "national-grid-v1")
    data = [
        ("c1", "c1", "COMPLETE", 3, *base, good), ("c2", "c2", "EMPTY", 0, *base, None), ("c3", "c3", "EMPTY", 2, *base, None),
        ("c4", "cX", "COMPLETE", 1, *base, good), ("c5", "c5", "COMPLETE", 1, "coverage-v1", base[1], good), ("c6", "c6", "COMPLETE", 1, *base, good),
        ("c7", "c7", "COMPLETE", 1, *base, {}), ("c8", "c8", "COMPLETE", 1, *base, good),
    ]
    ledger = rows("grid_id string, record_id string, status string, feature_count int, data_semantics_version string, grid_algorithm string, files map<string,struct<size:long,sha256:string>>", data)
    stored = rows("grid_id string, name string, size long, sha256 string", [("c1", "f", 5, "h"), ("c6", "f", 5, "other"), ("c8", "f", 5, "h"), ("c8", "extra", 1, "h")])
    valid = tasks.valid_ledger(ledger, stored)
    assert sorted(r["grid_id"] for r in valid.collect()) == ["c1", "c2"]
    grid = rows("grid_id string, boundary_id int", [(f"c{i}", 1) for i in range(1, 9)])
    r = one(tasks.grid_progress(grid, valid, ["boundary_id"]))
    assert (r["expected"], r["complete"], r["empty"], r["done"], r["missing"]) == (8, 1, 1, 2, 6)
    with pytest.raises(ValueError, match="c3"):
        tasks.assert_no_missing(grid, valid)


def test_queue_and_events(rows):
    table = rows("task_id string, status string, queue_order int, manifest_order int, city string", [("a", "PENDING", None, 1, "Xi"), ("b", "PENDING", 2, 5, "Yi"), ("c", "PENDING", 2, 4, "Zi"), ("d", "OK", 1, 0, "Q")])
    assert [r["task_id"] for r in tasks.queue_order(table).orderBy("position").collect()] == ["d", "c", "b", "a"]
    page = tasks.queue_search_pages(table, " yI ").collect()
    assert [(r["task_id"], r["global_order"], r["page_order"]) for r in page] == [("b", 2, 1)]
    log = rows("event_id long, dataset_key string, event string, detail string, created_at timestamp", [
        (1, "k", "PROCESS_MERGE_DONE", "d", dt.datetime(2024, 1, 1)), (2, "k", "PROCESS_MERGE_FAIL", "f", dt.datetime(2024, 1, 2)), (3, "k", "NOTE", "n", dt.datetime(2024, 1, 3))])
    last = one(tasks.latest_event(log, list(fixed.MERGE_EVENT_STATES), fixed.MERGE_EVENT_STATES))
    assert (last["state"], last["detail"]) == ("error", "f")
    lines = rows("path string, line_no int, line string", [("p", 1, "a"), ("p", 2, "  "), ("p", 3, " b "), ("p", 4, "c"), ("p", 5, "d")])
    assert one(tasks.tail_lines(lines))["tail"] == "b | c | d"


def test_stage_and_import_lines(rows):
    lines = ["Starting pipeline: input=a output=b", "Split a.shp into 3 chunk(s)", "Skipping split for b.shp", "noise", "QGIS result for x: valid=1", "Split a.shp into many chunk(s)"]
    df = rows("dataset_key string, line_no int, line string", [("k", i, line) for i, line in enumerate(lines)])
    r = one(reports.stage_progress(df))
    assert (r["stage"], r["stage_detail"], r["tiles_total"]) == ("SPLIT", lines[-1], 4)
    log = rows("dataset_key string, line_no int, line string", [
        ("a", 1, '__IMPORT_SUMMARY__ {"deleted": 1, "inserted": 2, "skipped": 3}'), ("a", 2, "__IMPORT_SUMMARY__ {broken"),
        ("b", 1, "完成: 删除=4 新增=5 跳过=6"), ("c", 1, "nothing")])
    got = {r["dataset_key"]: (r["deleted"], r["inserted"], r["skipped"]) for r in reports.import_summary(log).collect()}
    assert got == {"a": (1, 2, 3), "b": (4, 5, 6), "c": (None, None, None)}


# --- reports --------------------------------------------------------------------------------------------------

def test_continent_stats(rows):
    table = rows("task_id string, continent string, status string", [("1", "Africa", "PENDING"), ("2", "非洲", "PENDING"), ("3", "Africa", "FAILED"), ("4", "Europe", "OK")])
    none = rows("dataset_key string", [])
    got = {r["continent"]: (r["total"], r["downloaded"], r["not_downloaded"]) for r in reports.continent_stats(table, none).collect()}
    assert got == {"Africa(非洲)": (3, 0, 2), "Europe(欧洲)": (1, 1, 0)}
    got = {r["continent"]: (r["downloaded"], r["not_downloaded"]) for r in reports.continent_stats(table, rows("dataset_key string", [("1",)])).collect()}
    assert got["Africa(非洲)"] == (1, 1)


def test_copy_states(rows):
    cases = [
        ("running", None, False, True, 0, "copying"), ("done", "error", True, False, 0, "done"), (None, "done", True, False, 0, "done"), (None, "error", True, True, 0, "done"),
        (None, "error", True, False, 3, "error"), (None, "copying", True, False, 0, "error"), (None, None, False, True, 2, "done"), (None, None, False, False, 2, "not_copied"),
        (None, "", True, False, 2, "not_copied"), (None, None, False, False, 0, "unknown"),
    ]
    df = rows("job string, record string, has boolean, updated boolean, shards int, want string", cases)
    state = reports.copy_state(F.col("job"), F.col("record"), F.col("has"), F.col("updated"), F.col("shards"))
    for r in df.select("want", state.alias("got")).collect():
        assert r["got"] == r["want"]


def test_progress(rows):
    df = rows("done int, total int, elapsed long", [(5, 10, 100), (0, 10, 5), (10, 10, 50), (3, 0, 9), (2, 4, None)])
    made = reports.progress_columns(F.col("done"), F.col("total"), F.col("elapsed"), F.lit(601))
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in made.items()]).collect()]
    assert got == [(0.5, 100, True), (0.0, None, True), (1.0, None, True), (None, None, True), (0.5, None, True)]
    times = rows("t string", [("2024-01-01T00:00:00",), ("2024-01-03T00:00:00",), ("soon",), (None,)])
    seconds = times.select(reports.seconds_since(F.col("t"), F.lit("2024-01-02 00:00:01").cast("timestamp")))
    assert [r[0] for r in seconds.collect()] == [86401, 0, None, None]


def test_names_fold_like_plain_unicode(rows):
    """Letters of the Latin, Greek and Cyrillic scripts, Chinese signs, marks and punctuation against plain Python."""
    import re
    import unicodedata

    def plain(value):
        letters = [c for c in unicodedata.normalize("NFKD", value) if unicodedata.category(c) != "Mn" and c not in "'’"]
        return " ".join(re.split(r"[\W_]+", "".join(letters))).strip().casefold()

    signs = [chr(c) for c in [*range(32, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), 0x4E2D, 0x56FD, 0x2019] if unicodedata.category(chr(c))[0] != "C"]
    names = [f"a{c}B {c}" for c in signs] + ["", "São_Tomé-Príncipe", "Côte d'Ivoire", "  中国 "]
    out = rows("v string", [(n,) for n in names]).select("v", text.normalize_name("v").alias("n")).collect()
    different = [(r.v, r.n, plain(r.v)) for r in out if r.n != plain(r.v)]
    assert not [d for d in different if not any(unicodedata.category(c) == "Lm" or 0x1F80 <= ord(c) < 0x2000 or c == "ͅ" or c == "ͺ" for c in d[0])], different[:5]
    assert rows("v string", [(None,)]).select(text.normalize_name("v").alias("n")).first().n == ""


def test_names_beyond_latin(spark):
    """Marks that combine vanish, vowel signs of class 0 part words."""
    from rooftally.functions import text

    names = {"กินซ่า": "ก นซา", "Île-de-France": "ile de france", "हिन्दी": "ह नद", "L'Aquila’s": "laquilas", "ＴＯＫＹＯ_23": "tokyo 23", "Straße": "strasse", "東京 都": "東京 都", None: ""}
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", text.normalize_name("n").alias("k")).collect()
    assert {r["n"]: r["k"] for r in rows} == names


def test_kernels_see_only_what_needs_them(spark, monkeypatch):
    """Features that no edge of the mask reaches do not go to Python."""
    raised = F.raise_error(F.lit("went to the kernel"))
    monkeypatch.setattr(spatial.kernels, "common_part", lambda *args: raised.cast(spatial.kernels.CUT_TYPE))
    features = spark.createDataFrame([(k, box(k + 0.3, 0.3, k + 0.4, 0.4)) for k in range(3)] + [(9, box(0.2, 0.2, 1.4, 0.6))], f"feature_id int, rings {RINGS}")
    mask = spark.createDataFrame([(box(-1, -1, 2, 2),)], f"rings {RINGS}")
    assert {(r["feature_id"], r["geom_type"], r["maxy"]) for r in spatial.clip(features, mask).collect()} == {(0, "POLYGON", 0.4), (1, "POLYGON", 0.4), (9, "POLYGON", 0.6)}


def test_feature_pages_do_not_depend_on_the_order_of_rows(rows):
    table = rows("name string, k int", [("a", k) for k in range(30)])
    pages = [
        sorted(r["document"] for r in index.to_feature_collection(t, F.lit("null"), [], ["name"], page_size=7).collect())
        for t in (table, table.orderBy(F.desc("k")).coalesce(1), table.repartition(5, "k"))
    ]
    assert pages[0] == pages[1] == pages[2]
