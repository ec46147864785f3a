"""Readers and writers on files made by the tests."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally import schemas
from rooftally.operators import spatial
from rooftally.plans import build, publish
from rooftally.sources import files, layers, sinks
from tests.shapes import RINGS, box, ring, write_shapefile

DEGREES = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]]]'
METRIC = 'PROJCS["WGS 84 / Pseudo-Mercator",AUTHORITY["EPSG","3857"]]'


def feature(number, rings, **properties):
    return {"type": "Feature", "id": f"f{number}", "properties": {"id": number, **properties}, "geometry": {"type": "Polygon", "coordinates": rings}}


def test_geojson(spark, tmp_path):
    hole = [*box(0, 0, 4, 4), *box(1, 1, 2, 2)]
    multi = {"type": "Feature", "properties": {"id": 3}, "geometry": {"type": "MultiPolygon", "coordinates": [box(0, 0, 1, 1), box(5, 5, 6, 6)]}}
    spot = {"type": "Feature", "properties": {}, "geometry": {"type": "Point", "coordinates": [1, 2]}}
    collection = {"type": "FeatureCollection", "numberMatched": 9, "features": [feature(1, hole, height="12.5"), feature(2, box(1, 1, 2, 2), height="x"), multi, spot]}
    (tmp_path / "a.json").write_text(json.dumps(collection))
    df = layers.read_geojson_features(spark, str(tmp_path / "a.json"), properties={"id": "int", "height": "double"})
    out = {r["id"]: r for r in df.collect()}
    assert out[1]["height"] == 12.5 and out[2]["height"] is None and out[1]["matched"] == 9
    assert [len(out[k]["rings"]) for k in (1, 2, 3)] == [2, 1, 2] and out[None]["rings"] is None and out[None]["geom_type"] == "Point"
    assert tuple(out[1]["rings"][0][2]) == (4.0, 4.0)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(f) for f in collection["features"]))
    assert layers.read_geojson_features(spark, str(tmp_path / "lines.json"), lines=True).count() == 4
    boundary = layers.read_boundary(spark, str(tmp_path / "a.json"), "b")
    # one row per part
    assert boundary.count() == 4 and boundary.columns == ["boundary_id", "rings"]
    (tmp_path / "empty.json").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    assert layers.read_geojson_features(spark, str(tmp_path / "empty.json")).count() == 0


def test_shapefiles(spark, tmp_path):
    folder = tmp_path / "Asia" / "China" / "Fujian"
    folder.mkdir(parents=True)
    many = [box(i, 0, i + 0.5, 1) for i in range(57)]
    many[10] = None
    many[11] = [*box(0, 0, 4, 4), *box(1, 1, 2, 2)]
    write_shapefile(folder / "fujian_001_001_3857", many, [None if i == 3 else i * 1.5 for i in range(57)], METRIC)
    write_shapefile(folder / "fujian_001_002_3857", [box(7, 7, 8, 8)], [1.0], METRIC, "gbk", ["福州"])
    write_shapefile(folder / "fujian_001_003_3857", [], [], METRIC)
    df = layers.read_shapefiles(spark, str(tmp_path), records_per_task=10)
    out = {(r["path"].rsplit("/", 1)[1], r["record_no"]): r for r in df.collect()}
    assert len(out) == 58
    first = {k[1]: r for k, r in out.items() if k[0] == "fujian_001_001_3857"}
    assert sorted(first) == list(range(57))
    assert first[10]["rings"] is None and len(first[11]["rings"]) == 2 and tuple(first[20]["rings"][0][2]) == (20.5, 1.0)
    assert first[3]["attributes"] == {"Height": None, "NAME": "n3"} and first[4]["attributes"]["Height"] == "6"
    assert out[("fujian_001_002_3857", 0)]["attributes"]["NAME"] == "福州"
    typed = layers.typed(df, "attributes", {"Height": "double"})
    assert typed.agg(F.count("Height")).first()[0] == 57
    stats = layers.read_shard_stats(spark, str(tmp_path))
    assert sorted((r["stem"], r["records"], r["srid"]) for r in stats.collect()) == [
        ("fujian_001_001_3857", 57, 3857), ("fujian_001_002_3857", 1, 3857), ("fujian_001_003_3857", 0, 3857)
    ]
    check = layers.verify_output(stats).first()
    assert (check["shards"], check["features"], check["ok"]) == (3, 58, True)

    # the index of these files, refreshed in place of an old row
    table = spark.createDataFrame([("Asia", "China", "Fujian", "old", 0.0, 0.0, 1.0, 1.0), ("Asia", "China", "Jilin", "j", 0.0, 0.0, 1.0, 1.0)],
                                  "continent string, country string, city string, shp_name string, minx double, miny double, maxx double, maxy double")
    region = table.filter("city = 'Fujian'")
    fresh, counts = publish.refresh_index(table, str(tmp_path), region)
    rows = {r["shp_name"]: r for r in fresh.collect()}
    assert sorted(rows) == ["fujian_001_001_3857", "fujian_001_002_3857", "j"]
    assert (rows["fujian_001_001_3857"]["minx"], rows["fujian_001_001_3857"]["maxx"]) == (0.0, 56.5)
    assert tuple(counts.first())[3:] == (1, 2, 1)
    assert publish.index_new_regions(table, str(tmp_path), ["Asia"]).count() == 2
    assert publish.index_new_regions(table, str(tmp_path), []).count() == 4


def test_listings(spark, tmp_path):
    for name in ["data/A/B/x_buildings_height_gba.shp", "data/A/B/x_buildings_height_gba.dbf", "data/A/_old/y_buildings_height_gba.shp",
                 "data/A/C/z_buildings_height_gba.gpkg", "data/A/D/other.txt", "data/A/E/w_buildings_height_gba_part1.shp"]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    root = str(tmp_path / "data")
    out = {r["directory"]: r for r in files.list_datasets(spark, root).collect()}
    assert sorted(out) == ["A/B", "A/C", "A/E"]
    assert out["A/B"]["shp_files"] == ["A/B/x_buildings_height_gba.shp"] and out["A/B"]["file_count"] == 2 and out["A/C"]["has_gpkg"]
    tasks = spark.createDataFrame([("1", "A/B"), ("2", "A/E"), ("3", "A/C"), ("4", "A/D")], "task_id string, download_dir string")
    assert sorted(r["task_id"] for r in files.has_merged_data(tasks, files.list_datasets(spark, root)).collect()) == ["1", "3"]
    sums = files.file_checksums(files.list_files(spark, root, "*.dbf")).first()
    assert sums["sha256"] == hashlib.sha256(b"data/A/B/x_buildings_height_gba.dbf").hexdigest() and sums["size"] == 35
    sizes = {r["suffix"]: r["files"] for r in files.component_bytes(files.list_files(spark, root), []).collect()}
    assert sizes == {".shp": 2, ".dbf": 1, ".gpkg": 1, ".txt": 1}


MANIFEST = "continent,country,city,download_dir,process_name_prefix\n"


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "gbk"])
def test_manifest(spark, tmp_path, encoding):
    path = tmp_path / "tasks.csv"
    path.write_bytes((MANIFEST + "亚洲, 中国 ,福建  省,data\\亚洲\\x/,p1\n,,,,\nAsia,Laos,\"Vien,tiane\",data/v,p2\n").encode(encoding))
    out = files.read_task_manifest(spark, str(path)).orderBy("manifest_order").collect()
    assert [(r["task_id"], r["download_dir"], r["manifest_order"]) for r in out] == [("亚洲|中国|福建 省", "data/亚洲/x", 0), ("Asia|Laos|Vien,tiane", "data/v", 1)]


@pytest.mark.parametrize("body", ["a,b,c\n1,2,3\n", MANIFEST + "A,B,,d,p\n", MANIFEST + "A,B,C,d,p\nA,B,C,e,q\n", MANIFEST])
def test_manifest_rejects(spark, tmp_path, body):
    path = tmp_path / "tasks.csv"
    path.write_text(body)
    with pytest.raises(ValueError):
        files.read_task_manifest(spark, str(path))


def test_manifest_rejects_folders_and_bytes(spark, tmp_path):
    path = tmp_path / "tasks.csv"
    path.write_text(MANIFEST + "A,B,C,../x,p\n")
    with pytest.raises(PySparkException):
        files.read_task_manifest(spark, str(path)).collect()
    path.write_bytes(MANIFEST.encode() + b"\xff\xff,B,C,d,p\n")
    with pytest.raises(ValueError):
        files.read_task_manifest(spark, str(path))


def test_overrides_file(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text('continent,country,city,kind,value,note\nAsia,Indonesia,Indonesia_west,BBOX,"95.00,-11.10,115.00,6.20",x\n,,,,,\nEurope,United_Kingdom,London,query,"{""city"": ""London""}",\n')
    out = files.read_overrides(spark, str(path)).orderBy("pos").collect()
    assert [(r["country"], r["city"], r["kind"], r["value"]) for r in out] == [
        ("indonesia", "indonesia west", "bbox", "95.00,-11.10,115.00,6.20"), ("united kingdom", "london", "query", '{"city": "London"}')
    ]


def test_records(spark, tmp_path):
    marks = {"version": 1, "rows": {"a": {"updated": True, "updated_at": "t" * 60, "note": "n" * 300}, "b": 5, "c": {"note": None}}}
    (tmp_path / "marks.json").write_text(json.dumps(marks))
    out = {r["dataset_key"]: r for r in files.read_marks(spark, str(tmp_path / "marks.json")).collect()}
    assert sorted(out) == ["a", "c"] and out["a"]["updated"] and len(out["a"]["updated_at"]) == 60 and len(out["a"]["note"]) == 300 and out["c"]["updated"] is False
    (tmp_path / "copies.json").write_text(json.dumps({"rows": {"a": {"state": "done", "copied": 3, "total": 3}}}))
    assert files.read_copy_records(spark, str(tmp_path / "copies.json")).first()["copied"] == 3
    (tmp_path / "imports.json").write_text(json.dumps({"a": {"state": "ok", "deleted": 1}, "b": []}))
    assert [(r["dataset_key"], r["deleted"]) for r in files.read_import_records(spark, str(tmp_path / "imports.json")).collect()] == [("a", 1)]


def test_completion_records(spark, tmp_path):
    good = {"grid_id": "G1", "status": "COMPLETE", "feature_count": 2, "data_semantics_version": "coverage-v2", "grid_algorithm": "national-grid-v1", "files": {"a": {"size": 1, "sha256": "x"}}}
    (tmp_path / "G1.done.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "G2.done.json").write_text(json.dumps(good))
    (tmp_path / "G3.done.json").write_text("{broken")
    (tmp_path / "other.json").write_text("{}")
    out = {r["grid_id"]: r["record_id"] for r in files.read_completion_ledger(spark, str(tmp_path)).collect()}
    assert out == {"G1": "G1", "G2": "G1"}


def test_log_lines(spark, tmp_path):
    (tmp_path / "run.log").write_bytes("甲乙\n".encode() + "丙丁\n".encode("gbk") + b"plain\n\xff\xff bad")
    out = files.read_log_lines(spark, str(tmp_path / "run.log")).orderBy("line_no").collect()
    assert [r["line"] for r in out][:3] == ["甲乙", "丙丁", "plain"] and "bad" in out[3]["line"]
    from rooftally.operators.tasks import tail_lines

    assert tail_lines(files.read_log_lines(spark, str(tmp_path / "run.log")).filter("line not like '%bad'"), 2).first()["tail"] == "丙丁 | plain"


def test_admin_layer(spark, tmp_path):
    assert layers.load_admin_layer(spark, str(tmp_path), 0) is None
    spark.createDataFrame([(0, "x")], "row_pos int, NAME string").write.parquet(str(tmp_path / "admin0"))
    assert layers.load_admin_layer(spark, str(tmp_path), 0).count() == 1


# --- writers --------------------------------------------------------------------------------------------------

def test_volumes_and_documents(spark, tmp_path):
    parts = sinks.write_volumes(spark.range(5), ["id"], str(tmp_path / "v"), 2).orderBy("part").collect()
    assert [(r["n"], r["suffix"]) for r in parts] == [(2, "_part1"), (2, "_part2"), (1, "_part3")]
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "v")).filter("part = 2").collect()) == [2, 3]
    assert sinks.write_volumes(spark.range(5), ["id"], str(tmp_path / "w"), 10).first()["suffix"] == ""
    sinks.write_documents(spark.createDataFrame([("{}",)], "document string"), str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d")).first()[0] == "{}"
    table = sinks.replace_table(spark.range(3), str(tmp_path / "t"))
    assert sinks.replace_table(table.filter("id > 0"), str(tmp_path / "t")).count() == 2
    record = sinks.completion_record(spark.createDataFrame([("k", None)], "task_id string, x string"), "task_id").first()
    assert json.loads(record["record"]) == {"task_id": "k", "x": None}


def test_task_csv(spark, tmp_path):
    import csv

    rows = spark.createDataFrame([("B", "x", "c,1", "q_1", 0.0), ("A", "y", 'd "q"', "p_1", 0.0)], "continent string, country string, city string, shp_name string, minx double")
    publish.export_tasks(rows, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    got = list(csv.reader(part.open()))
    assert got[0] == ["continent", "country", "city", "download_dir", "process_name_prefix"]
    assert got[1] == ["A", "y", 'd "q"', 'data\\A\\y\\d "q"', "p"] and got[2][2] == "c,1"


def test_index_table(spark):
    sinks.create_index_table(spark, "test_index")
    sinks.create_index_table(spark, "test_index")
    assert "continent" in spark.table("test_index").columns
    spark.sql("DROP TABLE test_index")


def test_build_region_resumes(spark, tmp_path):
    """Cells are fetched once; a lost tile, and only that, is fetched again; seams leave no copies."""
    unit = spark.createDataFrame([("u", box(0.1, 0.1, 0.9, 0.4))], f"boundary_id string, rings {RINGS}")
    shapes = [box(0.2, 0.2, 0.21, 0.21), box(0.495, 0.2, 0.505, 0.21), box(0.8, 0.2, 0.81, 0.21), box(0.2, 0.45, 0.21, 0.46), box(0.2, 0.2, 0.21, 0.21)]
    raw = spark.createDataFrame([(i, i, "7.5", s) for i, s in enumerate(shapes)], f"src_pos int, id int, height string, rings {RINGS}")
    out = str(tmp_path / "region")
    merged = build.build_region(raw, unit, out)
    assert sorted(r["GBA_ID"] for r in merged.collect()) == ["0", "1", "2"]
    tiles = spark.read.parquet(f"{out}/tiles")
    assert tiles.filter("GBA_ID = '3'").count() == 1  # raw tiles keep what lies outside the boundary
    assert tiles.filter("GBA_ID = '1'").count() == 2
    ledger = spark.read.parquet(f"{out}/ledger")
    assert {r["status"] for r in ledger.collect()} == {"COMPLETE"} and ledger.count() == 2
    again = build.build_region(raw.limit(0), unit, out)
    assert again.count() == 3 and spark.read.parquet(f"{out}/ledger").count() == 2
    for part in (tmp_path / "region" / "tiles").glob("TILE_ID=GBA_050_I0361*/*.parquet"):
        part.write_bytes(part.read_bytes() + b"x")
    build.build_region(raw, unit, out)
    assert sorted(r["grid_id"] for r in spark.read.parquet(f"{out}/ledger").collect()) == ["GBA_050_I0360_J0180", "GBA_050_I0361_J0180", "GBA_050_I0361_J0180"]
    manifest = sinks.grid_manifest(spatial.boundary_to_grid(unit, 0.5), unit, 0.5).first()
    assert manifest["expected_tile_count"] == 2 and manifest["grid_ids"] == ["GBA_050_I0360_J0180", "GBA_050_I0361_J0180"] and len(manifest["boundary_sha256"]) == 64


def test_build_region_without_features(spark, tmp_path):
    unit = spark.createDataFrame([("u", box(0.1, 0.1, 0.2, 0.2))], f"boundary_id string, rings {RINGS}")
    raw = spark.createDataFrame([], f"src_pos int, id int, height string, rings {RINGS}")
    merged = build.build_region(raw, unit, str(tmp_path / "r"))
    assert merged.count() == 0 and "GBA_ID" in merged.columns
    assert spark.read.parquet(str(tmp_path / "r" / "ledger")).first()["status"] == "EMPTY"
    assert build.build_bbox(spark.createDataFrame([(1, 5, "x", box(0, 0, 1, 1))], raw.schema), (0.5, 0.5, 2, 2)).count() == 1
    with pytest.raises(ValueError):
        build.build_place(raw, spark.createDataFrame([("p", box(0, 0, 1, 1))], f"query string, rings {RINGS}"), "q", str(tmp_path / "q"))


def test_build_many(spark):
    bounds = spark.createDataFrame([("fujian", box(0, 0, 1, 1)), ("jilin", box(1, 0, 2, 1))], f"boundary_id string, rings {RINGS}")
    shapes = [box(0.2, 0.2, 0.3, 0.3), box(0.95, 0.2, 1.05, 0.3), box(0.2, 0.2, 0.3, 0.3), box(1.5, 0.5, 1.6, 0.6)]
    raw = spark.createDataFrame(list(enumerate(shapes)), f"src_pos int, rings {RINGS}")
    tokens = spark.createDataFrame([("福建",), ("jilin",), ("hunan",)], "token string")
    summary = spark.createDataFrame([], "province string, mode string, status string, started_at string, exit_code string")
    result, states = build.build_many(raw, bounds, tokens, summary, "now", done=spark.createDataFrame([("jilin",)], "slug string"))
    assert {r["province"]: r["status"] for r in states.collect()} == {"fujian": "OK", "jilin": "SKIPPED", "hunan": "FAILED"}
    assert sorted((r["boundary_id"], r["src_pos"]) for r in result.collect()) == [("fujian", 0), ("fujian", 1)]


def test_build_many_writes_layers_and_whole_summary_rows(spark, tmp_path):
    bounds = spark.createDataFrame([("fujian", "data/f.geojson", box(0, 0, 1, 1)), ("jilin", None, box(1, 0, 2, 1))], f"boundary_id string, boundary_file string, rings {RINGS}")
    raw = spark.createDataFrame([(0, box(0.2, 0.2, 0.3, 0.3)), (1, box(1.5, 0.5, 1.6, 0.6))], f"src_pos int, rings {RINGS}")
    tokens = spark.createDataFrame([("fujian",), ("jilin",), ("hunan",)], "token string")
    summary = spark.createDataFrame([("jilin", "old")], "province string, started_at string").select("*", *[F.lit("x").alias(c) for c in ("mode", "status")])
    layers_, rows = build.build_many(raw, bounds, tokens, summary, "2024-01-02T03:04:05", out=str(tmp_path), options={"grid_size": "0.5", "merge_format": "parquet"})
    assert sorted((r["boundary_id"], r["src_pos"]) for r in layers_.collect()) == [("fujian", 0), ("jilin", 1)]
    fields = [f.split()[0] for f in schemas.RUN_SUMMARY.split(", ")]
    found = {(r["province"], r["started_at"]): r for r in rows.collect()}
    assert set(fields) <= set(rows.columns) and len(found) == 4 and found["jilin", "old"]["status"] == "x"
    fujian, hunan = found["fujian", "2024-01-02T03:04:05"], found["hunan", "2024-01-02T03:04:05"]
    assert (fujian["status"], fujian["boundary_file"], fujian["grid_size"], fujian["page_size"], fujian["exit_code"]) == ("OK", "data/f.geojson", "0.5", "", "0")
    assert spark.read.parquet(fujian["merge_output"]).count() == 1 and fujian["finished_at"] > fujian["started_at"] and int(fujian["duration_seconds"]) >= 0
    assert (hunan["status"], hunan["exit_code"], hunan["duration_seconds"], hunan["finished_at"]) == ("FAILED", "2", "0", "2024-01-02T03:04:05")


TASKS = "task_id string, continent string, country string, city string, status string, feature_count long, queue_order int, manifest_order int, existing_data_dir string, updated_at string"


def test_delivery_jobs(spark, tmp_path):
    table = spark.createDataFrame([("t1", "A", "China", "Fujian", "RUNNING", None, 1, 1, None, "x"), ("t2", "A", "China", "Jilin", "OK", 3, 2, 2, None, "x")], TASKS)
    layer = spark.createDataFrame([(i, box(i, 0, i + 1, 1)) for i in range(5)], f"src_pos int, rings {RINGS}")
    job = spark.createDataFrame([("t1", "p")], "task_id string, params string")
    queue = spark.createDataFrame([("old", "OK", 4, "[]", None, None)], "dataset_key string, status string, queue_order long, shp_files string, source_fingerprint string, finished_at string")
    updated, record, entered = publish.deliver(layer, ["src_pos"], job, table, str(tmp_path / "vol"), 2, queue)
    assert {r["task_id"]: (r["status"], r["feature_count"]) for r in updated.collect()} == {"t1": ("OK", 5), "t2": ("OK", 3)}
    told = json.loads(record.first()["record"])
    assert list(told) == fixed.DELIVERY_RECORD and told["params"] == "p" and told["city"] is None and told["feature_count"] == 5
    assert [len(spark.read.parquet(p).collect()) for p in told["shp_outputs"]] == [2, 2, 1]
    rows = {r["dataset_key"]: r for r in entered.collect()}
    assert rows["t1"]["status"] == "PENDING" and json.loads(rows["t1"]["shp_files"]) == told["shp_outputs"] and rows["t1"]["queue_order"] == 5
    empty, record, entered = publish.deliver(layer.limit(0), ["src_pos"], job, table, str(tmp_path / "none"), 2, queue)
    assert {r["task_id"]: r["status"] for r in empty.collect()}["t1"] == "OK_EMPTY" and entered.count() == 1
    assert json.loads(record.first()["record"])["shp_outputs"] == []
    rows = spark.createDataFrame([("t2", i) for i in range(5)] + [("t1", 9)], "task_id string, src_pos int")
    assert sorted((r["src_pos"], r["part"]) for r in publish.volume_numbers(table, rows, ["src_pos"], 2).collect()) == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 3)]
    old = spark.createDataFrame([("t2", "OK", 3)], "task_id string, status string, feature_count long")
    records, events = publish.backfill_volumes(table, rows, ["src_pos"], str(tmp_path / "back"), old, 2)
    told = json.loads(records.first()["record"])
    assert records.count() == 1 and (told["task_id"], told["feature_count"]) == ("t2", 3)
    assert [spark.read.parquet(p).count() for p in told["shp_outputs"]] == [2, 2, 1] and events.first()["detail"] == "parts=3"
    folders = spark.createDataFrame([("data/Fujian",), ("data/Mars",)], "directory string")
    synced, unmatched = publish.sync_existing(table, folders, ["china"], "OK")
    assert {r["task_id"]: (r["status"], r["existing_data_dir"]) for r in synced.collect()}["t1"] == ("OK", "data/Fujian")
    assert [r["directory"] for r in unmatched.collect()] == ["data/Mars"]


PROCESS = """dataset_key string, status string, queue_order long, shp_files string, source_fingerprint string, finished_at string, feature_count long,
    tile_count long, last_error string, updated_at string, shards int, task_id string"""


def test_processing_jobs(spark, tmp_path):
    table = spark.createDataFrame([("A|B|C", "OK", 1, '["d/c/x_buildings_height_gba.shp"]', "old", "2024-01-01T00:00:00", 1, 1, None, "u", 1, "A|B|C"),
                                   ("gone", "PENDING", 2, '["d/gone.shp"]', None, None, None, None, None, "u", 1, None)], PROCESS)
    candidates = spark.createDataFrame([(1, "d/c", "A|B|C", ["d/c/x_buildings_height_gba.shp"], False, None), (3, "d/c", None, ["d/c/x_buildings_height_gba.shp"], False, None),
                                        (3, "d/new", None, ["d/new/n_buildings_height_gba.shp"], False, None), (3, "d/_tmp", None, ["q.shp"], False, None), (4, "d/g", None, [], True, None)],
                                       "prio int, directory string, task_id string, shp_files array<string>, has_gpkg boolean, download_finished_at string")
    listing = spark.createDataFrame([("d/c/x_buildings_height_gba.shp", 1, 10**18), ("d/c/x_buildings_height_gba.dbf", 1, 10**18), ("d/new/n_buildings_height_gba.shp", 1, 10**18)], "path string, size long, mtime_ns long")
    manifest = spark.createDataFrame([], "task_id string, process_name_prefix string")
    out = {r["dataset_key"]: r for r in publish.sync_processing(table, candidates, listing, manifest).collect()}
    assert {k: r["status"] for k, r in out.items()} == {"A|B|C": "PENDING", "gone": "WAITING_DOWNLOAD", "EXT|d/new": "PENDING", "EXT|d/g": "BLOCKED_NO_SHP"}
    assert out["A|B|C"]["change"] == "fingerprint" and out["EXT|d/g"]["queue_order"] in (3, 4)
    layer = spark.createDataFrame([(i, "ds", 3.0, box(i, 0, i + 0.5, 1)) for i in range(4)], f"row_id int, dataset string, HEIGHT double, rings {RINGS}")
    job = spark.createDataFrame([("A|B|C", "A|B|C", "pre", "d/c")], "dataset_key string, task_id string, process_name_prefix string, source_dir string")
    downloads = spark.createDataFrame([("A|B|C", None), ("other", "x")], "task_id string, processed_3857_dir string")
    out = publish.process_one(layer, "A|B|C", table, str(tmp_path / "out"), job, downloads)
    row = {r["dataset_key"]: r for r in out["table"].collect()}["A|B|C"]
    assert (row["status"], row["tile_count"], row["feature_count"]) == ("OK", 1, 4) and out["report"].count() == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    told = json.loads(out["record"].first()["record"])
    assert list(told) == fixed.PROCESS_RECORD and (told["process_name_prefix"], told["tile_count"], told["output_dir"]) == ("pre", 1, str(tmp_path / "out"))
    assert {r["task_id"]: r["processed_3857_dir"] for r in out["tasks"].collect()} == {"A|B|C": str(tmp_path / "out"), "other": "x"}
    assert out["events"].first()["detail"] == "tiles=1 features=4"
    failed = publish.process_one(layer.drop("rings"), "A|B|C", table, str(tmp_path / "out2"), job, downloads)
    assert failed["report"] is None and failed["record"] is None and {r["dataset_key"]: r["status"] for r in failed["table"].collect()}["A|B|C"] == "FAILED"
    assert failed["events"].first()["event"] == "PROCESS_FAILED"


def test_layer_folders(spark, tmp_path):
    layer = spark.createDataFrame([(i, float(i), box(i, 0, i + 0.5, 1)) for i in range(4)], f"feature_id int, HEIGHT double, rings {RINGS}")
    masks = spark.createDataFrame([(box(-1, -1, 1.25, 2),)], f"rings {RINGS}")
    result = publish.clip_layers({"a": (layer, None), "bad": (layer.drop("rings"), None)}, masks, str(tmp_path))
    assert result["a"] == "OK" and result["bad"].startswith("FAILED")
    assert sorted(r["feature_id"] for r in spark.read.parquet(str(tmp_path / "a")).collect()) == [0, 1]
    report = publish.scale_layers({"s": layer}, 0.5, str(tmp_path)).first()
    assert (report["layer"], report["scaled_count"]) == ("s", 4)
    with pytest.raises(ValueError):
        publish.scale_layers({}, 0.5, str(tmp_path))
    sizes = spark.createDataFrame([(".shp", 10), (".shp", 10)], "suffix string, size long")
    assert publish.merge_parts([layer, layer], sizes, str(tmp_path / "m")).count() == 8
    with pytest.raises(ValueError):
        publish.merge_parts([layer, layer], sizes, str(tmp_path / "m"), limit=15)
    with pytest.raises(ValueError):
        publish.merge_parts([layer], sizes, str(tmp_path / "m"))


def test_report_bundles(spark):
    table = spark.createDataFrame([("a|x", "PENDING", 1, '["p","q"]', None, None, 1, 1, None, "u", 2, None), ("b|x", "OK", 2, "[]", None, "2024", 1, 1, None, "u", 1, None)], PROCESS)
    log = spark.createDataFrame([(1, "a|x", "PROCESS_MERGE_FAIL", "disk", dt.datetime(2024, 1, 1))], "event_id long, dataset_key string, event string, detail string, created_at timestamp")
    report = publish.processing_report(table, log)
    row = report["queue"].first()
    assert (row["shp_count"], row["merge_state"], row["merge_error"]) == (2, "error", "disk") and report["state"].first()["batch_state"] == "stopped"
    marks = spark.createDataFrame([("b|x", True, "t", "n")], "dataset_key string, updated boolean, updated_at string, note string")
    copies = spark.createDataFrame([], "dataset_key string, state string, copied int, total int")
    tasks_table = spark.createDataFrame([("b|x", "Asia", "Laos", "v", "PENDING", 1, 1, "2024", None)], "task_id string, continent string, country string, city string, status string, queue_order int, manifest_order int, finished_at string, last_error string")
    delivered = publish.delivery_report(table, marks, copies, tasks_table)
    assert delivered["counts"].first()["copy_done"] == 1 and delivered["continents"].first()["downloaded"] == 1
    assert publish.download_report(tasks_table)["queue"].first()["global_order"] == 1


def test_ring_helper():
    assert ring((0, 0), (1, 0), (1, 1))[0] == ring((0, 0), (1, 0), (1, 1))[-1]


def test_systems_belong_to_their_own_path(spark, tmp_path):
    """Equal file names in two folders keep their systems; an unknown one fails the index, a missing one is degrees."""
    for country, wkt in (("a", METRIC), ("b", DEGREES), ("c", None)):
        folder = tmp_path / "Asia" / country / "x"
        folder.mkdir(parents=True)
        write_shapefile(folder / "same", [[ring((1, 1), (2, 1), (2, 2))]], [5], wkt)
    stats = {r["path"].rsplit("/", 3)[1]: r["srid"] for r in layers.read_shard_stats(spark, str(tmp_path)).collect()}
    assert stats == {"a": 3857, "b": 4326, "c": None}
    boxes = {r["country"]: r["maxx"] for r in publish.index_rows(spark, str(tmp_path)).collect()}
    assert boxes["a"] == 2 and boxes["b"] == boxes["c"] == pytest.approx(222638.98, abs=0.1)
    table = spark.createDataFrame([("Asia", "z", "x", "old", 0.0, 0.0, 1.0, 1.0)], "continent string, country string, city string, shp_name string, minx double, miny double, maxx double, maxy double")
    with pytest.raises(ValueError, match="no shapefile"):
        publish.refresh_index(table, str(tmp_path), table)
    (tmp_path / "Asia" / "a" / "x" / "same.prj").write_text('PROJCS["Local grid"]')
    with pytest.raises(Exception, match="not recognised"):
        publish.index_rows(spark, str(tmp_path)).collect()


def test_refresh_opens_only_the_files_of_its_regions(spark, tmp_path):
    """Files of other regions are listed, never opened: they hold nothing readable here."""
    good, bad = tmp_path / "Asia" / "China" / "Fujian", tmp_path / "Asia" / "China" / "Jilin"
    good.mkdir(parents=True)
    bad.mkdir(parents=True)
    write_shapefile(good / "f", [[ring((1, 1), (2, 1), (2, 2))]], [5], METRIC)
    for suffix in ("shp", "shx", "dbf"):
        (bad / f"j.{suffix}").write_bytes(b"\xff" * 132)
    (bad / "j.prj").write_text(METRIC)
    table = spark.createDataFrame([("Asia", "China", "Jilin", "j", 0.0, 0.0, 1.0, 1.0, "old"), ("Asia", "China", "Fujian", "gone", 0.0, 0.0, 1.0, 1.0, "old")], "continent string, country string, city string, shp_name string, minx double, miny double, maxx double, maxy double, updated_at string")
    wanted = spark.createDataFrame([("Asia", "China", "Fujian")], "continent string, country string, city string")
    fresh, counts = publish.refresh_index(table.withColumn("updated_at", F.to_timestamp(F.lit("2020-01-01"))), str(tmp_path), wanted)
    rows = {r["shp_name"]: r for r in fresh.collect()}
    assert set(rows) == {"j", "f"} and (rows["f"]["minx"], rows["f"]["maxy"]) == (1.0, 2.0) and counts.first()["inserted"] == 1
    assert rows["j"]["updated_at"].year == 2020 and rows["f"]["updated_at"].year > 2020
    added = publish.index_new_regions(table.drop("updated_at"), str(tmp_path), [])
    assert {r["shp_name"] for r in added.collect()} == {"j", "gone", "f"}
