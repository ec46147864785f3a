"""Schemas of the canonical tables, as DDL texts for ``spark.read.schema`` and ``from_json``."""

POINT = "struct<x:double,y:double>"

BUILDINGS = f"""GBA_ID string, Height double, H_VAR double, SOURCE string, REGION string, TILE_ID string, src_pos long,
    rings array<array<{POINT}>>, minx double, miny double, maxx double, maxy double"""

FOOTPRINT_INDEX = """continent string, country string, city string, shp_name string, minx double, miny double, maxx double,
    maxy double, srid int, updated_at timestamp"""

TILE_LEDGER = """grid_id string, status string, feature_count long, data_semantics_version string, grid_algorithm string,
    crs string, bbox array<double>, files map<string,struct<size:long,sha256:string>>, finished_at string"""

TASK_MANIFEST = "continent string, country string, city string, download_dir string, process_name_prefix string"

TASKS = """task_id string, continent string, country string, city string, download_dir string, manifest_order long,
    queue_order long, status string, attempts int, exit_code int, feature_count long, merge_output string,
    boundary_source string, existing_data_dir string, processed_3857_dir string, last_error string, started_at string,
    finished_at string, duration_seconds long, updated_at string, redownload_count int"""

PROCESS_TASKS = """dataset_key string, task_id string, display_name string, process_name_prefix string, source_dir string,
    status string, attempts int, feature_count long, tile_count long, shp_files string, stage string, stage_detail string,
    tiles_done int, tiles_total int, last_log string, last_error string, log_file string, input_dir string,
    output_dir string, started_at string, finished_at string, duration_seconds long, updated_at string, note string,
    queue_order long, source_fingerprint string, source_updated_at string, download_finished_at string"""

EVENTS = "event_id long, dataset_key string, event string, detail string, created_at timestamp"

MARK = "struct<updated:boolean,updated_at:string,note:string>"
COPY_RECORD = """struct<state:string,copied:int,total:int,source_dir:string,share_dir:string,started_at:string,
    finished_at:string,error:string,log_path:string>"""
IMPORT_RECORD = """struct<state:string,message:string,error:string,log_tail:string,updated_at:string,deleted:int,
    inserted:int,skipped:int>"""

RUN_SUMMARY = ", ".join(
    f"{name} string"
    for name in (
        "province", "mode", "boundary_file", "output_dir", "merge_output", "grid_size", "page_size", "tile_format",
        "merge_format", "status", "exit_code", "started_at", "finished_at", "duration_seconds",
    )
)

FEATURE_COLLECTION = """type string, numberMatched long,
    features array<struct<id:string,type:string,properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"""
FEATURE = "id string, type string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
