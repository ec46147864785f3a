"""Queries on task, event and processing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import table, view, with_views
from rooftally.functions import text
from rooftally.operators import reports, tasks
from rooftally.queries.registry import query

QUEUE = "queue_order NULLS LAST, manifest_order, task_id"


# --- selection and order --------------------------------------------------------------------------------------

@query(
    "select_tasks",
    with_views(
        """SELECT task_id, status FROM tasks WHERE status IN ('PENDING','RUNNING') AND lower(continent) IN ('asia','europe')
           AND (contains(lower(task_id),'t1') OR contains(lower(task_id),'nation_7'))""",
        "tasks",
    ),
)
def select_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = tasks.select_tasks(
        view(spark, sf_dir, "tasks"), only=[" T1", "nation_7", " "], continents=["Asia", "EUROPE "], statuses=tasks.status_filter()
    )
    return chosen.select("task_id", "status")


@query(
    "first_tasks",
    with_views(f"SELECT task_id, queue_order FROM tasks WHERE status='PENDING' ORDER BY {QUEUE} LIMIT 25", "tasks"),
)
def first_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tasks in queue order (a top-k)."""
    return tasks.select_tasks(view(spark, sf_dir, "tasks"), statuses=["pending"], max_tasks=25).select("task_id", "queue_order")


@query(
    "select_processing",
    with_views("SELECT dataset_key, status FROM ptasks WHERE status IN ('PENDING','FAILED') AND (contains(dataset_key,'NATION_1') OR contains(dataset_key,'C77'))", "ptasks"),
)
def select_processing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.select_processing(view(spark, sf_dir, "ptasks"), ["NATION_1", "C77"], retry_failed=True).select("dataset_key", "status")


@query("needs_merge", with_views("SELECT dataset_key, CAST(shards AS INT) AS shp_count FROM ptasks WHERE status='PENDING' AND shards>=2", "ptasks"))
def needs_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.split_runnable(tasks.select_processing(view(spark, sf_dir, "ptasks")))[1].select("dataset_key", "shp_count")


@query("find_task", with_views("SELECT task_id, status FROM tasks WHERE lower(continent)='africa' AND lower(country)='nation_15' AND lower(city)='t0'", "tasks"))
def find_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.find_task(view(spark, sf_dir, "tasks"), " Africa", "  nation_15 ", "t0").select("task_id", "status")


@query("queue_order", with_views(f"SELECT task_id, row_number() OVER (ORDER BY {QUEUE}) AS position FROM tasks", "tasks"))
def queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.queue_order(view(spark, sf_dir, "tasks")).select("task_id", "position")


@query(
    "processing_order",
    with_views("SELECT dataset_key, row_number() OVER (ORDER BY queue_order NULLS LAST, dataset_key) AS position FROM ptasks WHERE status='PENDING'", "ptasks"),
)
def processing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = view(spark, sf_dir, "ptasks").filter("status = 'PENDING'")
    return tasks.queue_order(waiting, "queue_order", "dataset_key").select("dataset_key", "position")


@query(
    "queue_search_pages",
    with_views(
        f"""WITH g AS (SELECT *, row_number() OVER (ORDER BY {QUEUE}) AS global_order FROM tasks WHERE status='PENDING'),
            f AS (SELECT *, row_number() OVER (ORDER BY global_order) AS page_order FROM g WHERE contains(lower(city),'t12'))
            SELECT task_id, global_order, page_order FROM f WHERE page_order BETWEEN 11 AND 40""",
        "tasks",
    ),
)
def queue_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = tasks.queue_search_pages(view(spark, sf_dir, "tasks"), "T12", offset=10, limit=30)
    return page.select("task_id", "global_order", "page_order")


@query(
    "front_insert",
    with_views(
        """WITH n AS (SELECT concat('N|',CAST(c_custkey AS VARCHAR)) AS task_id, c_custkey AS manifest_order FROM customer),
                k AS (SELECT count(*) AS k FROM n)
           SELECT task_id, manifest_order, queue_order+(SELECT k FROM k) AS queue_order FROM tasks
           UNION ALL SELECT task_id, manifest_order, row_number() OVER (ORDER BY manifest_order, task_id) FROM n""",
        "tasks",
    ),
)
def front_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "tasks")
    new = table(spark, sf_dir, "customer").select(F.concat(F.lit("N|"), F.col("c_custkey").cast("string")).alias("task_id"), F.col("c_custkey").alias("manifest_order"))
    return tasks.front_insert(rows, new.unionByName(rows.select("task_id", "manifest_order")))


# --- events ---------------------------------------------------------------------------------------------------

@query(
    "latest_event",
    with_views(
        """SELECT dataset_key, CASE event WHEN 'error' THEN 'error' WHEN 'signup' THEN 'error' ELSE 'done' END AS state, detail, event_id FROM
           (SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY created_at DESC, event_id DESC) AS rn FROM task_events
            WHERE event IN ('error','signup','purchase')) q WHERE rn=1""",
        "task_events",
    ),
)
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = {"error": "error", "signup": "error", "purchase": "done"}
    return tasks.latest_event(view(spark, sf_dir, "task_events"), list(states), states)


@query(
    "recent_events",
    with_views("SELECT dataset_key, event_id, event, rn AS nth FROM (SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY event_id DESC) AS rn FROM task_events) q WHERE rn<=10", "task_events"),
)
def recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.recent_events(view(spark, sf_dir, "task_events"), 10).select("dataset_key", "event_id", "event", "nth")


@query(
    "tail_lines",
    """WITH s AS (SELECT conv_id, turn, regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS line FROM conversations),
            r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM s WHERE line<>'')
       SELECT conv_id, string_agg(line, ' | ' ORDER BY turn) AS tail FROM r WHERE rn<=3 GROUP BY conv_id""",
)
def tail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line_no"), F.col("text").alias("line"))
    return tasks.tail_lines(lines, 3, "conv_id")


@query(
    "stage_progress",
    with_views(
        """WITH p AS (SELECT dataset_key, line_no, line, CASE WHEN starts_with(line,'Starting') THEN 'PREPARE' WHEN starts_with(line,'QGIS') THEN 'VALIDATE' WHEN starts_with(line,'Cleaning') THEN 'CLEAN'
                             WHEN starts_with(line,'Reproj') THEN 'REPROJECT' WHEN starts_with(line,'Completed') THEN 'VERIFY' ELSE 'SPLIT' END AS stage,
                             CASE WHEN starts_with(line,'Skipping') THEN 1 WHEN starts_with(line,'Split f') THEN CAST(regexp_extract(line,'into (\\d+) ',1) AS INT) ELSE 0 END AS tiles FROM log_lines),
                l AS (SELECT *, row_number() OVER (PARTITION BY dataset_key ORDER BY line_no DESC, stage DESC, line DESC) AS rn FROM p)
           SELECT dataset_key, max(stage) FILTER (rn=1) AS stage, max(line) FILTER (rn=1) AS stage_detail, sum(tiles) AS tiles_total FROM l GROUP BY dataset_key""",
        "log_lines",
    ),
)
def stage_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.stage_progress(view(spark, sf_dir, "log_lines"))


IMPORT_LINE = """CASE l_partkey%5 WHEN 0 THEN concat('  __IMPORT_SUMMARY__ {"deleted": ',CAST(l_linenumber AS STRING),', "inserted": ',CAST(l_suppkey AS STRING),', "skipped": 0}')
                 WHEN 1 THEN '__IMPORT_SUMMARY__ broken {' WHEN 2 THEN concat('done: 删除=',CAST(l_suppkey AS STRING),' 新增=7, 跳过=',CAST(l_linenumber AS STRING)) ELSE 'noise' END"""


@query(
    "import_summary",
    f"""WITH l AS (SELECT l_orderkey AS dataset_key, l_partkey AS line_no, l_linenumber, l_suppkey, l_partkey%5 AS kind FROM lineitem),
        r AS (SELECT *, row_number() OVER (PARTITION BY dataset_key, kind ORDER BY line_no DESC, l_linenumber DESC, l_suppkey DESC) AS last_no,
                     row_number() OVER (PARTITION BY dataset_key, kind ORDER BY line_no, l_suppkey, l_linenumber) AS first_no FROM l)
        SELECT dataset_key, coalesce(max(l_linenumber) FILTER (kind=0 AND last_no=1), max(l_suppkey) FILTER (kind=2 AND first_no=1)) AS deleted,
               coalesce(max(l_suppkey) FILTER (kind=0 AND last_no=1), max(7) FILTER (kind=2 AND first_no=1)) AS inserted,
               coalesce(max(0) FILTER (kind=0 AND last_no=1), max(l_linenumber) FILTER (kind=2 AND first_no=1)) AS skipped FROM r GROUP BY dataset_key""",
)
def import_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("dataset_key"), F.col("l_partkey").alias("line_no"), F.expr(IMPORT_LINE).alias("line"))
    return reports.import_summary(lines)


# --- state changes --------------------------------------------------------------------------------------------

@query(
    "apply_status",
    with_views(
        """SELECT task_id, CASE WHEN manifest_order%3=0 THEN CASE WHEN manifest_order%2=0 THEN 'FAILED' ELSE 'OK_EMPTY' END ELSE status END AS status,
                  CASE WHEN manifest_order%3=0 THEN CASE WHEN manifest_order%6=0 THEN NULL ELSE manifest_order END ELSE 1 END AS attempts,
                  CASE WHEN manifest_order%3=0 THEN 'new' ELSE 'old' END AS updated_at FROM tasks""",
        "tasks",
    ),
)
def apply_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "tasks").withColumns({"attempts": F.lit(1).cast("long"), "updated_at": F.lit("old")})
    updates = rows.filter("manifest_order % 3 = 0").select(
        "task_id", F.when(F.col("manifest_order") % 2 == 0, "FAILED").otherwise("OK_EMPTY").alias("status"),
        F.when(F.col("manifest_order") % 6 != 0, F.col("manifest_order")).alias("attempts"),
    )
    changed = tasks.apply_status(rows, updates, "task_id", stamp=F.lit("new"))
    return changed.select("task_id", "status", "attempts", "updated_at")


@query(
    "reset_running",
    with_views(
        """SELECT task_id, CASE WHEN status='RUNNING' AND manifest_order%2=0 THEN 'PENDING' ELSE status END AS status,
                  CASE WHEN status='RUNNING' AND manifest_order%2=0 THEN NULL ELSE finished_at END AS finished_at FROM tasks""",
        "tasks",
    ),
)
def reset_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "tasks")
    return tasks.reset_running(rows, rows.filter("manifest_order % 2 = 0"))[0].select("task_id", "status", "finished_at")


@query("requeue_events", with_views("SELECT task_id, 'BATCH_REQUEUE' AS event, 'stopped' AS detail FROM tasks WHERE status='RUNNING'", "tasks"))
def requeue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.reset_running(view(spark, sf_dir, "tasks"), detail="stopped")[1].select("task_id", "event", "detail")


@query(
    "write_back",
    with_views("SELECT task_id, CASE WHEN manifest_order%4=0 THEN concat('out/',city) ELSE 'none' END AS processed_3857_dir FROM tasks", "tasks"),
)
def write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "tasks").withColumn("processed_3857_dir", F.lit("none"))
    done = rows.filter("manifest_order % 4 = 0").select("task_id", F.concat(F.lit("out/"), "city").alias("path"))
    unknown = done.select(F.concat("task_id", F.lit("?")).alias("task_id"), "path")
    return tasks.write_back_path(rows, done.unionByName(unknown)).select("task_id", "processed_3857_dir")


MANIFEST_SQL = """
    m AS (SELECT task_id, concat('d/', CASE WHEN manifest_order%10=0 THEN 'moved' ELSE city END) AS download_dir, manifest_order + CASE WHEN manifest_order%7=0 THEN 1 ELSE 0 END AS manifest_order
          FROM tasks WHERE manifest_order%5<>1 UNION ALL SELECT concat('new|',CAST(c_custkey AS VARCHAR)), 'd/x', c_custkey FROM customer),
    t AS (SELECT task_id, status, queue_order, concat('d/',city) AS download_dir, manifest_order FROM tasks),
    d AS (SELECT m.*, t.task_id IS NULL AS added, t.task_id IS NOT NULL AND (m.download_dir<>t.download_dir OR m.manifest_order<>t.manifest_order) AS updated,
                 t.task_id IS NOT NULL AND m.download_dir<>t.download_dir AND t.status IN ('OK','OK_EMPTY') AS reset FROM m LEFT JOIN t ON m.task_id=t.task_id)"""


def manifest_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf_dir, "tasks")
    folder = F.concat(F.lit("d/"), F.when(F.col("manifest_order") % 10 == 0, "moved").otherwise(F.col("city")))
    listed = rows.filter("manifest_order % 5 <> 1").select(
        "task_id", folder.alias("download_dir"), (F.col("manifest_order") + F.when(F.col("manifest_order") % 7 == 0, 1).otherwise(0)).alias("manifest_order")
    )
    new = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("new|"), F.col("c_custkey").cast("string")).alias("task_id"), F.lit("d/x").alias("download_dir"), F.col("c_custkey").alias("manifest_order")
    )
    return listed.unionByName(new), rows.withColumn("download_dir", F.concat(F.lit("d/"), "city"))


@query("manifest_diff", with_views(f"WITH {MANIFEST_SQL} SELECT task_id, added, updated, reset FROM d", "tasks"))
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.manifest_diff(*manifest_rows(spark, sf_dir)).select("task_id", "added", "updated", "reset")


@query(
    "sync_manifest",
    with_views(
        f"""WITH {MANIFEST_SQL}
            SELECT t.task_id, CASE WHEN coalesce(d.reset,false) THEN 'PENDING' ELSE t.status END AS status, CASE WHEN coalesce(d.updated,false) THEN d.download_dir ELSE t.download_dir END AS download_dir,
                   t.queue_order+(SELECT count(*) FROM d WHERE added) AS queue_order FROM t LEFT JOIN d ON t.task_id=d.task_id
            UNION ALL SELECT task_id, 'PENDING', download_dir, row_number() OVER (ORDER BY manifest_order, task_id) FROM d WHERE added""",
        "tasks",
    ),
)
def sync_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, rows = manifest_rows(spark, sf_dir)
    named = listed.join(rows.select("task_id", "continent", "country", "city"), "task_id", "left")
    return tasks.sync_manifest(named, rows).select("task_id", "status", "download_dir", "queue_order")


# --- sources --------------------------------------------------------------------------------------------------

FOUND_SQL = """
    f AS (SELECT CASE WHEN c_custkey%10=0 THEN concat(dataset_key,'+') ELSE dataset_key END AS dataset_key, 'PENDING' AS status,
                 CASE WHEN c_custkey%3=0 THEN '[]' ELSE '["n.shp"]' END AS shp_files, concat('fp',CAST(c_custkey%89 AS VARCHAR)) AS fp,
                 CASE WHEN c_custkey%4=0 THEN '2024-01-15T00:00:00' WHEN c_custkey%4=1 THEN 'later' END AS files_at,
                 CASE WHEN c_custkey%8=0 THEN '2024-01-20T09:00:00' END AS loaded_at FROM ptasks WHERE c_custkey%11<>0),
    j AS (SELECT coalesce(p.dataset_key,f.dataset_key) AS dataset_key, p.dataset_key IS NOT NULL AS known, f.dataset_key IS NOT NULL AS seen, p.status, f.status AS fstatus, p.queue_order,
                 p.shp_files, f.shp_files AS ffiles, p.finished_at,
                 CASE WHEN p.status='OK' AND f.dataset_key IS NOT NULL THEN CASE WHEN coalesce(TRY_CAST(loaded_at AS TIMESTAMP)>CAST(p.finished_at AS TIMESTAMP), loaded_at>p.finished_at, false) THEN 'download'
                      WHEN p.source_fingerprint IS NOT NULL AND p.source_fingerprint<>fp THEN 'fingerprint'
                      WHEN p.source_fingerprint IS NULL AND coalesce(TRY_CAST(files_at AS TIMESTAMP)>CAST(p.finished_at AS TIMESTAMP), files_at>p.finished_at, false) THEN 'files' END END AS reason
          FROM ptasks p FULL JOIN f ON p.dataset_key=f.dataset_key),
    u AS (SELECT *, CASE WHEN NOT known THEN 'added' WHEN NOT seen THEN NULL WHEN reason IS NOT NULL THEN reason
                         WHEN status IN ('BLOCKED_NO_SHP','WAITING_DOWNLOAD') AND ffiles<>'[]' THEN 'resumed' END AS change FROM j)"""


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    return view(spark, sf_dir, "ptasks").filter("c_custkey % 11 <> 0").select(
        F.when(n % 10 == 0, F.concat("dataset_key", F.lit("+"))).otherwise(F.col("dataset_key")).alias("dataset_key"), F.lit("PENDING").alias("status"),
        F.when(n % 3 == 0, "[]").otherwise('["n.shp"]').alias("shp_files"), F.concat(F.lit("fp"), (n % 89).cast("string")).alias("source_fingerprint"),
        F.when(n % 4 == 0, "2024-01-15T00:00:00").when(n % 4 == 1, "later").alias("source_updated_at"),
        F.when(n % 8 == 0, "2024-01-20T09:00:00").alias("download_finished_at"),
    )


@query(
    "upsert_source",
    with_views(
        f"""WITH {FOUND_SQL}, mx AS (SELECT max(queue_order) AS m FROM ptasks)
            SELECT dataset_key, change, CASE WHEN NOT known THEN fstatus WHEN change IS NOT NULL THEN 'PENDING' ELSE status END AS status,
                   CASE WHEN seen THEN ffiles ELSE shp_files END AS shp_files,
                   CASE WHEN known THEN queue_order ELSE (SELECT m FROM mx)+row_number() OVER (PARTITION BY known ORDER BY dataset_key) END AS queue_order FROM u""",
        "ptasks",
    ),
)
def upsert_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = tasks.upsert_source(view(spark, sf_dir, "ptasks"), discovered(spark, sf_dir))
    return merged.select("dataset_key", "change", "status", "shp_files", "queue_order")


@query("source_change", with_views(f"WITH {FOUND_SQL} SELECT dataset_key, reason FROM j WHERE known AND seen", "ptasks"))
def source_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discovered(spark, sf_dir).select(
        "dataset_key", F.col("source_fingerprint").alias("new_fingerprint"), F.col("source_updated_at").alias("new_source_updated_at"),
        F.col("download_finished_at").alias("new_download_finished_at"),
    )
    rows = view(spark, sf_dir, "ptasks").join(found, "dataset_key")
    return rows.select("dataset_key", tasks.source_change(rows).alias("reason"))


@query(
    "reconcile_orphans",
    with_views(
        """SELECT dataset_key, CASE WHEN o THEN 'WAITING_DOWNLOAD' ELSE status END AS status, CASE WHEN o THEN '[]' ELSE shp_files END AS shp_files
           FROM (SELECT *, status='PENDING' AND c_custkey%13<>0 AND NOT (shards>=2) AS o FROM ptasks) q""",
        "ptasks",
    ),
)
def reconcile_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only ``b.shp`` exists, so rows with two shards or more keep a file."""
    rows = view(spark, sf_dir, "ptasks")
    existing = spark.sql("SELECT 'b.shp' AS path")
    result = tasks.reconcile_orphans(rows, rows.filter("c_custkey % 13 = 0"), existing)
    return result.select("dataset_key", "status", "shp_files")


@query(
    "discover_sources",
    with_views(
        """WITH c AS (SELECT c_custkey AS n, dataset_key, country FROM ptasks),
                a AS (SELECT 1 AS prio, dataset_key AS task_id, concat('data/',country,'/',CAST(n AS VARCHAR)) AS directory, n%3 AS shards, n%2=0 AS gpkg FROM c WHERE n%4=0
                      UNION ALL SELECT 2, dataset_key, concat('data/',country,'/',CASE WHEN n%6=0 THEN '_' ELSE '' END,CAST(n AS VARCHAR)), n%3, n%2=0 FROM c WHERE n%4<2
                      UNION ALL SELECT 3, NULL, concat('data/',country,'/',CAST(n AS VARCHAR)), 1, false FROM c
                      UNION ALL SELECT 4, NULL, concat('data/',country,'/',CAST(n AS VARCHAR)), 2, true FROM c WHERE n%5=0),
                v AS (SELECT * FROM a WHERE NOT contains(directory,'/_') AND (shards>0 OR gpkg)),
                w AS (SELECT * FROM v WHERE prio<>3 OR directory NOT IN (SELECT directory FROM v WHERE prio<=2)),
                r AS (SELECT *, coalesce(task_id, concat('EXT|',directory)) AS key, row_number() OVER (PARTITION BY coalesce(task_id, concat('EXT|',directory)) ORDER BY prio, directory) AS rn FROM w)
           SELECT key AS dataset_key, directory, CASE WHEN shards=0 THEN 'BLOCKED_NO_SHP' ELSE 'PENDING' END AS status, shards FROM r WHERE rn=1""",
        "ptasks",
    ),
)
def discover_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "ptasks")
    number = F.col("c_custkey")
    folder = F.concat(F.lit("data/"), "country", F.lit("/"), number.cast("string"))
    hidden = F.concat(F.lit("data/"), "country", F.lit("/"), F.when(number % 6 == 0, "_").otherwise(""), number.cast("string"))

    def part(prio: int, condition: str, task, directory, shards, gpkg) -> DataFrame:
        files = F.transform(F.when(shards > 0, F.sequence(F.lit(1), shards)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("s"), i.cast("string")))
        return rows.filter(condition).select(
            F.lit(prio).alias("prio"), task.alias("task_id"), directory.alias("directory"), files.alias("shp_files"), gpkg.alias("has_gpkg")
        )

    key, none = F.col("dataset_key"), F.lit(None).cast("string")
    counted = (number % 3).cast("int")
    pool = part(1, "c_custkey % 4 = 0", key, folder, counted, number % 2 == 0)
    pool = pool.unionByName(part(2, "c_custkey % 4 < 2", key, hidden, counted, number % 2 == 0))
    pool = pool.unionByName(part(3, "true", none, folder, F.lit(1), F.lit(False))).unionByName(part(4, "c_custkey % 5 = 0", none, folder, F.lit(2), F.lit(True)))
    found = tasks.discover_sources(pool)
    return found.select("dataset_key", "directory", "status", F.size("shp_files").alias("shards"))


@query(
    "fingerprint",
    """WITH f AS (SELECT o_custkey, concat('data/c',CAST(o_custkey AS VARCHAR),'/p',CAST(o_orderkey AS VARCHAR),CASE WHEN o_orderkey%2=0 THEN '.shp' ELSE '.dbf' END) AS path,
                         CAST(floor(o_totalprice) AS BIGINT) AS size, CAST(epoch_us(o_orderdate) AS BIGINT)*1000 AS mtime_ns FROM orders)
       SELECT o_custkey AS dataset_key, sha256(concat('[', string_agg(concat('["',path,'",',size,',',mtime_ns,']'), ',' ORDER BY path), ']')) AS source_fingerprint,
              max(mtime_ns) AS latest_mtime_ns, count(*) AS files FROM f GROUP BY 1""",
)
def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, order = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    suffix = F.when(order % 2 == 0, ".shp").otherwise(".dbf")
    # whatever the time zone of the session is
    whole_seconds = F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long") * 86_400 + F.hour("o_orderdate") * 3600 + F.minute("o_orderdate") * 60 + F.second("o_orderdate")
    files = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("dataset_key"), F.concat(F.lit("data/c"), key, F.lit("/p"), order.cast("string"), suffix).alias("path"),
        F.floor("o_totalprice").alias("size"), (whole_seconds * 1_000_000_000).alias("mtime_ns"),
    )
    return tasks.source_fingerprint(files)


# --- checks ---------------------------------------------------------------------------------------------------

@query(
    "set_compare",
    """WITH e AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_linenumber<=4 AND l_suppkey%10<>3),
            a AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_linenumber>=2 OR l_suppkey%7=0),
            j AS (SELECT coalesce(e.s,a.s) AS s, e.p AS ep, a.p AS ap FROM e FULL JOIN a ON e.s=a.s AND e.p=a.p)
       SELECT s AS l_suppkey, count(ep) AS expected, count(ap) AS actual, count(*) FILTER (ap IS NULL) AS missing, count(*) FILTER (ep IS NULL) AS extra,
              count(ep)>0 AND count(*) FILTER (ap IS NULL)=0 AND count(*) FILTER (ep IS NULL)=0 AS consistent FROM j GROUP BY s""",
)
def set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", F.col("l_partkey").alias("name"))
    expected = rows.filter("l_linenumber <= 4 AND l_suppkey % 10 <> 3")
    return tasks.compare_sets(expected, rows.filter("l_linenumber >= 2 OR l_suppkey % 7 = 0"), by=["l_suppkey"])


@query(
    "publish_ready",
    with_views(
        """WITH s AS (SELECT grid_id, concat(name,'.shp') AS name, size FROM ledger_files), t AS (SELECT grid_id, concat(name,'.shp') AS name, size FROM stored_files)
           SELECT s.grid_id, count(*) FILTER (t.size IS NULL OR t.size<>s.size) AS missing, count(*) AS files,
                  count(*) FILTER (t.size IS NULL OR t.size<>s.size)=0 AND s.grid_id IN (SELECT grid_id FROM t) AS ready
           FROM s LEFT JOIN t ON s.grid_id=t.grid_id AND s.name=t.name GROUP BY s.grid_id""",
        "ledger_files", "stored_files",
    ),
)
def publish_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    def named(name: str) -> DataFrame:
        return view(spark, sf_dir, name).select("grid_id", F.concat("name", F.lit(".shp")).alias("name"), "size")

    return tasks.publish_ready(named("ledger_files"), named("stored_files"), ["grid_id"])


@query(
    "verify_success",
    with_views(
        """SELECT task_id FROM tasks WHERE status IN ('OK','OK_EMPTY') AND (manifest_order%4=0 OR manifest_order%5=0 OR manifest_order%7=0) AND manifest_order%9<>0""",
        "tasks",
    ),
)
def verify_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No record, another folder, or another size; some of these are available anyway."""
    order = F.col("manifest_order")
    rows = view(spark, sf_dir, "tasks").select(
        "task_id", "status", "manifest_order", F.concat(F.lit("d/"), "city").alias("download_dir"), F.concat(F.lit("d/m/"), "city").alias("merge_output"),
        order.alias("merge_size"), F.lit("representative-point").alias("boundary_filter"), F.lit(0.0).alias("buffer_m"),
    )
    markers = rows.filter("manifest_order % 4 <> 0").withColumns(
        {
            "download_dir": F.when(order % 5 == 0, "elsewhere").otherwise(F.col("download_dir")),
            "merge_size": F.when(order % 7 == 0, order + 1).when(order % 2 == 0, order),
        }
    )
    available = rows.filter("manifest_order % 9 = 0").select(F.col("task_id").alias("dataset_key"))
    return tasks.verify_success(rows, markers, available).select("task_id")


@query(
    "text_values",
    with_views(
        """SELECT dataset_key, CAST(shards AS INT) AS shp_count, CASE WHEN c_custkey%3=0 THEN finished_at WHEN c_custkey%3=1 THEN 'x' ELSE '' END AS completed,
                  CASE WHEN c_custkey%4=0 THEN false WHEN c_custkey%4=1 THEN finished_at>'2024-01-10T00:00:00' ELSE true END AS later,
                  CASE c_custkey%3 WHEN 0 THEN '切分' WHEN 1 THEN 'OTHER' ELSE '-' END AS label, "left"(note, 4) AS note FROM ptasks""",
        "ptasks",
    ),
)
def text_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    finished = F.when(n % 3 == 0, F.col("finished_at")).when(n % 3 == 2, "")
    updated = F.when(n % 3 == 1, "x")
    candidate = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, F.col("finished_at")).otherwise("zzz")
    stage = F.when(n % 3 == 0, "SPLIT").when(n % 3 == 1, "OTHER").otherwise("")
    return view(spark, sf_dir, "ptasks").select(
        "dataset_key", text.json_list_size(F.col("shp_files")).alias("shp_count"), text.completion_time(finished, updated).alias("completed"),
        text.is_later(candidate, F.lit("2024-01-10T00:00:00")).alias("later"), text.stage_label(stage).alias("label"),
        text.trim_note(F.concat(F.lit("  "), "note"), 4).alias("note"),
    )
