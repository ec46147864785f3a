"""Queries on the footprint index."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.fixtures import view, with_views
from rooftally.functions import geometry as geo
from rooftally.operators import index
from rooftally.plans import publish
from rooftally.queries.registry import query
from rooftally.queries.spatial import BOX_KEY, KEEP_FIRST, MERCATOR_Y, buildings
from rooftally.session import shared_folder

KEYS = "continent, country, city, shp_name"
BOXES = "minx, miny, maxx, maxy"


@query(
    "bbox_wkt",
    with_views(
        """SELECT shp_name, concat('POLYGON((',minx,' ',miny,',',maxx,' ',miny,',',maxx,' ',maxy,',',minx,' ',maxy,',',minx,' ',miny,'))') AS bbox_wkt FROM idx""",
        "idx",
    ),
)
def bbox_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.with_bbox_wkt(view(spark, sf_dir, "idx")).select("shp_name", "bbox_wkt")


@query("wkt_round_trip", with_views(f"SELECT shp_name, {BOXES} FROM idx", "idx"))
def wkt_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box to text, text to rings, bounds of those."""
    boxes = index.with_bbox_wkt(view(spark, sf_dir, "idx")).select("shp_name", "bbox_wkt")
    return boxes.select("shp_name", geo.bounds_of(geo.rings_from_wkt(F.col("bbox_wkt"))).alias("b")).select("shp_name", "b.*")


@query(
    "shards_intersecting",
    with_views(f"SELECT {KEYS} FROM idx WHERE minx<=11500000 AND maxx>=10500000 AND miny<=2800000 AND maxy>=2200000", "idx"),
)
def shards_intersecting(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.shards_intersecting(view(spark, sf_dir, "idx"), 10_500_000, 2_200_000, 11_500_000, 2_800_000)
    return found.select("continent", "country", "city", "shp_name")


@query(
    "shards_in_degrees",
    with_views(
        f"""SELECT {KEYS} FROM idx WHERE minx<=6378137*radians(101.5) AND maxx>=6378137*radians(93.25)
            AND miny<={MERCATOR_Y.format('24.75')} AND maxy>={MERCATOR_Y.format('19.5')}""",
        "idx",
    ),
)
def shards_in_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = index.shards_intersecting(view(spark, sf_dir, "idx"), 93.25, 19.5, 101.5, 24.75, srid=4326)
    return found.select("continent", "country", "city", "shp_name")


@query(
    "export_rectangle",
    with_views(
        """WITH f AS (SELECT * FROM bld WHERE x0<=106 AND x0+w>=104 AND y0<=27 AND y0+h>=22)
           SELECT id, height, source FROM (SELECT *, row_number() OVER (PARTITION BY x0,y0,w,h ORDER BY id, height NULLS LAST, source NULLS LAST) AS rn FROM f) d
           WHERE rn=1""",
        "bld",
    ),
)
def export_rectangle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the layer's own shards picks the shards, the features are tested exactly, copies removed."""
    from rooftally.operators.quality import dedup_geometry

    shard = F.concat(F.floor(F.col("x0")).cast("string"), F.lit("_"), F.floor(F.col("y0")).cast("string"))
    features = buildings(spark, sf_dir).withColumn("shard", shard)
    shards = index.layer_bounds(features, ["shard"], metric=False)
    found = index.export_rectangle(shards, features, (104, 22, 106, 27), ["shard"])
    return dedup_geometry(found, KEEP_FIRST, key=BOX_KEY).select("id", "height", "source")


@query(
    "split4",
    with_views(
        """WITH m AS (SELECT shp_name, minx, miny, maxx, maxy, (minx+maxx)/2 AS cx, (miny+maxy)/2 AS cy FROM idx)
           SELECT shp_name, 0 AS quarter, minx, miny, cx AS maxx, cy AS maxy FROM m UNION ALL SELECT shp_name, 1, cx, miny, maxx, cy FROM m
           UNION ALL SELECT shp_name, 2, minx, cy, cx, maxy FROM m UNION ALL SELECT shp_name, 3, cx, cy, maxx, maxy FROM m""",
        "idx",
    ),
)
def split4(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = view(spark, sf_dir, "idx")
    quarters = geo.quarter_boxes(*[F.col(c) for c in ("minx", "miny", "maxx", "maxy")])
    return boxes.select("shp_name", F.explode(quarters).alias("q")).select("shp_name", "q.*")


@query(
    "box_measures",
    with_views(
        """WITH b AS (SELECT minx-20011 AS k, minx AS b0, miny AS b1, maxx AS b2, maxy AS b3 FROM idx)
           SELECT shp_name, round(sqrt(greatest(minx-b2,b0-maxx,0)**2+greatest(miny-b3,b1-maxy,0)**2),6) AS gap,
                  round((greatest(maxx,b2)-least(minx,b0))*(greatest(maxy,b3)-least(miny,b1))/((maxx-minx)*(maxy-miny)+(b2-b0)*(b3-b1)),9) AS ratio
           FROM idx JOIN b ON minx=k""",
        "idx",
    ),
)
def box_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap and expansion ratio between each shard and the next one."""
    shards = view(spark, sf_dir, "idx")
    names = ("minx", "miny", "maxx", "maxy")
    following = shards.select((F.col("minx") - 20011).alias("_k"), *[F.col(c).alias("b" + c) for c in names])
    pairs = shards.join(following, F.col("minx") == F.col("_k"))
    a, b = {c: F.col(c) for c in names}, {c: F.col("b" + c) for c in names}
    return pairs.select("shp_name", F.round(geo.box_gap(a, b), 6).alias("gap"), F.round(geo.expansion_ratio(a, b), 9).alias("ratio"))


@query(
    "distinct_tasks",
    with_views(
        """SELECT DISTINCT trim(continent) AS continent, trim(country) AS country, trim(city) AS city, split_part(trim(shp_name),'_',1) AS process_name_prefix
           FROM idx WHERE trim(shp_name)<>'' AND split_part(trim(shp_name),'_',1)<>''""",
        "idx",
    ),
)
def distinct_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = view(spark, sf_dir, "idx").withColumns({c: F.concat(F.lit(" "), c, F.lit("  ")) for c in ("continent", "city", "shp_name")})
    return index.distinct_tasks(padded)


@query(
    "export_tasks",
    with_views(
        """SELECT DISTINCT continent, country, city, concat('data',chr(92),continent,chr(92),country,chr(92),city) AS download_dir,
                  split_part(shp_name,'_',1) AS process_name_prefix FROM idx""",
        "idx",
    ),
)
def export_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task list as the job writes it, read back from its CSV files."""
    path = f"{shared_folder(spark).rstrip('/')}/tasks-{uuid.uuid4().hex}"
    publish.export_tasks(view(spark, sf_dir, "idx"), path)
    return spark.read.option("header", "true").option("escape", '"').csv(path)


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_partkey) AS first_row, max(l_partkey) AS last_row
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rooftally.fixtures import table

    return index.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey")


PAGE = 40


@query(
    "shard_list",
    with_views(
        f"""WITH p AS (SELECT path, (row_number() OVER (ORDER BY path)-1)//{PAGE} AS page FROM
                       (SELECT concat_ws('/',continent,country,city,shp_name) AS path FROM idx) q)
            SELECT page, count(*) AS n, concat('{{"list":["', string_agg(path, '","' ORDER BY path), '"]}}') AS document FROM p GROUP BY page""",
        "idx",
    ),
)
def shard_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.shard_list_json(view(spark, sf_dir, "idx"), PAGE)


@query(
    "feature_collection",
    with_views(
        f"""WITH p AS (SELECT shp_name, (row_number() OVER (ORDER BY shp_name)-1)//{PAGE} AS page,
                   concat('{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[[',a,',',b,'],[',c,',',b,'],[',c,',',d,'],[',a,',',d,'],[',a,',',b,']]]}},"properties":{{"country":"',
                          country,'","shp_name":"',shp_name,'"}}}}') AS f
                   FROM (SELECT *, CAST(minx AS BIGINT) AS a, CAST(miny AS BIGINT) AS b, CAST(maxx AS BIGINT) AS c, CAST(maxy AS BIGINT) AS d FROM idx) q)
            SELECT page, count(*) AS n, concat('{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"EPSG:3857"}}}},"features":[',
                   string_agg(f, ',' ORDER BY shp_name), ']}}') AS document FROM p GROUP BY page""",
        "idx",
    ),
)
def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a fixed number of features with their boxes as rings, in whole metres."""
    edges = ["minx", "miny", "maxx", "maxy"]
    rows = view(spark, sf_dir, "idx").select("country", "shp_name", *edges)
    corners = [("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"), ("minx", "miny")]
    ring = F.array(*[F.array(F.col(x).cast("long"), F.col(y).cast("long")) for x, y in corners])
    geometry = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
    return index.to_feature_collection(rows, geometry, edges, ["shp_name"], page_size=PAGE)


# --- upkeep ---------------------------------------------------------------------------------------------------

def changed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(index, recomputed rows): boxes moved, some shards new, some without a box."""
    rows = view(spark, sf_dir, "idx")
    moved = rows.filter("city <> 'City_0'").withColumns(
        {
            "shp_name": F.when(F.col("minx") % 4 == 0, F.concat("shp_name", F.lit("_b"))).otherwise(F.col("shp_name")),
            "minx": F.when(F.col("minx") % 7 != 0, F.col("minx") + 5),
        }
    )
    return rows, moved


MOVED = f"""moved AS (SELECT continent, country, city, CASE WHEN minx%4=0 THEN concat(shp_name,'_b') ELSE shp_name END AS shp_name,
                     CASE WHEN minx%7<>0 THEN minx+5 END AS minx, miny, maxx, maxy FROM idx WHERE city<>'City_0')"""
REGIONS = "regions AS (SELECT DISTINCT continent, country, city FROM idx WHERE city='City_1')"


@query(
    "replace_region",
    with_views(
        f"""WITH {MOVED} SELECT {KEYS}, {BOXES} FROM idx WHERE city<>'City_1' UNION ALL SELECT {KEYS}, {BOXES} FROM moved WHERE city='City_1'""",
        "idx",
    ),
)
def replace_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, moved = changed(spark, sf_dir)
    return index.replace_region(rows, moved, rows.filter("city = 'City_1'"))


@query(
    "replace_counts",
    with_views(
        f"""WITH {MOVED}, u AS (SELECT continent, country, city, 1 AS d, 0 AS i, 0 AS s FROM idx WHERE city='City_1'
                  UNION ALL SELECT continent, country, city, 0, CASE WHEN minx IS NULL THEN 0 ELSE 1 END, CASE WHEN minx IS NULL THEN 1 ELSE 0 END
                  FROM moved WHERE city='City_1')
            SELECT continent, country, city, sum(d) AS deleted, sum(i) AS inserted, sum(s) AS skipped FROM u GROUP BY 1, 2, 3""",
        "idx",
    ),
)
def replace_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, moved = changed(spark, sf_dir)
    return index.replace_counts(rows, moved, rows.filter("city = 'City_1'"))


@query(
    "insert_if_absent",
    with_views(
        f"""WITH {MOVED} SELECT {KEYS}, {BOXES} FROM idx UNION ALL
            SELECT {KEYS}, {BOXES} FROM moved m WHERE NOT EXISTS (SELECT 1 FROM idx i WHERE i.continent=m.continent AND i.country=m.country
                                                        AND i.city=m.city AND i.shp_name=m.shp_name)""",
        "idx",
    ),
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.insert_if_absent(*changed(spark, sf_dir))


@query(
    "upsert_rows",
    with_views(
        f"""WITH {MOVED} SELECT {KEYS}, {BOXES} FROM moved UNION ALL
            SELECT {KEYS}, {BOXES} FROM idx i WHERE NOT EXISTS (SELECT 1 FROM moved m WHERE i.continent=m.continent AND i.country=m.country
                                                        AND i.city=m.city AND i.shp_name=m.shp_name)""",
        "idx",
    ),
)
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, moved = changed(spark, sf_dir)
    return index.upsert_rows(rows, moved, index.INDEX_KEY)


@query(
    "delete_keys",
    with_views(
        f"""WITH {MOVED} SELECT {KEYS}, {BOXES} FROM idx i WHERE shp_name NOT IN (SELECT shp_name FROM moved)""", "idx"
    ),
)
def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, moved = changed(spark, sf_dir)
    return index.delete_keys(rows, moved, ["shp_name"])


@query(
    "reset_marks",
    with_views(
        """SELECT m.dataset_key, m.updated AND p.dataset_key IS NULL AS updated, CASE WHEN p.dataset_key IS NULL THEN m.updated_at ELSE '' END AS updated_at
           FROM marks m LEFT JOIN (SELECT dataset_key FROM ptasks WHERE status='OK') p ON m.dataset_key=p.dataset_key""",
        "marks", "ptasks",
    ),
)
def reset_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = view(spark, sf_dir, "ptasks").filter("status = 'OK'")
    return index.reset_marks(view(spark, sf_dir, "marks"), finished, F.lit("")).select("dataset_key", "updated", "updated_at")
