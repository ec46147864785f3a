"""Queries on place names, overrides and the boundary cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.fixtures import table, view, with_views
from rooftally.functions import text
from rooftally.operators import regions
from rooftally.queries.registry import query


def collapsed(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column},''), '\\s+', ' ', 'g'))"


def key_of(column: str) -> str:
    return f"lower({collapsed(f'''replace({column},'_',' ')''')})"


def plain_name(column: str) -> str:
    """Normal form of the ASCII and CJK names in the test views."""
    bare = f"regexp_replace(replace(replace(lower({column}),'_',' '),'-',' '), '[^a-z0-9\\s一-鿿]', ' ', 'g')"
    return f"trim(regexp_replace({bare}, '\\s+', ' ', 'g'))"


# --- text -----------------------------------------------------------------------------------------------------

ALIAS_CASE = "CASE " + " ".join(f"WHEN q = '{k}' THEN '{v}'" for k, v in fixed.COUNTRY_ALIASES.items()) + " END"
SUFFIXES = "|".join(fixed.ADMIN_SUFFIXES)


@query(
    "text_keys",
    with_views(
        f"""
        WITH s AS (SELECT *, {collapsed('raw')} AS c, {collapsed("replace(raw,'_',' ')")} AS u FROM names),
        t AS (SELECT *, lower(u) AS q, regexp_replace(regexp_replace(trim(raw), '[{chr(92)}{chr(92)}]', '/', 'g'), '/+', '/', 'g') AS dir FROM s)
        SELECT row_id, c AS collapsed, q AS key, CASE WHEN c='' THEN 'unknown' ELSE translate(c, concat(chr(92),'/'), '__') END AS segment,
               trim(dir, '/') AS folder, coalesce({ALIAS_CASE}, u) AS country, regexp_replace(c, '^(.+?)({SUFFIXES})$', '{chr(92)}1') AS bare,
               list_filter(list_transform(regexp_split_to_array(raw, '[|;]'), lambda x: trim(x)), lambda x: x <> '') AS parts,
               split_part(trim(raw), '_', 1) AS token, replace(replace(raw,'_valid',''),'_clean','') AS stem,
               CASE WHEN trim(regexp_replace(raw, '[{chr(92)}{chr(92)}/:*?"<>|{chr(92)}s]+', '_', 'g'), '_')='' THEN 'region'
                    ELSE trim(regexp_replace(raw, '[{chr(92)}{chr(92)}/:*?"<>|{chr(92)}s]+', '_', 'g'), '_') END AS file_name
        FROM t""",
        "names",
    ),
)
def text_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw")
    return view(spark, sf_dir, "names").select(
        "row_id", text.collapse_spaces(raw).alias("collapsed"), text.task_key(raw).alias("key"),
        text.sanitize_segment(raw).alias("segment"), text.clean_download_dir(raw).alias("folder"),
        text.normalize_country(raw).alias("country"), text.strip_admin_suffix(raw).alias("bare"),
        text.split_name_values(raw).alias("parts"), text.first_token(raw).alias("token"),
        text.clean_output_stem(raw).alias("stem"), text.sanitize_filename(raw).alias("file_name"),
    )


@query(
    "name_keys",
    with_views(
        f"""WITH d AS (SELECT DISTINCT raw FROM names),
            f AS (SELECT raw, unnest([raw, {collapsed("replace(raw,'_',' ')")}, regexp_replace({collapsed("replace(raw,'_',' ')")}, '^(.+?)({SUFFIXES})$', '{chr(92)}1')]) AS form FROM d)
            SELECT DISTINCT raw AS value, {plain_name('form')} AS name_key FROM f""",
        "names",
    ),
)
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.value_name_keys(view(spark, sf_dir, "names"), "raw")


@query(
    "derive_prefix",
    with_views(
        """WITH f AS (SELECT c_custkey, concat('d/', n_name, CASE c_custkey%3 WHEN 0 THEN '_buildings_height_gba_part2.shp' WHEN 1 THEN '_PART7.shp'
                             ELSE '__buildings_height_gba.shp' END) AS file FROM ptasks JOIN nation ON country=n_name)
           SELECT c_custkey, replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(split_part(file,'/',2),'\\.shp$',''), '(?i)_part\\d+$',''),
                  '_buildings_height_gba$',''), '_'), '\\s+', '_', 'g'), '__', '_') AS prefix FROM f""",
        "ptasks",
    ),
)
def derive_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("c_custkey") % 3 == 0, "_buildings_height_gba_part2.shp").when(F.col("c_custkey") % 3 == 1, "_PART7.shp")
    files = F.array(F.lit("x/_part1.shp"), F.concat(F.lit("d/"), F.col("country"), ending.otherwise("__buildings_height_gba.shp")))
    rows = view(spark, sf_dir, "ptasks").withColumn("files", files)
    return rows.select("c_custkey", text.slug(text.derive_prefix(F.col("files"))).alias("prefix"))


@query(
    "prefix_lookup",
    with_views(
        """SELECT dataset_key, replace(CASE WHEN c_custkey%3=0 THEN concat('given ',country) WHEN shards>0 THEN concat('set',CAST(c_custkey AS VARCHAR))
                  ELSE replace(dataset_key,'|','_') END, ' ', '_') AS process_name_prefix FROM ptasks""",
        "ptasks",
    ),
)
def prefix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "ptasks")
    shard = F.concat(F.lit("d/set"), F.col("c_custkey").cast("string"), F.lit("_buildings_height_gba_part1.shp"))
    sources = rows.select(
        "dataset_key", F.col("dataset_key").alias("task_id"), F.when(F.col("shards") > 0, F.array(shard)).otherwise(F.array().cast("array<string>")).alias("shp_files")
    )
    manifest = rows.filter("c_custkey % 3 = 0").select(
        F.col("dataset_key").alias("task_id"), F.concat(F.lit("given "), "country").alias("process_name_prefix")
    )
    return regions.prefix_lookup(sources, manifest).select("dataset_key", "process_name_prefix")


@query(
    "bilingual_labels",
    """SELECT c_custkey, CASE r_name WHEN 'AFRICA' THEN 'Africa(非洲)' WHEN 'ASIA' THEN 'Asia(亚洲)' WHEN 'EUROPE' THEN 'Europe(欧洲)' ELSE r_name END AS continent,
              CASE WHEN c_custkey%4=0 OR c_custkey%4=2 THEN n_name WHEN c_custkey%4=1 THEN concat(n_name,'(名',CAST(c_custkey%10 AS VARCHAR),')') ELSE concat('国',n_name) END AS country
       FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
)
def bilingual_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = customers.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    kind = F.col("c_custkey") % 4
    continent = F.when(F.col("r_name") == "ASIA", "亚洲").when(F.col("r_name").isin("AFRICA", "EUROPE"), F.initcap("r_name")).otherwise(F.col("r_name"))
    name = F.when(kind == 3, F.concat(F.lit("国"), "n_name")).otherwise(F.col("n_name"))
    other = F.when(kind == 0, F.lower("n_name")).when(kind == 2, " NaN ").otherwise(F.concat(F.lit("名"), (F.col("c_custkey") % 10).cast("string")))
    return rows.select("c_custkey", text.continent_label(continent).alias("continent"), text.bilingual(name, other).alias("country"))


@query(
    "field_checks",
    with_views(
        """SELECT row_id, CASE WHEN trim(raw)='' THEN 'blank' WHEN length(trim(raw))>100 THEN 'too long' WHEN regexp_matches(raw, '[,"<>:*?|/\\\\]') THEN 'forbidden character' END AS problem,
                  CASE WHEN row_id%4=0 THEN 'count' WHEN row_id%4=1 THEN 'number' WHEN row_id%4=2 THEN 'range' END AS bbox_problem FROM names""",
        "names",
    ),
)
def field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = (
        F.when(F.col("row_id") % 4 == 0, "1,2,3").when(F.col("row_id") % 4 == 1, "1,2,x,4").when(F.col("row_id") % 4 == 2, "3,2,1,4").otherwise("1, 2,3 ,4")
    )
    return view(spark, sf_dir, "names").select("row_id", text.field_problem(F.col("raw")).alias("problem"), text.bbox_problem(box).alias("bbox_problem"))


@query(
    "search_names",
    with_views(f"SELECT row_id, raw FROM names WHERE contains(lower(concat({collapsed('n_name')},' ',{collapsed('raw')})), '3 nation_3 city_4')", "names"),
)
def search_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rooftally.operators.tasks import search

    return search(view(spark, sf_dir, "names"), " 3   Nation_3  City_4 ", "n_name", "raw").select("row_id", "raw")


# --- overrides and cascade ------------------------------------------------------------------------------------

OVERRIDE_SQL = f"""
    o AS (SELECT pos, {key_of('continent')} AS c1, {key_of('country')} AS c2, {key_of('city')} AS c3, lower(kind) AS kind,
                 {collapsed('value')} AS value, note FROM overrides WHERE kind<>''),
    hit AS (SELECT t.task_id, o.*, row_number() OVER (PARTITION BY t.task_id ORDER BY pos) AS rn FROM {{source}} t JOIN o
            ON (c1='' OR c1={key_of('t.continent')}) AND (c2='' OR c2={key_of('t.country')}) AND (c3='' OR c3={key_of('t.city')})),
    ov AS (SELECT task_id, kind, value, note FROM hit WHERE rn=1)"""


@query(
    "override_match",
    with_views(
        f"""WITH {OVERRIDE_SQL.format(source='tasks')}
            SELECT t.task_id, ov.kind AS override_kind, ov.value AS override_value, ov.note AS override_note FROM tasks t LEFT JOIN ov ON t.task_id=ov.task_id""",
        "tasks", "overrides",
    ),
)
def override_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_rows = regions.clean_overrides(view(spark, sf_dir, "overrides"))
    matched = regions.match_override(view(spark, sf_dir, "tasks").select("task_id", "continent", "country", "city"), table_rows)
    return matched.select("task_id", "override_kind", "override_value", "override_note")


BACK = chr(92)


def forms(column: str) -> str:
    cleaned = collapsed(f"replace({column},'_',' ')")
    return f"[{column}, {cleaned}, regexp_replace({cleaned}, '^(.+?)({SUFFIXES})$', '{BACK}1')]"


CASCADE_SQL = f"""
    n0 AS (SELECT row_pos, {plain_name('v')} AS k FROM (SELECT row_pos, unnest(regexp_split_to_array(concat_ws('|',"NAME","NAME_LONG","ADMIN","SOVEREIGNT","NAME_ALT","NAME_ZH"), '[|;]')) AS v FROM admin0) q WHERE trim(v)<>''),
    n1 AS (SELECT row_pos, admin, {plain_name('f')} AS k FROM (SELECT row_pos, admin, unnest([trim(v), regexp_replace(trim(v), '^(.+?)({SUFFIXES})$', '{BACK}1')]) AS f FROM
             (SELECT row_pos, admin, unnest(regexp_split_to_array(concat_ws('|',name,name_zh,name_alt), '[|;]')) AS v FROM admin1) q WHERE trim(v)<>'') r),
    pr AS (SELECT DISTINCT country, city FROM places),
    kc AS (SELECT DISTINCT v, {plain_name('f')} AS k FROM (SELECT v, unnest({forms('v')}) AS f FROM (SELECT country AS v FROM pr UNION SELECT city FROM pr) a) b),
    m0 AS (SELECT v AS country, min(row_pos) AS p0 FROM kc JOIN n0 USING (k) GROUP BY v),
    m1 AS (SELECT v, min(row_pos) AS p1 FROM kc JOIN n1 USING (k) GROUP BY v),
    an AS (SELECT row_pos AS p0, unnest(["NAME","ADMIN","SOVEREIGNT","NAME_LONG"]) AS admin FROM admin0),
    own AS (SELECT m0.country, kc.v AS city, min(n1.row_pos) AS p1 FROM m0 JOIN an USING (p0) JOIN n1 USING (admin) JOIN kc USING (k) GROUP BY 1, 2),
    cas AS (SELECT pr.country, pr.city, m0.p0,
                   CASE WHEN m0.p0 IS NOT NULL AND {key_of('pr.city')}={key_of('pr.country')} THEN 'admin0' WHEN m0.p0 IS NOT NULL AND own.p1 IS NOT NULL THEN 'admin1'
                        WHEN m0.p0 IS NOT NULL AND mc.p1 IS NOT NULL THEN 'admin1_global' WHEN m0.p0 IS NULL AND (mk.p1 IS NOT NULL OR mc.p1 IS NOT NULL) THEN 'admin1_fallback' END AS level,
                   CASE WHEN m0.p0 IS NOT NULL THEN CASE WHEN {key_of('pr.city')}<>{key_of('pr.country')} THEN coalesce(own.p1, mc.p1) END ELSE coalesce(mk.p1, mc.p1) END AS p1
            FROM pr LEFT JOIN m0 ON pr.country=m0.country LEFT JOIN own ON pr.country=own.country AND pr.city=own.city
                    LEFT JOIN m1 mc ON pr.city=mc.v LEFT JOIN m1 mk ON pr.country=mk.v),
    nm AS (SELECT cas.*, CASE level WHEN 'admin0' THEN a0."NAME" ELSE a1.name END AS matched_name FROM cas LEFT JOIN admin0 a0 ON cas.p0=a0.row_pos LEFT JOIN admin1 a1 ON cas.p1=a1.row_pos)"""


def layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, sf_dir, "admin0"), view(spark, sf_dir, "admin1")


@query("name_match", with_views(f"WITH {CASCADE_SQL} SELECT DISTINCT country, p0 AS admin0_pos FROM m0 JOIN places USING (country)", "admin0", "admin1", "places"))
def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.match_admin0(view(spark, sf_dir, "places"), layers(spark, sf_dir)[0])


@query("region_match", with_views(f"WITH {CASCADE_SQL} SELECT DISTINCT city, p1 AS admin1_pos FROM m1 JOIN places ON city=v", "admin0", "admin1", "places"))
def region_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions.match_admin1(view(spark, sf_dir, "places"), "city", layers(spark, sf_dir)[1])


@query(
    "cascade_match",
    with_views(
        f"""WITH {CASCADE_SQL} SELECT task_id, level, matched_name, p1 AS admin1_pos FROM places LEFT JOIN nm USING (country, city)""",
        "admin0", "admin1", "places",
    ),
)
def cascade_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = regions.match_local_boundary(view(spark, sf_dir, "places"), *layers(spark, sf_dir))
    return matched.select("task_id", "level", "matched_name", "admin1_pos")


@query(
    "chinese_names",
    with_views(
        f"""WITH {CASCADE_SQL},
            z AS (SELECT pr.country, pr.city, coalesce(a0."NAME_ZH",'') AS country_zh,
                         CASE WHEN {key_of('pr.city')}={key_of('pr.country')} THEN coalesce(a0."NAME_ZH",'') ELSE coalesce(a1.name_zh, ac."NAME_ZH", '') END AS city_zh
                  FROM pr LEFT JOIN m0 ON pr.country=m0.country LEFT JOIN own ON pr.country=own.country AND pr.city=own.city LEFT JOIN m1 mc ON pr.city=mc.v
                       LEFT JOIN admin0 a0 ON a0.row_pos=m0.p0 LEFT JOIN admin1 a1 ON a1.row_pos=coalesce(own.p1, mc.p1)
                       LEFT JOIN (SELECT v, min(row_pos) AS p FROM kc JOIN n0 USING (k) GROUP BY v) c0 ON c0.v=pr.city LEFT JOIN admin0 ac ON ac.row_pos=c0.p)
            SELECT task_id, country_zh, city_zh FROM places JOIN z USING (country, city)""",
        "admin0", "admin1", "places",
    ),
)
def chinese_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = regions.chinese_names(view(spark, sf_dir, "places"), *layers(spark, sf_dir))
    return named.select("task_id", "country_zh", "city_zh")


QUERY_SQL = f"""
    cand AS (SELECT DISTINCT country, city, {collapsed("replace(country,'_',' ')")} AS cq, {collapsed("replace(city,'_',' ')")} AS tq, {key_of('country')}={key_of('city')} AS same FROM places),
    qs AS (SELECT country, city, CASE WHEN same THEN [concat('country=',cq), cq]
             ELSE [concat('state=',tq,'&country=',cq), concat('city=',tq,'&country=',cq), concat(tq,', ',cq), tq] END AS queries FROM cand)"""


@query(
    "boundary_source",
    with_views(
        f"""WITH {CASCADE_SQL}, {OVERRIDE_SQL.format(source='places')}, {QUERY_SQL},
            gz AS (SELECT DISTINCT 'T'||CAST(c_custkey AS VARCHAR) AS query FROM customer WHERE c_custkey%3=0),
            pl AS (SELECT country, city, min(i) AS i FROM (SELECT country, city, unnest(queries) AS query, unnest(generate_series(1, len(queries))) AS i FROM qs) u JOIN gz USING (query) GROUP BY 1, 2),
            b AS (SELECT p.task_id, ov.kind, ov.value, ov.note, nm.level, nm.matched_name, q.queries[pl.i] AS place, CAST(substr(p.task_id,2) AS INT)%9=0 AS cached
                  FROM places p LEFT JOIN ov ON p.task_id=ov.task_id LEFT JOIN nm ON p.country=nm.country AND p.city=nm.city
                       LEFT JOIN qs q ON p.country=q.country AND p.city=q.city LEFT JOIN pl ON p.country=pl.country AND p.city=pl.city)
            SELECT task_id, CASE WHEN kind='skip' THEN 'override_skip' WHEN cached THEN 'cache' WHEN kind IS NOT NULL THEN concat('override_',kind)
                                 WHEN level IS NOT NULL THEN 'local_boundary' WHEN place IS NOT NULL THEN 'geocode' ELSE 'unresolved' END AS source_type,
                   CASE WHEN kind='skip' THEN note WHEN cached THEN '' WHEN kind IS NOT NULL THEN value WHEN level IS NOT NULL THEN concat(level,':',matched_name)
                        ELSE coalesce(place,'') END AS source_detail FROM b""",
        "admin0", "admin1", "places", "overrides",
    ),
)
def boundary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = view(spark, sf_dir, "places")
    table_rows = regions.clean_overrides(view(spark, sf_dir, "overrides"))
    cached = places.filter("CAST(substr(task_id, 2) AS INT) % 9 = 0").select("task_id")
    known = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("query"))
    resolved = regions.resolve_boundary(places, table_rows, cached, *layers(spark, sf_dir), known)
    return resolved.select("task_id", "source_type", "source_detail")


@query(
    "range_plan",
    with_views(
        f"""WITH {CASCADE_SQL}, {OVERRIDE_SQL.format(source='places')}, {QUERY_SQL}
            SELECT p.task_id, CASE WHEN kind IS NOT NULL THEN concat('override=',kind,':',value) WHEN level IS NOT NULL THEN concat('local=',level,':',matched_name)
                              ELSE concat('geocode=',array_to_string(queries,' > ')) END AS range_plan
            FROM places p LEFT JOIN ov ON p.task_id=ov.task_id LEFT JOIN nm ON p.country=nm.country AND p.city=nm.city LEFT JOIN qs q ON p.country=q.country AND p.city=q.city""",
        "admin0", "admin1", "places", "overrides",
    ),
)
def range_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_rows = regions.clean_overrides(view(spark, sf_dir, "overrides"))
    return regions.range_plan(view(spark, sf_dir, "places"), table_rows, *layers(spark, sf_dir)).select("task_id", "range_plan")


# --- aliases and files ----------------------------------------------------------------------------------------

ALIAS_VALUES = ", ".join(f"('{name}','{slug}','{place}')" for slug, place, names in fixed.PROVINCES for name in (slug, *names))
TOKENS = """CASE c_custkey%7 WHEN 0 THEN ' Inner Mongolia ' WHEN 1 THEN '四川省' WHEN 2 THEN 'inner-mongolia' WHEN 3 THEN 'TIBET' WHEN 4 THEN '上海'
            WHEN 5 THEN concat('place',CAST(c_custkey AS STRING)) ELSE 'Xizang' END"""


@query(
    "alias_resolve",
    f"""WITH v(name, slug, place) AS (VALUES {ALIAS_VALUES}),
             a AS (SELECT DISTINCT replace(replace(lower(name),' ',''),'-','_') AS k, slug, place FROM v),
             t AS (SELECT c_custkey, {TOKENS} AS token FROM customer)
        SELECT c_custkey, token, slug, place FROM t LEFT JOIN a ON replace(replace(lower(trim(token)),' ',''),'-','_')=k
        WHERE slug IS NULL OR slug <> 'shanghai'""",
)
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "customer").select("c_custkey", F.expr(TOKENS).alias("token"))
    excluded = tokens.filter("token = '上海'").select("token")
    return regions.resolve_alias(tokens, regions.province_aliases(spark), excluded, strict=False)


@query(
    "conflict_lookup",
    with_views(
        """WITH c AS (SELECT row_id, lower(r_name) AS continent, lower(n_name) AS country, concat('t',CAST(row_id AS VARCHAR)) AS city, concat('C',CAST(row_id%40 AS VARCHAR)) AS prefix FROM names),
                o AS (SELECT lower(concat('c',CAST(c_custkey%60 AS VARCHAR))) AS prefix, min(dataset_key) AS owner FROM ptasks WHERE c_custkey%2=0 GROUP BY 1),
                t AS (SELECT lower(continent) AS continent, lower(country) AS country, lower(city) AS city, min(task_id) AS task_id, arg_min(status, task_id) AS status FROM tasks GROUP BY 1, 2, 3)
           SELECT row_id AS candidate_id, t.task_id AS existing_task, t.status AS existing_status, o.owner AS prefix_owner
           FROM c LEFT JOIN t ON c.continent=t.continent AND c.country=t.country AND c.city=t.city LEFT JOIN o ON lower(c.prefix)=o.prefix""",
        "names", "ptasks", "tasks",
    ),
)
def conflict_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.col("row_id").cast("string")
    candidates = view(spark, sf_dir, "names").select(
        F.col("row_id").alias("candidate_id"), F.lower("r_name").alias("continent"), F.initcap("n_name").alias("country"),
        F.concat(F.lit("t"), row).alias("city"), F.concat(F.lit("C"), (F.col("row_id") % 40).cast("string")).alias("process_name_prefix"),
    )
    owners = view(spark, sf_dir, "ptasks").select(
        "dataset_key", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("c"), (F.col("c_custkey") % 60).cast("string"))).alias("process_name_prefix")
    )
    found = regions.conflict_lookup(candidates, view(spark, sf_dir, "tasks"), owners)
    return found.select("candidate_id", "existing_task", "existing_status", "prefix_owner")


NEW_ROWS = """SELECT c_custkey AS row_no, CASE WHEN c_custkey%11=0 THEN ' ' ELSE concat(' ',r_name) END AS continent, n_name AS country,
                     concat('City ',CAST(c_custkey%400 AS STRING)) AS city, concat('px',CAST(c_custkey%900 AS STRING)) AS process_name_prefix
              FROM {customer} JOIN {nation} ON c_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey"""
OLD_ROWS = """SELECT lower(r_name) AS continent, n_name AS country, concat('CITY  ',CAST(c_custkey%400 AS STRING)) AS city, concat('PX',CAST(c_custkey%50 AS STRING)) AS process_name_prefix
              FROM {customer} JOIN {nation} ON c_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey WHERE c_custkey%5=0"""


@query(
    "append_manifest",
    f"""WITH n AS (SELECT row_no, trim(continent) AS continent, country, city, process_name_prefix, lower(concat_ws('|',trim(continent),country,city)) AS t, lower(process_name_prefix) AS p
                   FROM ({NEW_ROWS.format(customer='customer', nation='nation', region='region')}) q),
             o AS (SELECT lower(concat_ws('|',continent,country,regexp_replace(city,'\\s+',' '))) AS t, lower(process_name_prefix) AS p
                   FROM ({OLD_ROWS.format(customer='customer', nation='nation', region='region')}) q),
             g AS (SELECT *, CASE WHEN continent='' THEN 'continent: blank' WHEN t IN (SELECT t FROM o) THEN 'task exists' WHEN p IN (SELECT p FROM o) THEN 'prefix in use' END AS problem FROM n),
             f AS (SELECT *, min(CASE WHEN problem IS NULL THEN row_no END) OVER (PARTITION BY t) AS ft, min(CASE WHEN problem IS NULL THEN row_no END) OVER (PARTITION BY p) AS fp FROM g)
        SELECT row_no, coalesce(problem, CASE WHEN row_no>ft THEN 'task exists' WHEN row_no>fp THEN 'prefix in use' END, 'accepted') AS outcome FROM f""",
)
def append_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: table(spark, sf_dir, t) for t in ("customer", "nation", "region")}
    accepted, rejected = regions.append_manifest_rows(spark.sql(OLD_ROWS, **tables), spark.sql(NEW_ROWS, **tables))
    return accepted.select("row_no", F.lit("accepted").alias("outcome")).unionByName(rejected.select("row_no", F.col("problem").alias("outcome")))


@query(
    "first_candidate",
    with_views(
        """SELECT dataset_key, CASE WHEN c_custkey%4=0 THEN concat('b/',c_custkey,'_adm1.shp') WHEN c_custkey%4=1 THEN concat('b/',c_custkey,'.shp')
                  WHEN c_custkey%4=2 THEN concat('b/',c_custkey,'.gpkg') END AS found_path FROM ptasks""",
        "ptasks",
    ),
)
def first_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files exist in some of the four spellings; the most preferred one is taken."""
    rows = view(spark, sf_dir, "ptasks").withColumn("slug", F.col("c_custkey").cast("string"))
    ends = [("_adm1.shp", "c_custkey % 4 = 0"), (".shp", "c_custkey % 4 < 2"), (".gpkg", "c_custkey % 4 < 3")]
    listing = None
    for end, test in ends:
        part = rows.filter(test).select(F.concat(F.lit("b/"), "slug", F.lit(end)).alias("path"))
        listing = part if listing is None else listing.unionByName(part)
    candidates = regions.boundary_file_candidates(F.col("slug"), "b/")
    return regions.first_existing_candidate(rows, candidates, listing, "dataset_key").select("dataset_key", "found_path")


@query(
    "existing_datasets",
    with_views(
        f"""WITH d AS (SELECT c_custkey, concat('data/x/', CASE WHEN c_custkey%2=0 THEN upper(concat('area_',CAST(c_custkey%60 AS VARCHAR))) ELSE concat('None-',CAST(c_custkey AS VARCHAR)) END) AS directory FROM customer),
            e AS (SELECT {plain_name('city')} AS k, arg_min(task_id, CAST(substr(task_id,2) AS INT)) AS task_id FROM places WHERE {plain_name('country')} IN ('nation 3','nation 4','nation 5') GROUP BY 1)
            SELECT c_custkey, directory, task_id FROM d LEFT JOIN e ON {plain_name("replace(directory,'data/x/','')")}=k""",
        "places",
    ),
)
def existing_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 2 == 0, F.upper(F.concat(F.lit("area_"), (key % 60).cast("string")))).otherwise(F.concat(F.lit("None-"), key.cast("string")))
    folders = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("data/x/"), name).alias("directory"))
    places = view(spark, sf_dir, "places").withColumn("order_no", F.expr("CAST(substr(task_id, 2) AS INT)"))
    return regions.match_existing_datasets(folders, places, ["nation 3", "nation 4", "nation 5"])


@query(
    "classify_by_prefix",
    with_views(
        """WITH f AS (SELECT row_id, concat(lower(n_name), CASE WHEN row_id%3=0 THEN '_001_tail.shp' WHEN row_id%3=1 THEN '.shp' ELSE '_extra_x_1.shp' END) AS file_name FROM names),
                g AS (SELECT n_nationkey AS pos, CASE WHEN n_nationkey%2=0 THEN lower(n_name) ELSE concat(lower(n_name),'_extra') END AS k, n_name AS g FROM nation)
           SELECT row_id, file_name, coalesce((SELECT arg_min(g, pos) FROM g WHERE starts_with(file_name, concat(k,'_'))), 'unclassified') AS group_name FROM f""",
        "names",
    ),
)
def classify_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("row_id") % 3 == 0, "_001_tail.shp").when(F.col("row_id") % 3 == 1, ".shp").otherwise("_extra_x_1.shp")
    files = view(spark, sf_dir, "names").select("row_id", F.concat(F.lower("n_name"), end).alias("file_name"))
    key = F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.lower("n_name"), F.lit("_extra")))
    groups = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("pos"), key.alias("group_key"), F.col("n_name").alias("group_name"))
    return regions.classify_by_prefix(files, groups)
