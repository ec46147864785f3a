"""Matching place names: range overrides, administrative layers, aliases, prefixes and the boundary cascade.

Name tables can be long and one name may be carried by a large share of the tasks, so names are normalised and
matched once per distinct value; tasks only join the (value, answer) table afterwards.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import text
from rooftally.session import lookup_join, stage


# --- overrides ------------------------------------------------------------------------------------------------

def clean_overrides(raw: DataFrame) -> DataFrame:
    """Override rows ready for matching; blank kinds are dropped, unknown kinds fail the job.

    ``raw`` needs ``pos`` (file order) and the columns continent, country, city, kind, value, note.
    """
    kind = F.lower(text.collapse_spaces(F.col("kind")))
    known = F.when(kind.isin(fixed.OVERRIDE_KINDS), kind).otherwise(
        F.raise_error(F.concat(F.lit("unknown override kind: "), kind)).cast("string")
    )
    return raw.filter(kind != "").select(
        "pos",
        *[text.task_key(F.col(c)).alias(c) for c in ("continent", "country", "city")],
        known.alias("kind"),
        *[text.collapse_spaces(F.col(c)).alias(c) for c in ("value", "note")],
    )


def match_override(tasks: DataFrame, overrides: DataFrame) -> DataFrame:
    """Tasks with the first override (file order) that fits; a blank override field fits anything.

    Every task asks for the eight combinations of its own value or blank, as an equi-join.
    """
    fields = ["continent", "country", "city"]
    keyed = tasks.select("task_id", *[text.task_key(F.col(c)).alias("_own_" + c) for c in fields])
    combos = F.array(
        *[
            F.struct(*[(F.col("_own_" + c) if take else F.lit("")).alias("_" + c) for take, c in zip(mask, fields)])
            for mask in product([True, False], repeat=3)
        ]
    )
    asked = keyed.select("task_id", F.explode(F.array_distinct(combos)).alias("k")).select("task_id", "k.*")
    first = overrides.groupBy(*fields).agg(F.min(F.struct("pos", "kind", "value", "note")).alias("o"))
    table = first.select(*[F.col(c).alias("_" + c) for c in fields], "o")
    hits = lookup_join(asked, table, ["_" + c for c in fields]).groupBy("task_id").agg(F.min("o").alias("o"))
    found = hits.select(
        "task_id", F.col("o.kind").alias("override_kind"), F.col("o.value").alias("override_value"), F.col("o.note").alias("override_note")
    )
    return tasks.join(found, "task_id", "left")


# --- administrative names -------------------------------------------------------------------------------------

def admin_name_keys(layer: DataFrame, fields: list[str], row: str = "row_pos", strip_suffix: bool = False) -> DataFrame:
    """All normalised spellings of a layer's rows: ``name_key, row``."""
    present = [f for f in fields if f in layer.columns]
    values = F.flatten(F.array(*[text.split_name_values(F.col(f)) for f in present]))
    names = layer.select(row, F.explode(values).alias("name"))
    if strip_suffix:
        names = names.select(row, F.explode(F.array("name", text.strip_admin_suffix(F.col("name")))).alias("name"))
    keys = names.select("name").distinct().withColumn("name_key", text.normalize_name("name"))
    return names.join(keys, "name").select("name_key", row).distinct()


def value_name_keys(values: DataFrame, column: str, country: bool = False) -> DataFrame:
    """Distinct values of ``column`` with their lookup keys: ``value, name_key``."""
    distinct = values.select(F.col(column).alias("value")).distinct()
    forms = text.name_forms(F.col("value"))
    if country:
        forms = F.array_union(forms, F.array(text.normalize_country(F.col("value"))))
    rows = distinct.select("value", F.explode(forms).alias("form"))
    return rows.select("value", text.normalize_name("form").alias("name_key")).distinct()


def match_names(values: DataFrame, names: DataFrame, row: str = "row_pos") -> DataFrame:
    """All layer rows each value names: ``value, row``."""
    return lookup_join(values, names, ["name_key"]).select("value", row).distinct()


def match_admin0(tasks: DataFrame, admin0: DataFrame) -> DataFrame:
    """Per distinct country: the first row (layer order) of the country layer that carries the name."""
    names = admin_name_keys(admin0, fixed.ADMIN0_NAME_FIELDS)
    hits = match_names(value_name_keys(tasks, "country", country=True), names)
    return hits.groupBy("value").agg(F.min("row_pos").alias("admin0_pos")).withColumnRenamed("value", "country")


def match_admin1(values: DataFrame, column: str, admin1: DataFrame) -> DataFrame:
    """Per distinct value of ``column``: the first region that carries the name."""
    names = admin_name_keys(admin1, fixed.ADMIN1_NAME_FIELDS, strip_suffix=True)
    hits = match_names(value_name_keys(values, column), names)
    return hits.groupBy("value").agg(F.min("row_pos").alias("admin1_pos")).withColumnRenamed("value", column)


def _matched_pairs(tasks: DataFrame, admin0: DataFrame, admin1: DataFrame) -> DataFrame:
    """Distinct (country, city) with the rows their names lead to.

    ``admin0_pos``: the country's row; ``own_pos``: region of that country named like the city; ``city_pos``,
    ``country_pos``: any region named like the city or the country; ``named_pos``: country named like the city.
    All names are normalised once, and the few intermediate tables are written so that every use reads them.
    """
    pairs = stage(tasks.select("country", "city").distinct())
    values = pairs.select(F.col("country").alias("value")).union(pairs.select(F.col("city").alias("value"))).distinct()
    alias_form = F.struct(text.normalize_country(F.col("value")).alias("form"), F.lit(True).alias("alias"))
    plain_forms = F.transform(text.name_forms(F.col("value")), lambda f: F.struct(f.alias("form"), F.lit(False).alias("alias")))
    spelled = values.select("value", F.explode(F.concat(plain_forms, F.array(alias_form))).alias("f")).select("value", "f.*")
    keys = stage(spelled.select("value", text.normalize_name("form").alias("name_key"), "alias").distinct())
    names0 = stage(admin_name_keys(admin0, fixed.ADMIN0_NAME_FIELDS))
    names1 = stage(admin_name_keys(admin1, fixed.ADMIN1_NAME_FIELDS, strip_suffix=True))
    country_of = stage(lookup_join(keys, names0, ["name_key"]).groupBy("value").agg(F.min("row_pos").alias("pos")))
    hits = stage(lookup_join(keys.filter("not alias"), names1, ["name_key"]).select("value", "row_pos").distinct())
    region_of = stage(hits.groupBy("value").agg(F.min("row_pos").alias("pos")))

    def found(pairs: DataFrame, table: DataFrame, column: str, name: str) -> DataFrame:
        return lookup_join(pairs, table.select(F.col("value").alias(column), F.col("pos").alias(name)), [column], "left")

    pairs = found(pairs, country_of, "country", "admin0_pos")
    spellings = [F.nullif(F.col(f), F.lit("")) for f in ("NAME", "ADMIN", "SOVEREIGNT", "NAME_LONG") if f in admin0.columns]
    admin_names = admin0.select(F.col("row_pos").alias("admin0_pos"), F.explode(F.array_compact(F.array(*spellings))).alias("admin")).distinct()
    regions = hits.join(admin1.select("row_pos", "admin"), "row_pos").withColumnRenamed("value", "city")
    within = pairs.join(admin_names, "admin0_pos").join(regions, ["city", "admin"])
    own = within.groupBy("country", "city").agg(F.min("row_pos").alias("own_pos"))
    pairs = pairs.join(own, ["country", "city"], "left")
    pairs = found(found(pairs, region_of, "city", "city_pos"), region_of, "country", "country_pos")
    return found(pairs, country_of, "city", "named_pos")


def match_local_boundary(tasks: DataFrame, admin0: DataFrame, admin1: DataFrame) -> DataFrame:
    """Tasks with ``level, matched_name, admin0_pos, admin1_pos`` of the local boundary, NULL when none fits.

    A known country gives itself when the city has the same name, else its region of that name, else any region
    of that name. An unknown country is looked up as a region, then the city is.
    """
    pairs = _matched_pairs(tasks, admin0, admin1)
    same = text.task_key(F.col("city")) == text.task_key(F.col("country"))
    known = F.col("admin0_pos").isNotNull()
    level = (
        F.when(known & same, "admin0")
        .when(known & F.col("own_pos").isNotNull(), "admin1")
        .when(known & F.col("city_pos").isNotNull(), "admin1_global")
        .when(~known & (F.col("country_pos").isNotNull() | F.col("city_pos").isNotNull()), "admin1_fallback")
    )
    region = F.when(known & ~same, F.coalesce("own_pos", "city_pos")).when(~known, F.coalesce("country_pos", "city_pos"))
    pairs = pairs.withColumns({"level": level, "admin1_pos": region})
    pairs = pairs.join(admin0.select(F.col("row_pos").alias("admin0_pos"), F.col("NAME").alias("_n0")), "admin0_pos", "left")
    pairs = pairs.join(admin1.select(F.col("row_pos").alias("admin1_pos"), F.col("name").alias("_n1")), "admin1_pos", "left")
    fallback = F.when(F.col("level") == "admin1_fallback", F.col("country")).otherwise(F.col("city"))
    name = F.when(F.col("level") == "admin0", F.coalesce(F.nullif("_n0", F.lit("")), "country")).when(
        F.col("level").isNotNull(), F.coalesce(F.nullif("_n1", F.lit("")), fallback)
    )
    answers = stage(pairs.select("country", "city", "level", name.alias("matched_name"), "admin0_pos", "admin1_pos"))
    return lookup_join(tasks, answers, ["country", "city"], "left")


def chinese_names(tasks: DataFrame, admin0: DataFrame, admin1: DataFrame) -> DataFrame:
    """Tasks with ``country_zh`` and ``city_zh`` ('' when unknown); a city may also be named like a country."""
    zh0 = admin0.select("row_pos", text.clean_translation(F.col("NAME_ZH")).alias("zh"))
    zh1 = admin1.select("row_pos", text.clean_translation(F.col("name_zh")).alias("zh"))
    pairs = (
        _matched_pairs(tasks, admin0, admin1)
        .withColumn("region_pos", F.coalesce("own_pos", "city_pos"))
        .join(zh0.select(F.col("row_pos").alias("admin0_pos"), F.col("zh").alias("_country")), "admin0_pos", "left")
        .join(zh1.select(F.col("row_pos").alias("region_pos"), F.col("zh").alias("_region")), "region_pos", "left")
        .join(zh0.select(F.col("row_pos").alias("named_pos"), F.col("zh").alias("_named")), "named_pos", "left")
    )
    country_zh = F.coalesce("_country", F.lit(""))
    same = text.task_key(F.col("city")) == text.task_key(F.col("country"))
    city_zh = F.when(same, country_zh).otherwise(F.coalesce(F.nullif("_region", F.lit("")), "_named", F.lit("")))
    answers = stage(pairs.select("country", "city", country_zh.alias("country_zh"), city_zh.alias("city_zh")))
    return lookup_join(tasks, answers, ["country", "city"], "left")


# --- range of a task ------------------------------------------------------------------------------------------

def resolve_boundary(
    tasks: DataFrame, overrides: DataFrame, cached: DataFrame, admin0: DataFrame, admin1: DataFrame, gazetteer: DataFrame,
    refresh: bool = False,
) -> DataFrame:
    """Tasks with ``source_type`` and ``source_detail`` of the range they use, by fixed priority.

    Skip override, cached range (unless ``refresh``), boundary / bbox / query override, local layer, first place
    query the ``gazetteer`` (``query``) knows, else ``unresolved``. ``cached`` lists task ids.
    """
    matched = match_local_boundary(match_override(tasks, overrides), admin0, admin1)
    matched = matched.join(cached.select("task_id", F.lit(not refresh).alias("_cached")).distinct(), "task_id", "left")
    places = _first_place(tasks, gazetteer)
    matched = lookup_join(matched, stage(places), ["country", "city"], "left")
    kind, cached_range = F.col("override_kind"), F.coalesce("_cached", F.lit(False))
    source = (
        F.when(kind == "skip", "override_skip")
        .when(cached_range, "cache")
        .when(kind.isNotNull(), F.concat(F.lit("override_"), kind))
        .when(F.col("level").isNotNull(), "local_boundary")
        .when(F.col("_place").isNotNull(), "geocode")
        .otherwise("unresolved")
    )
    box_checked = F.when(
        (kind == "bbox") & ~cached_range, text.parse_bbox(F.col("override_value")).isNotNull()
    ).otherwise(F.lit(True))
    detail = (
        F.when(kind == "skip", F.col("override_note"))
        .when(cached_range, F.lit(""))
        .when(kind.isNotNull() & box_checked, F.col("override_value"))
        .when(F.col("level").isNotNull(), F.concat("level", F.lit(":"), "matched_name"))
        .otherwise(F.coalesce("_place", F.lit("")))
    )
    return matched.select(*tasks.columns, source.alias("source_type"), detail.alias("source_detail"))


def _first_place(tasks: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """First place query, in order, that the gazetteer knows, per distinct (country, city)."""
    pairs = tasks.select("country", "city").distinct()
    asked = pairs.select("country", "city", F.posexplode(text.query_candidates(F.col("country"), F.col("city"))).alias("pos", "q"))
    asked = asked.withColumn("query", text.query_text(F.col("q")))
    known = lookup_join(asked, gazetteer.select("query").distinct(), ["query"], "left_semi")
    return known.groupBy("country", "city").agg(F.min_by("query", "pos").alias("_place"))


def range_plan(tasks: DataFrame, overrides: DataFrame, admin0: DataFrame, admin1: DataFrame) -> DataFrame:
    """Tasks with a text that says which range source would be used (a dry run of the cascade)."""
    matched = match_local_boundary(match_override(tasks, overrides), admin0, admin1)
    detail = F.coalesce(F.nullif("override_value", F.lit("")), F.nullif("override_note", F.lit("")), F.lit(""))
    candidates = text.query_candidates(F.col("country"), F.col("city"))
    queries = F.concat_ws(" > ", F.transform(candidates, text.query_text))
    plan = (
        F.when(F.col("override_kind").isNotNull(), F.concat(F.lit("override="), "override_kind", F.lit(":"), detail))
        .when(F.col("level").isNotNull(), F.concat(F.lit("local="), "level", F.lit(":"), "matched_name"))
        .otherwise(F.concat(F.lit("geocode="), queries))
    )
    return matched.select(*tasks.columns, plan.alias("range_plan"))


# --- aliases, prefixes, files ---------------------------------------------------------------------------------

def province_aliases(spark: SparkSession) -> DataFrame:
    """``alias_key, slug, place`` of the built-in provinces (a fixed small table)."""
    rows = [
        (name, slug, place)
        for slug, place, names in fixed.PROVINCES
        for name in (slug, *names)
    ]
    table = spark.createDataFrame(rows, "name string, slug string, place string")
    return table.select(text.province_key(F.col("name")).alias("alias_key"), "slug", "place").distinct()


def resolve_alias(tokens: DataFrame, aliases: DataFrame, exclude: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Tokens (column ``token``) with the slug and place they stand for, minus excluded ones.

    An unknown token fails the job, or keeps a NULL slug when not ``strict``.
    """

    def lookup(df: DataFrame) -> DataFrame:
        keyed = df.withColumn("alias_key", text.province_key(F.col("token")))
        return lookup_join(keyed, aliases, ["alias_key"], "left").drop("alias_key")

    found = lookup(tokens)
    if strict:
        unknown = F.raise_error(F.concat(F.lit("unknown province: "), F.col("token"))).cast("string")
        found = found.withColumn("slug", F.coalesce("slug", unknown))
    if exclude is None:
        return found
    return lookup_join(found, lookup(exclude).select("slug").distinct(), ["slug"], "left_anti")


def prefix_lookup(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sources with ``process_name_prefix``: of the manifest, else of the first shard name, else of the key.

    ``sources``: ``dataset_key, task_id, shp_files``; ``manifest``: ``task_id, process_name_prefix``.
    """
    given = manifest.filter(F.trim(F.coalesce("process_name_prefix", F.lit(""))) != "").groupBy("task_id").agg(
        F.max("process_name_prefix").alias("_given")
    )
    joined = lookup_join(sources.drop("process_name_prefix"), given, ["task_id"], "left")
    chosen = F.coalesce(F.trim("_given"), text.derive_prefix(F.col("shp_files")), F.col("dataset_key"))
    return joined.withColumn("process_name_prefix", text.slug(chosen)).drop("_given")


def conflict_lookup(candidates: DataFrame, tasks: DataFrame, owners: DataFrame) -> DataFrame:
    """Candidates with the existing task of the same name (ignoring case) and the owner of the same prefix.

    ``candidates``: ``candidate_id, continent, country, city, process_name_prefix``; ``tasks`` with ``task_id,
    status``; ``owners``: ``dataset_key, process_name_prefix``.
    """
    names = ["continent", "country", "city"]
    taken = tasks.groupBy(*[F.lower(c).alias("_" + c) for c in names]).agg(F.min(F.struct("task_id", "status")).alias("_t"))
    owned = owners.filter("process_name_prefix is not null").groupBy(F.lower("process_name_prefix").alias("_prefix")).agg(
        F.min("dataset_key").alias("prefix_owner")
    )
    keyed = candidates.withColumns({"_" + c: F.lower(c) for c in names} | {"_prefix": F.lower("process_name_prefix")})
    joined = lookup_join(keyed.join(taken, ["_" + c for c in names], "left"), owned, ["_prefix"], "left")
    return joined.select(
        *candidates.columns, F.col("_t.task_id").alias("existing_task"), F.col("_t.status").alias("existing_status"), "prefix_owner"
    )


def append_manifest_rows(manifest: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) new rows. Rejected rows carry ``problem``: a bad field, a known task or a used prefix.

    Both sides have continent, country, city, process_name_prefix; ``new`` also ``row_no`` for its order. The
    first of several equal new rows is the one accepted.
    """
    fields = ["continent", "country", "city", "process_name_prefix"]
    cleaned = new.select("row_no", *[text.collapse_spaces(F.col(c)).alias(c) for c in fields])
    bad = F.coalesce(*[F.when(text.field_problem(F.col(c)).isNotNull(), F.concat(F.lit(c + ": "), text.field_problem(F.col(c)))) for c in fields])
    checked = cleaned.withColumn("problem", bad).withColumn("_task", F.lower(F.concat_ws("|", *fields[:3]))).withColumn(
        "_prefix", F.lower("process_name_prefix")
    )
    old_tasks = manifest.select(F.lower(F.concat_ws("|", *[text.collapse_spaces(F.col(c)) for c in fields[:3]])).alias("_task"), F.lit(True).alias("_known")).distinct()
    old_prefixes = manifest.select(F.lower(text.collapse_spaces(F.col("process_name_prefix"))).alias("_prefix"), F.lit(True).alias("_used")).distinct()
    joined = stage(lookup_join(lookup_join(checked, old_tasks, ["_task"], "left"), old_prefixes, ["_prefix"], "left"))
    good = joined.filter("problem is null and _known is null and _used is null")
    first_task = good.groupBy("_task").agg(F.min("row_no").alias("_first_task"))
    first_prefix = good.groupBy("_prefix").agg(F.min("row_no").alias("_first_prefix"))
    judged = lookup_join(lookup_join(joined, first_task, ["_task"], "left"), first_prefix, ["_prefix"], "left")
    reason = F.coalesce(
        "problem",
        F.when(F.col("_known"), "task exists"),
        F.when(F.col("_used"), "prefix in use"),
        F.when(F.col("row_no") > F.col("_first_task"), "task exists"),
        F.when(F.col("row_no") > F.col("_first_prefix"), "prefix in use"),
    )
    judged = judged.withColumn("problem", reason)
    folder = text.default_download_dir(*[F.col(c) for c in fields[:3]], separator="\\")
    accepted = judged.filter("problem is null").select("row_no", *fields[:3], folder.alias("download_dir"), fields[3])
    return accepted, judged.filter("problem is not null").select("row_no", *fields, "problem")


def first_existing_candidate(items: DataFrame, candidates: Column, listing: DataFrame, key: str) -> DataFrame:
    """Per item the first candidate path that exists in ``listing`` (column ``path``), NULL when none does."""
    asked = items.select(key, F.posexplode(candidates).alias("pos", "path"))
    found = lookup_join(listing.select("path").distinct(), asked, ["path"]).groupBy(key).agg(F.min_by("path", "pos").alias("found_path"))
    return items.join(found, key, "left")


def boundary_file_candidates(slug: Column, root: str = "") -> Column:
    names = [F.concat(F.lit(root), slug, F.lit(end)) for end in ("_adm1.shp", "_adm1.gpkg", ".shp", ".gpkg")]
    return F.array(*names)


def match_existing_datasets(datasets: DataFrame, tasks: DataFrame, country_keys: list[str]) -> DataFrame:
    """Dataset folders with the first task (queue order) whose city has the folder's name, within some countries.

    ``datasets``: ``directory``; ``tasks``: ``task_id, country, city, order_no``; no match leaves NULL.
    """
    countries = tasks.select("country").distinct().withColumn("_ck", text.normalize_name("country")).filter(F.col("_ck").isin(country_keys))
    cities = tasks.select("city").distinct().withColumn("name_key", text.normalize_name("city"))
    eligible = lookup_join(lookup_join(tasks, countries.select("country"), ["country"], "left_semi"), cities, ["city"])
    first = eligible.groupBy("name_key").agg(F.min_by("task_id", F.struct("order_no", "task_id")).alias("task_id"))
    named = datasets.withColumn("name_key", text.normalize_name(text.file_name(F.col("directory"))))
    return lookup_join(named, first, ["name_key"], "left").drop("name_key")


def classify_by_prefix(files: DataFrame, groups: DataFrame, name: str = "file_name") -> DataFrame:
    """Files with the group whose key their name starts with (``<key>_``), else ``unclassified``.

    ``groups``: ``pos, group_key, group_name``; the first key in order wins. Keys may hold underscores, so every
    leading part of the name up to an underscore is looked up.
    """
    heads = F.filter(
        F.transform(F.sequence(F.lit(1), F.length(name)), lambda n: F.when(F.substr(F.col(name), n, F.lit(1)) == "_", F.left(F.col(name), n - 1))),
        lambda h: h.isNotNull(),
    )
    asked = files.select(name).distinct().select(name, F.explode(heads).alias("group_key"))
    hits = lookup_join(asked, groups.select("pos", "group_key", "group_name"), ["group_key"])
    best = hits.groupBy(name).agg(F.min_by("group_name", "pos").alias("_group"))
    return lookup_join(files, best, [name], "left").withColumn("group_name", F.coalesce("_group", F.lit("unclassified"))).drop("_group")
