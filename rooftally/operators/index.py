"""The footprint index: one bounding box per shard, its upkeep and its rectangle queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally.functions import geometry as geo
from rooftally.functions import text
from rooftally.operators import spatial
from rooftally.session import has_at_most, lookup_join, with_position

INDEX_KEY = ["continent", "country", "city", "shp_name"]
REGION_KEY = ["continent", "country", "city"]


def layer_bounds(features: DataFrame, by: list[str], metric: bool = True) -> DataFrame:
    """Bounds of every shard; with ``metric`` the bounds are turned into EPSG:3857 (both axes grow with degrees)."""
    totals = features.groupBy(*by).agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")
    )
    if not metric:
        return totals
    return totals.withColumns(
        {
            "minx": geo.mercator_x(F.col("minx")), "miny": geo.mercator_y(F.col("miny")),
            "maxx": geo.mercator_x(F.col("maxx")), "maxy": geo.mercator_y(F.col("maxy")),
        }
    )


def with_bbox_wkt(df: DataFrame, name: str = "bbox_wkt") -> DataFrame:
    return df.withColumn(name, geo.bbox_wkt(*spatial.box_columns().values()))


# --- queries --------------------------------------------------------------------------------------------------

def shards_intersecting(index: DataFrame, minx: float, miny: float, maxx: float, maxy: float, srid: int = 3857) -> DataFrame:
    """Index rows whose box meets the rectangle, given in metres or (4326) in degrees."""
    if srid == 4326:
        corners = index.sparkSession.range(1).select(
            geo.mercator_x(F.lit(minx)), geo.mercator_y(F.lit(miny)), geo.mercator_x(F.lit(maxx)), geo.mercator_y(F.lit(maxy))
        ).first()
        minx, miny, maxx, maxy = corners
    return spatial.scan_bbox(index, minx, miny, maxx, maxy)


def export_rectangle(
    index: DataFrame, features: DataFrame, rectangle: tuple[float, float, float, float], on: list[str], srid: int = 3857
) -> DataFrame:
    """Features of the shards the index names, whose geometry meets the rectangle.

    ``features`` and the index share the columns ``on`` and the reference system of ``rectangle`` is theirs.
    """
    shards = shards_intersecting(index, *rectangle, srid=srid).select(*on).distinct()
    found = lookup_join(features, shards, on, "left_semi")
    if "rings" in features.columns:
        return spatial.filter_rectangle(found, *rectangle)
    return spatial.scan_bbox(found, *rectangle)


def distinct_tasks(index: DataFrame) -> DataFrame:
    """Distinct trimmed region keys with the name prefix of their shards; blank keys are left out."""
    keys = {c: F.trim(c) for c in REGION_KEY}
    present = None
    for column in INDEX_KEY:
        test = F.coalesce(F.trim(column) != "", F.lit(False))
        present = test if present is None else present & test
    prefix = text.first_token(F.col("shp_name"))
    rows = index.filter(present & (prefix != "")).select(
        *[c.alias(n) for n, c in keys.items()], prefix.alias("process_name_prefix")
    )
    return rows.distinct()


def duplicate_keys(df: DataFrame, key: list[str], row_no: str | None = None) -> DataFrame:
    """Keys that occur more than once, with their count and first and last row number."""
    extras = [] if row_no is None else [F.min(row_no).alias("first_row"), F.max(row_no).alias("last_row")]
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *extras).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, key: list[str], what: str = "rows", allow_empty: bool = True) -> DataFrame:
    """``df`` itself; raises when a key repeats (naming three of them) or when it is empty and must not be."""
    if not allow_empty and has_at_most(df, 0):
        raise ValueError(f"no {what} found")
    repeated = duplicate_keys(df, key).select(*key).take(3)
    if repeated:
        raise ValueError(f"duplicate {what}: {[tuple(r) for r in repeated]}")
    return df


def paged_json(rows: DataFrame, item: Column, order: list[str], page_size: int = 10_000) -> DataFrame:
    """JSON documents ``{"list":[...]}`` of at most ``page_size`` items each: ``page, n, document``.

    All items come out; a result that fits one page is one document, an empty one is ``{"list":[]}``.
    """
    if has_at_most(rows, 0):
        return rows.sparkSession.createDataFrame([(0, 0, '{"list":[]}')], "page long, n long, document string")
    numbered = with_position(rows.select(*order, item.alias("_item")), *order, name="_position")
    pages = numbered.groupBy(F.floor((F.col("_position") - 1) / page_size).alias("page")).agg(
        F.count(F.lit(1)).alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("_position", "_item"))), lambda s: s["_item"]).alias("list"),
    )
    return pages.select("page", "n", F.to_json(F.struct(F.col("list"))).alias("document"))


def shard_list_json(index: DataFrame, page_size: int = 10_000) -> DataFrame:
    """Shard paths as JSON list documents, ordered by path."""
    paths = index.select(text.shard_path(*[F.col(c) for c in INDEX_KEY]).alias("path"))
    return paged_json(paths, F.col("path"), ["path"], page_size)


def _feature(df: DataFrame, geometry: Column, drop: list[str]) -> Column:
    properties = [c for c in df.columns if c not in drop]
    body = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    return F.concat(F.lit('{"type":"Feature","geometry":'), geometry, F.lit(',"properties":'), body, F.lit("}"))


def feature_json(df: DataFrame, geometry: Column, drop: list[str]) -> DataFrame:
    """One GeoJSON Feature per row: ``feature`` (properties = the row without its geometry columns)."""
    return df.select(_feature(df, geometry, drop).alias("feature"))


def to_feature_collection(df: DataFrame, geometry: Column, drop: list[str], order: list[str], srid: int = 3857, page_size: int = 10_000) -> DataFrame:
    """FeatureCollections with a ``crs`` member, at most ``page_size`` features each, in ``order`` and, where that leaves ties, in the order of their text."""
    feature = _feature(df, geometry, drop)
    numbered = with_position(df.select(*order, feature.alias("_f")), *order, "_f", name="_position")
    head = f'{{"type":"FeatureCollection","crs":{{"type":"name","properties":{{"name":"EPSG:{srid}"}}}},"features":['
    joined = F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("_position", "_f"))), lambda s: s["_f"]))
    return numbered.groupBy(F.floor((F.col("_position") - 1) / page_size).alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.concat(F.lit(head), joined, F.lit("]}")).alias("document")
    )


# --- upkeep ---------------------------------------------------------------------------------------------------

def replace_region(index: DataFrame, new: DataFrame, regions: DataFrame, at: Column | None = None) -> DataFrame:
    """Index with the rows of the given regions replaced by the recomputed ones of those regions, stamped if a time is given."""
    keys = regions.select(*REGION_KEY).distinct()
    fresh = lookup_join(new, keys, REGION_KEY, "left_semi")
    assert_unique(fresh, INDEX_KEY, "index rows")
    fresh = fresh if at is None else touch(fresh, at)
    return lookup_join(index, keys, REGION_KEY, "left_anti").unionByName(fresh, allowMissingColumns=True)


def replace_counts(index: DataFrame, new: DataFrame, regions: DataFrame) -> DataFrame:
    """Per region: rows deleted, rows inserted and shards skipped for want of a box."""
    keys = regions.select(*REGION_KEY).distinct()
    old = lookup_join(index, keys, REGION_KEY, "left_semi").select(*REGION_KEY, F.lit(1).alias("d"), F.lit(0).alias("i"), F.lit(0).alias("s"))
    usable = F.col("minx").isNotNull()
    fresh = lookup_join(new, keys, REGION_KEY, "left_semi").select(
        *REGION_KEY, F.lit(0).alias("d"), F.when(usable, 1).otherwise(0).alias("i"), F.when(usable, 0).otherwise(1).alias("s")
    )
    return old.unionByName(fresh).groupBy(*REGION_KEY).agg(
        F.sum("d").alias("deleted"), F.sum("i").alias("inserted"), F.sum("s").alias("skipped")
    )


def insert_if_absent(index: DataFrame, new: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Index plus the new rows whose key it does not hold; a key that repeats in ``new`` is taken once."""
    columns = key or INDEX_KEY
    added = new.dropDuplicates(columns).join(index.select(*columns), columns, "left_anti")
    return index.unionByName(added, allowMissingColumns=True)


def upsert_rows(table: DataFrame, rows: DataFrame, key: list[str], at: Column | None = None) -> DataFrame:
    """Table with the rows of equal key replaced and the others appended; ``rows`` are stamped if a time is given."""
    rows = rows if at is None else touch(rows, at)
    return table.join(rows.select(*key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete_keys(table: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    return table.join(keys.select(*key), key, "left_anti")


def reset_marks(marks: DataFrame, keys: DataFrame, stamp: Column) -> DataFrame:
    """Marks of the given keys set back to not updated; keys without a mark are ignored."""
    listed = keys.select("dataset_key").distinct().withColumn("_reset", F.lit(True))
    joined = lookup_join(marks, listed, ["dataset_key"], "left")
    reset = F.coalesce("_reset", F.lit(False))
    return joined.withColumns(
        {"updated": F.col("updated") & ~reset, "updated_at": F.when(reset, stamp).otherwise(F.col("updated_at"))}
    ).drop("_reset")


def touch(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Stamp ``updated_at`` on changed rows."""
    return df.withColumn("updated_at", F.current_timestamp() if at is None else at)


def locate_region(listing: DataFrame, city: str, continent: str | None = None, country: str | None = None) -> DataFrame:
    """The region folder that matches; none or several is an error."""
    wanted = {"city": city, "continent": continent, "country": country}
    found = listing
    for column, value in wanted.items():
        if value is not None:
            found = found.filter(F.col(column) == value)
    regions = found.select(*REGION_KEY).distinct()
    hits = regions.take(2)
    if len(hits) != 1:
        raise ValueError(f"{'no' if not hits else 'more than one'} region matches {wanted}")
    return found
