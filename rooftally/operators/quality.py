"""Layer normalisation, cleaning, duplicate removal and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftally import fixed_values as fixed
from rooftally.functions import geometry as geo
from rooftally.functions import kernels
from rooftally.functions import parts as multi


# --- projections ----------------------------------------------------------------------------------------------

def normalize_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw feature properties to the delivered names; only columns that exist, in the fixed order.

    Numbers that cannot be read become NULL, identifiers are text, and a missing identifier stays NULL. ``keep``
    names technical columns to carry along.
    """
    made: dict[str, Column] = {}
    for raw, name, kind in [
        ("id", "GBA_ID", "string"), ("height", "Height", "double"), ("var", "H_VAR", "double"),
        ("source", "SOURCE", "string"), ("region", "REGION", "string"),
    ]:
        if raw in df.columns:
            made[name] = F.col(raw).try_cast(kind) if kind == "double" else F.col(raw).cast("string")
    carried = {c: F.col(c) for c in (*fixed.LAYER_COLUMNS, "rings") if c in df.columns and c not in made}
    chosen = {**made, **carried}
    return df.select(*[chosen[c].alias(c) for c in (*fixed.LAYER_COLUMNS, "rings") if c in chosen], *(keep or []))


def with_tile_id(df: DataFrame, tile_id: str | Column) -> DataFrame:
    return df.withColumn("TILE_ID", F.lit(tile_id) if isinstance(tile_id, str) else tile_id)


def rename_height(df: DataFrame) -> DataFrame:
    """The first of Height, height, HEIGHT becomes ``Height``; nothing happens when it is there or absent."""
    found = next((c for c in ("Height", "height", "HEIGHT") if c in df.columns), None)
    return df if found in (None, "Height") else df.withColumnRenamed(found, "Height")


def height_column(columns: list[str]) -> str | None:
    """Height column the cleaning step recognises (the all-lower-case spelling is not one)."""
    return next((c for c in ("HEIGHT", "Height") if c in columns), None)


def scale_height(df: DataFrame, factor: float, field: str = "HEIGHT") -> DataFrame:
    """Multiply readable numbers; NULL stays NULL and text that is no number stays as it is."""
    if field not in df.columns:
        raise ValueError(f"the layer has no field {field!r}")
    number = F.col(field).try_cast("double")
    scaled = number * F.lit(float(factor))
    if df.schema[field].dataType.typeName() == "string":
        return df.withColumn(field, F.when(number.isNotNull(), scaled.cast("string")).otherwise(F.col(field)))
    return df.withColumn(field, scaled)


def scale_report(df: DataFrame, field: str = "HEIGHT") -> DataFrame:
    number, value = F.col(field).try_cast("double"), F.col(field)
    return df.agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.count_if(number.isNotNull()).alias("scaled_count"),
        F.count_if(value.isNull()).alias("null_count"),
        F.count_if(value.isNotNull() & number.isNull()).alias("non_numeric_count"),
    )


# --- filters --------------------------------------------------------------------------------------------------

def non_positive(height: Column) -> Column:
    """A readable height of zero or less; NULL and unreadable text are not."""
    return F.coalesce(height.try_cast("double") <= 0, F.lit(False))


def drop_empty_geometry(df: DataFrame, rings: str = "rings") -> DataFrame:
    return df.filter(geo.has_geometry(F.col(rings)))


def drop_non_positive_height(df: DataFrame, field: str | None = None) -> DataFrame:
    name = field or height_column(df.columns)
    return df if name is None else df.filter(~non_positive(F.col(name)))


def drop_invalid_geometry(df: DataFrame, rings: str = "rings") -> DataFrame:
    return df.filter(valid_geometry(F.col(rings)))


def valid_geometry(rings: Column, parts: Column | None = None) -> Column:
    """Validity test, with the roles of the rings where ``parts`` are given; plain rectangles are decided without leaving the JVM."""
    box = geo.is_box(rings)
    return box | (kernels.is_valid(F.when(~box, rings)) if parts is None else multi.is_valid(F.when(~box, parts)))


def flag_validity(df: DataFrame, name: str = "_valid", rings: str = "rings") -> DataFrame:
    """``df`` with the validity of each feature, in two branches: plain rectangles never reach Python.

    Features with ``parts`` are judged with their roles: holes in their shell, no part within another.
    """
    box = F.coalesce(geo.is_box(F.col(rings)), F.lit(False))
    plain = df.filter(box).withColumn(name, F.lit(True))
    test = multi.is_valid("parts") if "parts" in df.columns else kernels.is_valid(rings)
    return plain.unionByName(df.filter(~box).withColumn(name, test))


def split_by_validity(df: DataFrame, rings: str = "rings") -> tuple[DataFrame, DataFrame]:
    """Valid and invalid features as two DataFrames with the same columns."""
    flagged = flag_validity(df, "_valid", rings)
    return flagged.filter("_valid").drop("_valid"), flagged.filter("not _valid").drop("_valid")


# --- duplicates -----------------------------------------------------------------------------------------------

def dedup_geometry(
    df: DataFrame, order: list[str | Column], key: list[str] | None = None, within: list[str] | None = None
) -> DataFrame:
    """Keep the first feature of every group with exactly the same geometry.

    ``order`` says which is first (tile order, then place in the tile) and must be total for a definite result;
    NULLs sort last. ``within`` limits duplicates to a chunk. ``key`` defaults to ``rings``; for layers of plain
    boxes the four bounds say the same and are smaller. The rank filter is applied in every map task before the
    shuffle, so a geometry that is copied into a third of all rows costs one row per task.
    """
    columns = key or ["rings"]
    # rows are sorted by the digest first, a number that nearly always decides
    groups = [F.xxhash64(*columns), *(within or []), *columns]
    ranked = [(F.col(o) if isinstance(o, str) else o).asc_nulls_last() for o in order]
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*ranked))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


# --- reports --------------------------------------------------------------------------------------------------

def clean_report(df: DataFrame, key: list[str] | None = None, within: list[str] | None = None, height: str | None = None) -> DataFrame:
    """Rows in and out of the cleaning step and what removed them; one row, or one per ``within``.

    Duplicates are counted per distinct geometry first (partial aggregation), never by collecting a group.
    """
    columns, scope = key or ["rings"], within or []
    name = height or height_column(df.columns)
    empty = ~geo.has_geometry(F.col("rings")) if "rings" in df.columns else F.lit(False)
    flat = F.lit(False) if name is None else non_positive(F.col(name))
    flagged = df.withColumns({"_empty": empty, "_flat": ~empty & flat})
    shaped = (
        flagged.withColumn("_hash", F.xxhash64(*columns))
        .groupBy(*scope, "_hash", *columns)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if("_empty").alias("_empty"),
            F.count_if("_flat").alias("_flat"),
            F.count_if(~F.col("_empty") & ~F.col("_flat")).alias("_kept"),
        )
    )
    return shaped.groupBy(*scope).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("input_count"),
        F.count_if(F.col("_kept") > 0).alias("output_count"),
        F.coalesce(F.sum("_empty"), F.lit(0)).alias("removed_empty_count"),
        F.coalesce(F.sum("_flat"), F.lit(0)).alias("removed_zero_height_count"),
        F.coalesce(F.sum(F.greatest(F.col("_kept") - 1, F.lit(0))), F.lit(0)).alias("removed_duplicate_count"),
    )


def validity_report(df: DataFrame, by: list[str], rings: str = "rings") -> DataFrame:
    """Valid, invalid and unreadable (NULL or empty) geometries per shard."""
    present = geo.has_geometry(F.col(rings))
    valid = valid_geometry(F.col(rings), F.col("parts") if "parts" in df.columns else None)
    flagged = df.select(*by, present.alias("_present"), valid.alias("_valid"))
    return flagged.groupBy(*by).agg(
        F.count_if(F.col("_present") & F.col("_valid")).alias("valid_count"),
        F.count_if(F.col("_present") & ~F.col("_valid")).alias("invalid_count"),
        F.count_if(~F.col("_present")).alias("error_count"),
    )


def size_guard(components: DataFrame, limit: float = fixed.MERGE_LIMIT_BYTES, by: list[str] | None = None) -> DataFrame:
    """Sum of the part sizes per component suffix and whether it stays within the limit (each on its own)."""
    totals = components.groupBy(*(by or []), "suffix").agg(F.sum("size").alias("total_bytes"))
    return totals.withColumn("accepted", F.col("total_bytes") <= F.lit(float(limit)))


# --- unions ---------------------------------------------------------------------------------------------------

def merge_layers(layers: list[tuple[DataFrame, int | None]], dedup_order: list[str] | None = None) -> DataFrame:
    """Concatenate layers: schemas united, coordinates brought to the system of the first layer.

    Each layer is given with its SRID (None means 4326). ``layer_no`` keeps the input order; with
    ``dedup_order`` (columns after it) exact copies are removed, first one kept.
    """
    if not layers:
        raise ValueError("no layer to merge")
    target = layers[0][1] or 4326
    united = None
    for number, (df, srid) in enumerate(layers):
        moved = to_srid(df, srid or 4326, target).withColumn("layer_no", F.lit(number))
        united = moved if united is None else united.unionByName(moved, allowMissingColumns=True)
    return united if dedup_order is None else dedup_geometry(united, ["layer_no", *dedup_order])


def to_srid(df: DataFrame, source: int, target: int, rings: str = "rings") -> DataFrame:
    """Between degrees (4326) and web mercator metres (3857)."""
    if source == target:
        return df
    moves = {(4326, 3857): geo.to_mercator, (3857, 4326): geo.to_degrees}
    if (source, target) in moves:
        move = moves[source, target]
        # the parts of a geometry, where it has them, stay in step with its rings
        kept = {"parts": F.transform("parts", move)} if "parts" in df.columns else {}
        return df.withColumns({rings: move(F.col(rings))} | kept)
    raise ValueError(f"no transformation from {source} to {target}")


def reproject(df: DataFrame, srid: int | None, target: int = 3857, rings: str = "rings") -> DataFrame:
    """Reprojection of a layer; a layer without a reference system is refused here."""
    if srid is None:
        raise ValueError("the layer has no coordinate reference system")
    return to_srid(df, srid, target, rings)


def assume_srid(srid: Column) -> Column:
    return F.coalesce(srid, F.lit(4326))
