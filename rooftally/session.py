"""Session defaults and the few helpers that concern how a plan is run."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side of a join is broadcast only after one pass over it has shown that it has no more rows and bytes than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 200 << 20
# Copies made of the rows of a hot key on the small side, and buckets of those on the large side, when a join is not broadcast.
SALTS = 16
# A key of more rows than this is hot: fewer are no burden for one task.
HOT_ROWS = 50_000


def build_session(app: str = "rooftally", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; explicit ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: what the session names, else a new one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(named)
    return named


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors, keeps column pruning and gives the next plan true sizes.
    """
    target = f"{shared_folder(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows; reads at most one row beyond that."""
    return df.limit(rows + 1).count() <= rows


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to be sent to every executor, by rows and by (estimated) bytes.

    Texts count with their length and nested values with the length of their JSON form, which is above their size
    in memory for numbers of more than a few digits; no more than ``max_rows`` rows and one are looked at.
    """
    weight = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            weight = weight + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("array", "struct", "map"):
            weight = weight + F.length(F.to_json(F.struct(field.name)))
    # only one number per row reaches the task that adds them up
    weights = df.select(weight.cast("long").alias("weight")).limit(max_rows + 1)
    found = weights.agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    condition: Column | None = None,
    salt_by: list[str] | None = None,
    small_rows: int | None = None,
) -> DataFrame:
    """Equi-join ``big`` with a side that is usually small.

    The small side is broadcast when one pass over it proves it small (rows and bytes). Otherwise the rows of the hot keys of ``big`` are spread
    over ``SALTS`` buckets, and their rows of the other side are copied once per bucket, so that one hot key is shared
    by many tasks; all other rows are joined as they are. Both ways give the same rows. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    ``small_rows`` gives the size of the small side where the caller has counted it already.
    """
    small_names = [c for c in small.columns if c not in on]
    if fits_broadcast(small, max_rows) if small_rows is None else small_rows <= max_rows:
        left, right, keys = big, F.broadcast(small), list(on)
    else:
        left, right, keys = big, small, list(on)
        hot = stage(big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS).select(*on, F.lit(True).alias("_hot")))
        if not has_at_most(hot, 0):
            spread = salt_by or [f.name for f in big.schema.fields if f.dataType.typeName() not in ("map", "variant")]
            marked = F.broadcast(hot) if fits_broadcast(hot) else hot
            # keys that are NULL meet nothing, so their rows may go anywhere
            anywhere = F.coalesce("_hot", F.lit(False)) | reduce(Column.__or__, [F.col(k).isNull() for k in on])
            bucket = F.when(anywhere, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0)
            copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            left = big.join(marked, on, "left").withColumn("_salt", bucket).drop("_hot")
            right = small.join(marked, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
            keys = [*on, "_salt"]
    if condition is None:
        return left.join(right, keys, how).drop("_salt")
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *small_names)
    match = condition
    for key in keys:
        match = match & (F.col(key) == F.col(f"_r_{key}"))
    joined = left.join(renamed, match, how)
    return joined.drop("_salt", *[f"_r_{k}" for k in keys])


def with_position(df: DataFrame, *order: Column | str, name: str = "position", partitions: int | None = None) -> DataFrame:
    """Number all rows 1..n in a total order without sending them through one task.

    Rows are range-partitioned and sorted, written once, and each partition then gets the row count of the
    partitions before it. ``order`` should end in a unique column so that equal keys still spread.
    """
    spark = df.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    stamped = stage(
        df.repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_wp_part", F.spark_partition_id())
        .withColumn("_wp_nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    # One row per partition: the running sum sees no more than ``count`` rows.
    sizes = stamped.groupBy("_wp_part").agg(F.count(F.lit(1)).alias("_wp_size"))
    earlier = Window.orderBy("_wp_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_wp_part", F.coalesce(F.sum("_wp_size").over(earlier), F.lit(0)).alias("_wp_before"))
    return (
        stamped.join(F.broadcast(offsets), "_wp_part")
        .withColumn(name, F.col("_wp_before") + F.col("_wp_nth") + 1)
        .drop("_wp_part", "_wp_nth", "_wp_before")
    )
