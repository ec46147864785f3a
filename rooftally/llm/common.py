"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the fold kept for measuring: crc32 of the id as text leaves 1 modulo 3. False for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts of ``column``, by one partially aggregated scan."""
    return df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def give_back() -> None:
    """Return what this worker has freed to the system: workers live on, and each would keep the most it ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def map_sorted_groups(df: DataFrame, keys: list[str], partitions: int | None, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` over the rows of each distinct ``keys``, streamed through tasks sorted by them.

    For very many small groups: a task starts no new Arrow stream per group, only the group at hand is held.
    """
    dealt = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_pylist() for k in keys]
            marks = list(zip(*columns))
            start = 0
            for i, mark in enumerate(marks):
                if mark != last:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    if held:
                        yield from function(pa.Table.from_batches(held)).to_batches()
                    held, start, last = [], i, mark
            held.append(batch.slice(start))
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()
        held = batch = columns = marks = None
        give_back()

    return dealt.sortWithinPartitions(*keys).mapInArrow(run, schema)
