"""Searching a stated set of query vectors against all rows, in blocks.

Candidates are dealt by a hash of their id into shards of a bounded number of rows, queries into blocks of a bounded
number; every (block, shard) pair is one group that a task can hold, whatever the size of the table. Each group returns
its own best rows and the few best of all groups are merged by rank, which Spark begins before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SHARD = 4096
QUERIES_PER_BLOCK = 4096

#: ``(ids, vectors, query_ids, queries, k) -> rows (query position, candidate position, score)``.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], list[tuple[int, int, float]]]


def usable(vector: Column) -> Column:
    """Not NULL, not empty, and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def as_matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.float64())
    return np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).reshape(-1, dim), dtype=np.float64)


def search_blocks(rows: DataFrame, is_query: Column, search: Search, score_type: str, k: int, vec_id: str, vector: str, rows_per_shard: int, queries_per_block: int) -> DataFrame:
    """The ``k`` best candidates of every query by ``search``: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Rows without an id take no part. Candidates are all rows of another id and the same number of components; an id
    that occurs more than once is one query (its smallest vector) but as many candidates. Ties go to the smaller id.
    """
    part = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("asked"))
    part = part.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    sizes = part.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("long")).alias("q")).first()
    shards, blocks = -(-max(1, sizes["n"]) // rows_per_shard), -(-max(1, sizes["q"] or 0) // queries_per_block)
    keys = ["dim", "block", "shard"]
    data = part.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = part.filter("asked").groupBy("id", "dim").agg(F.min("v").alias("v"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    kind = pa.float64() if score_type == "double" else pa.int64()

    def one_group(key: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        ids, query_ids = candidates["id"].to_numpy(), queries["id"].to_numpy()
        if len(ids) and len(query_ids):
            dim = key[0].as_py()
            order = np.argsort(ids, kind="stable")  # positions stand in the order of ids, so ties are settled by position
            ids = ids[order]
            found = search(ids, as_matrix(candidates["v"], dim)[order], query_ids, as_matrix(queries["v"], dim), k)
        return pa.table(
            {
                "query_id": pa.array([int(query_ids[q]) for q, _, _ in found], pa.int64()),
                "vec_id": pa.array([int(ids[c]) for _, c, _ in found], pa.int64()),
                "score": pa.array([s for _, _, s in found], kind),
            }
        )

    groups = data.select(*keys, "id", "v").groupBy(*keys).cogroup(asked.select(*keys, "id", "v").groupBy(*keys))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = groups.applyInArrow(one_group, f"query_id bigint, vec_id bigint, score {score_type}").withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The ``k`` best (score, position) seen so far; equal scores prefer the smaller position."""

    def __init__(self, k: int, dtype=np.float64):
        self.k = k
        self.scores = np.empty(0, dtype)
        self.places = np.empty(0, np.int64)

    def add(self, scores: np.ndarray, places: np.ndarray) -> None:
        if len(self.places) == self.k:
            keep = scores >= self.scores[-1]
            if not keep.any():
                return
            scores, places = scores[keep], places[keep]
        scores, places = np.concatenate([self.scores, scores]), np.concatenate([self.places, places])
        order = np.lexsort((places, -scores))[: self.k]
        self.scores, self.places = scores[order], places[order]

    @property
    def bound(self):
        """The score that a row must reach; None while fewer than ``k`` are known."""
        return self.scores[-1] if len(self.places) == self.k else None
