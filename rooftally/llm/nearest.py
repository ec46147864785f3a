"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree.

Vectors of length one are projected by a Gaussian (2-stable) matrix: the squared projected distance of a pair over its
squared distance is chi-square distributed. A kd-tree over the projections gives neighbours in the order of their
projected distance; each is verified on the original vector, until any better row would, with the chosen probability, have
been met already.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally.llm.vectors import QUERIES_PER_BLOCK, ROWS_PER_SHARD, Best, search_blocks

#: Dimensions of the projection (even, so that the chi-square distribution has a closed form).
PROJECTED = 16
#: Probability with which a row nearer than the k-th found has been met when the search stops.
CONFIDENCE = 0.995
LEAF_ROWS = 128
SEED = 20_14


def chi_square_quantile(p: float, degrees: int) -> float:
    """Smallest x with P(chi-square <= x) >= p, for an even number of degrees of freedom."""

    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 10.0 * degrees + 200
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


class KdTree:
    """Median splits along the widest side down to leaves; a leaf keeps its rows and its bounding box."""

    def __init__(self, points: np.ndarray, leaf_rows: int):
        self.points = points
        self.leaves: list[np.ndarray] = []
        waiting = [np.arange(len(points))]
        while waiting:
            rows = waiting.pop()
            box = points[rows]
            spread = np.ptp(box, axis=0)
            axis = int(spread.argmax())
            if len(rows) <= leaf_rows or spread[axis] == 0:
                self.leaves.append(rows)
                continue
            half = len(rows) // 2
            order = np.argpartition(box[:, axis], half)
            waiting += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([points[rows].min(axis=0) for rows in self.leaves])
        self.high = np.array([points[rows].max(axis=0) for rows in self.leaves])

    def nearest_first(self, at: np.ndarray):
        """Leaves in the order of the least squared distance that their rows can have, with that distance."""
        outside = np.maximum(self.low - at, 0) + np.maximum(at - self.high, 0)
        least = (outside * outside).sum(axis=1)
        for leaf in np.argsort(least, kind="stable"):
            yield least[leaf], self.leaves[leaf]


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near one: no cosine changes, nothing overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def search_projected(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The ``k`` nearest found of each query: (query position, row position, cosine)."""
    vectors, queries = scaled(vectors), scaled(queries)
    length, query_length = np.sqrt((vectors * vectors).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    matrix = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTED))
    tree = KdTree((vectors / length[:, None]) @ matrix, LEAF_ROWS)
    stop = chi_square_quantile(CONFIDENCE, PROJECTED)
    found = []
    for q, (query, size) in enumerate(zip(queries, query_length)):
        best = Best(k)
        for least, rows in tree.nearest_first((query / size) @ matrix):
            # squared distance of the k-th found on the unit sphere; the test holds beyond its quantile
            if best.bound is not None and least > stop * max(0.0, 2 - 2 * best.bound) + 1e-9:
                break
            rows = rows[ids[rows] != query_ids[q]]
            best.add((vectors[rows] * query).sum(axis=1) / (length[rows] * size), rows)
        found += [(q, int(c), float(s)) for s, c in zip(best.scores, best.places)]
    return found


def nearest_neighbours(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", rows_per_shard: int = ROWS_PER_SHARD, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """The ``k`` rows of largest cosine found for every row that ``is_query`` selects.

    Returns ``query_id``, ``rank``, ``vec_id``, ``score`` (cosine in double precision on the original vectors). All rows
    are indexed; no table-wide sample is fitted, as the projection does not depend on the data. NULL, empty and zero
    vectors and those with a NULL or non-finite component take no part; see ``search_blocks`` for ids and ties.
    """
    some = F.exists(F.col(vector), lambda x: x != 0)
    return search_blocks(rows.filter(some), is_query, search_projected, "double", k, vec_id, vector, rows_per_shard, queries_per_block)
