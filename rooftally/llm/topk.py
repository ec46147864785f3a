"""Exact top-k inner products by MaxScore over integer components.

A component is a term and its values are the term's postings. Per block of rows the largest contribution of each term
to a query is known. Terms are taken in the order of those bounds: the essential ones are those without which a row
could not reach the k-th best score; their postings are traversed for the whole block, the others are probed only for
rows that stay competitive. Shards are merged by rank.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame

from rooftally.llm.vectors import QUERIES_PER_BLOCK, ROWS_PER_SHARD, Best, search_blocks

#: Rows whose bounds are kept together, and terms that are probed between two looks at the bounds.
BLOCK_ROWS = 512
PROBED_TERMS = 8
#: Integers up to here are exact as doubles.
EXACT = float(1 << 53)
LONGEST = (1 << 63) - 1


def search_max_score(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The ``k`` highest scores of each query: (query position, row position, score).

    Sums that doubles hold exactly are added as doubles, larger ones as Python integers; a score beyond a long is
    returned as the nearest long.
    """
    with np.errstate(over="ignore"):
        rows, asked = np.floor(vectors * 256), np.floor(queries * 256)
        small = float(np.abs(rows).max()) * float(np.abs(asked).max()) * rows.shape[1] < EXACT
    if not small:
        exact = lambda m: np.array([[int(x) * 256 if abs(x) > EXACT else int(np.floor(x * 256)) for x in v] for v in m.tolist()], dtype=object)
        rows, asked = exact(vectors), exact(queries)
    kind = np.float64 if small else object
    blocks = [(at, rows[at : at + BLOCK_ROWS]) for at in range(0, len(rows), BLOCK_ROWS)]
    high, low = np.array([b.max(axis=0) for _, b in blocks]), np.array([b.min(axis=0) for _, b in blocks])
    found = []
    for q, query in enumerate(asked):
        best = Best(k, kind)
        bounds = np.maximum(high * query, low * query)  # most that a term adds in each block
        total = bounds.sum(axis=1)
        for b in np.argsort(-total, kind="stable"):
            if best.bound is not None and total[b] < best.bound:
                break
            terms = np.argsort(-np.abs(bounds[b]), kind="stable")
            rest = total[b] - np.cumsum(bounds[b][terms])  # most that the terms after each place still add
            at, block = blocks[b]
            places = np.arange(at, at + len(block))
            places = places[ids[at : at + len(block)] != query_ids[q]]
            if not len(places):
                continue
            done = len(terms)
            if best.bound is not None:
                # essential: the fewest leading terms whose absence would leave a row below the k-th score
                done = max(PROBED_TERMS, int(np.argmax(rest < best.bound)) + 1 if (rest < best.bound).any() else done)
            score = block[places - at][:, terms[:done]] @ query[terms[:done]]
            while done < len(terms) and len(places):
                alive = score + rest[done - 1] >= best.bound
                places, score, more = places[alive], score[alive], terms[done : done + PROBED_TERMS]
                score = score + block[(places - at)[:, None], more] @ query[more]
                done += len(more)
            best.add(score, places)
        found += [(q, int(c), int(max(-LONGEST - 1, min(LONGEST, s)))) for s, c in zip(best.scores.tolist(), best.places)]
    return found


def top_inner_products(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", rows_per_shard: int = ROWS_PER_SHARD, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """The ``k`` rows of highest integer inner product of floor(256 x) for every row that ``is_query`` selects.

    Returns ``query_id``, ``rank``, ``vec_id``, ``score`` (long). Zero vectors score 0 and take part. NULL and empty vectors
    and those with a NULL or non-finite component do not; see ``search_blocks`` for ids and ties.
    """
    return search_blocks(rows, is_query, search_max_score, "bigint", k, vec_id, vector, rows_per_shard, queries_per_block)
