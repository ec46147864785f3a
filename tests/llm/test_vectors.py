"""Both vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftally.llm.nearest import KdTree, chi_square_quantile, nearest_neighbours
from rooftally.llm.queries import QUERIES
from rooftally.llm.topk import top_inner_products

SCHEMA = "vec_id long, embedding array<double>, score string, rank int"
NAN, INF = math.nan, math.inf


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.standard_normal(8).round(3).tolist()) for i in range(400)]
    data += [(400 + i, data[i][1]) for i in range(30)]  # copies: ties
    data += [(1000, None), (1050, []), (1100, [0.0] * 8), (1150, [NAN] * 8), (1200, [INF, *[1.0] * 7]), (1250, [None, *[1.0] * 7]), (None, [1.0] * 8)]
    data += [(2000 + i, [1.0, float(i)]) for i in range(4)] + [(50, data[50][1])]  # another length; a repeated row
    return data, spark.createDataFrame([(i, v, "clash", 1) for i, v in data], SCHEMA)


def brute(data, score, zeros):
    valid = [(i, v) for i, v in data if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zeros or any(v))]
    out = {}
    for q, v in dict(sorted(valid, key=lambda p: (p[0], p[1]), reverse=True)).items():
        if q % 50 == 0:
            scored = sorted(((-score(v, w), i) for i, w in valid if i != q and len(w) == len(v)))
            out[q] = [(i, -s) for s, i in scored[:5]]
    return out


def found_by(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_top_inner_products(vectors):
    data, df = vectors
    want = brute(data, lambda v, w: sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)), True)
    for shard, block in ((4096, 4096), (100, 3)):
        assert found_by(top_inner_products(df, F.col("vec_id") % 50 == 0, rows_per_shard=shard, queries_per_block=block)) == want


def test_inner_products_beyond_doubles(rows):
    df = rows("vec_id long, embedding array<double>", [(0, [1e6, 3.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0]), (3, [1e300, 0.0])])
    got = found_by(top_inner_products(df, F.col("vec_id") == 0))[0]
    assert got == [(3, 2**63 - 1), (2, 256000000**2 + 768 * 512), (1, 256000000**2 + 768 * 256)]


def test_nearest_neighbours(vectors):
    data, df = vectors
    want = brute(data, lambda v, w: np.dot(v, w) / math.sqrt(np.dot(v, v)) / math.sqrt(np.dot(w, w)), False)
    got = found_by(nearest_neighbours(df, F.col("vec_id") % 50 == 0, rows_per_shard=150, queries_per_block=4))
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q in want:
        assert [round(s, 9) for _, s in got[q]] == sorted((round(s, 9) for _, s in got[q]), reverse=True)


def test_recall_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack(table.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = found_by(QUERIES["op8_nearest_neighbours"](spark, sf))
    hit = total = 0
    for i in np.flatnonzero(table.vec_id % 50 == 0):
        order = np.argsort(-(x @ x[i]))
        order = order[order != i][:5]
        hit, total = hit + len(set(table.vec_id[order]) & {v for v, _ in got[table.vec_id[i]]}), total + 5
    assert hit >= 0.9 * total


def test_empty_table(rows):
    empty = rows("vec_id long, embedding array<float>", [])
    assert nearest_neighbours(empty, F.col("vec_id") % 50 == 0).count() == 0
    assert top_inner_products(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_parts():
    assert abs(chi_square_quantile(0.95, 10) - 18.307) < 1e-3
    points = np.random.default_rng(1).standard_normal((500, 4))
    tree = KdTree(points, 16)
    assert sorted(np.concatenate(tree.leaves)) == list(range(500))
    at = points[7]
    bounds = [b for b, _ in tree.nearest_first(at)]
    assert bounds == sorted(bounds) and bounds[0] == 0
    for bound, rows_ in tree.nearest_first(at):
        assert (((points[rows_] - at) ** 2).sum(axis=1) >= bound - 1e-12).all()
