"""Top-k over the pivot index against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import pivots

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, asks):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in kept:
        if asks(q):
            found = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in kept if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({"block": F.lit("x"), "score": F.lit("y"), "ids": F.lit(0)}).repartition(4)


def found(spark, rows, k=5, every=7):
    got = pivots.search(table(spark, rows), F.pmod("vec_id", F.lit(every)) == 0, k)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())


def vectors(n, width, seed, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, width))
    return [(k * 3, (centres[k % clusters] + 0.2 * rng.normal(size=width)).tolist()) for k in range(n)]


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK_VECTORS", 16)
    monkeypatch.setattr(pivots, "BATCH_QUERIES", 8)
    rows = vectors(600, 8, 1)
    rows += [(10_000 + k, rows[6][1]) for k in range(120)]  # a hot vector: ties go to smaller ids
    rows += [(None, rows[0][1]), (20_000, None), (20_006, [1.0, None]), (20_013, [float("nan")] * 8), (20_020, [float("inf")] + [0.0] * 7)]
    rows += [(30_002, [0.0] * 8), (30_009, []), (30_016, [5.0, -2.0])]
    assert found(spark, rows) == brute(rows, 5, lambda q: q % 7 == 0)


def test_bounds_leave_out_annuli(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK_VECTORS", 16)
    # on a sphere far neighbours score low, so the radius is small
    rng = np.random.default_rng(3)
    angles = np.sort(rng.uniform(0, 2 * np.pi, 800))
    rows = [(k, [20 * math.cos(a), 20 * math.sin(a)]) for k, a in enumerate(angles)]
    visited = []
    visit = pivots._visit

    def counted(index, batches, pairs, k, bounds):
        visited.append((pairs.count(), batches.count() * index.blocks.count()))
        return visit(index, batches, pairs, k, bounds)

    monkeypatch.setattr(pivots, "_visit", counted)
    assert found(spark, rows, 3, 50) == brute(rows, 3, lambda q: q % 50 == 0)
    assert visited[1][0] < visited[1][1] or visited[0][0] < visited[0][1]


def test_few_and_no_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (7, [0.1, 0.1])]
    assert found(spark, rows) == brute(rows, 5, lambda q: q % 7 == 0)
    assert found(spark, [(0, [1.0])]) == [] and found(spark, []) == [] and found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_large_components_stay_whole_numbers(spark):
    rows = [(k, [1e6 * (k + 1), -3e5 * k]) for k in range(9)]
    assert found(spark, rows, 2) == brute(rows, 2, lambda q: q % 7 == 0)


@pytest.mark.parametrize("k", [1, 3])
def test_best_takes_ties_by_id(k):
    ids = np.array([9, 4, 7, 1, 8, 2, 6, 3, 5, 0, 11, 12, 13])
    scores = np.array([5, 5, 9, 5, 1, 1, 1, 1, 1, 1, 1, 1, 1])
    assert ids[pivots._best(scores, ids, k)].tolist() == [7, 1, 4][:k]
