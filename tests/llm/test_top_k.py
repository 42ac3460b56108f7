"""Exact search against brute force."""

from __future__ import annotations

import math

import numpy as np

from plumbline.llm import top_k


def brute(vectors, queries, k=5):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)]
    asked = [(i, [math.floor(256 * x) for x in v]) for i, v in queries if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    result = []
    for q, a in asked:
        best = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in whole if i != q)[:k]
        result += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(result)


def found(spark, vectors, queries, **options):
    schema = "vec_id long, embedding array<double>, score int, rank string"
    a, b = (spark.createDataFrame([(*r, 1, "x") for r in rows], schema) for rows in (vectors, queries))
    return sorted(map(tuple, top_k.search(a.repartition(3), b, **options).collect()))


def test_ties_blocks_and_cells(spark):
    rng = np.random.default_rng(4)
    vectors = [(int(i), [float(x) for x in rng.integers(-3, 4, 6) / 256]) for i in rng.permutation(400)]
    queries = [v for v in vectors if v[0] % 10 == 0]
    assert found(spark, vectors, queries, shard_rows=60, query_rows=15, block_rows=8) == brute(vectors, queries)


def test_pruning_skips_blocks():
    rng = np.random.default_rng(1)
    vectors = np.sort(rng.integers(0, 200, (2000, 1)), axis=0) + rng.integers(0, 3, (2000, 8)).astype(float)
    blocks = top_k.Blocks(np.arange(2000), vectors, rows=50)
    _, _, _, scored = blocks.best(np.arange(20), vectors[:20], 5)
    assert scored < 20 * 40 / 4


def test_unusable_vectors_and_edges(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [inf, 0.0]), (5, [nan, 1.0]), (6, [-1.0, 0.001]), (7, [0.5]),
               (8, []), (None, [1.0, 1.0]), (9, [1e12, -1e12]), (10, [1e15, 1e15]), (11, [1e15, 1e15])]
    queries = [v for v in vectors if v[0] in (1, 2, 4, 6, 9, 10, 11)]
    assert found(spark, vectors, queries, k=20) == brute(vectors, queries, k=20)
    twice = [(1, [1.0]), (1, [1.0]), (2, [1.0]), (2, [3.0]), (3, [2.0])]
    assert found(spark, twice, [(1, [1.0])]) == [(1, 1, 2, 196608), (1, 2, 3, 131072), (1, 3, 1, 65536), (1, 4, 2, 65536)]
    # Only the query's own row is left out: another vector of its id, and a copy of it, are candidates.
    same = [(50, [1.0]), (50, [2.0]), (7, [3.0]), (7, [3.0])]
    assert found(spark, same, [(50, [1.0])]) == [(50, 1, 7, 196608), (50, 2, 7, 196608), (50, 3, 50, 131072)]
    assert found(spark, same, [(7, [3.0])]) == [(7, 1, 7, 589824), (7, 2, 50, 393216), (7, 3, 50, 196608)]
    assert found(spark, [(1, [1.0])], [(1, [1.0])]) == [] and found(spark, [], [(1, [1.0])]) == [] and found(spark, twice, []) == []
