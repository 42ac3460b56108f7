"""Rank correlations of columns with gaps: one ranking for all pairs."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest

from plumbline.operators import ranks


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 3000
    base = rng.normal(size=n)
    data = pd.DataFrame({
        "full": base,
        "ties": np.round(base + rng.normal(size=n), 0),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, base * base),
        # One value fills more than half of the known rows.
        "hot": np.where(rng.random(n) < 0.2, np.nan, np.where(rng.random(n) < 0.6, 5.0, np.round(base, 2))),
        "flat": np.where(rng.random(n) < 0.5, np.nan, 1.0),
        "left": np.where(np.arange(n) % 2 == 0, base, np.nan),
        "right": np.where(np.arange(n) % 2 == 1, base, np.nan),
        "a.b": np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 5, n)),
        "none": np.full(n, np.nan),
    })
    return data


def expected(data, a, b):
    both = pd.DataFrame({"x": data[a], "y": data[b]}).dropna()
    x, y = both["x"].rank(), both["y"].rank()
    if len(both) < 2 or x.nunique() < 2 or y.nunique() < 2:
        return len(both), None
    return len(both), float(np.corrcoef(x, y)[0, 1])


def compare(found, data, pairs):
    cells = {(r["column_a"], r["column_b"]): (r["n"], r["r"]) for r in found.collect()}
    assert set(cells) == {p for a, b in pairs for p in ((a, b), (b, a))}
    for (a, b), (n, r) in cells.items():
        rows, value = expected(data, a, b)
        assert n == rows, (a, b)
        if value is None:
            assert r is None, (a, b)
        else:
            assert math.isclose(r, value, abs_tol=1e-9), (a, b)


@pytest.mark.parametrize("task_rows,broadcast_rows", [(ranks.TASK_ROWS, ranks.BROADCAST_ROWS), (200, 10)])
def test_gapped_pairs_equal_brute_force(spark, frame, task_rows, broadcast_rows):
    pairs = list(itertools.combinations_with_replacement(frame.columns, 2))
    df = spark.createDataFrame(frame)
    found = ranks._gapped_correlations(df, pairs, ["full", "ties"], task_rows, broadcast_rows)
    compare(found, frame, pairs)


def test_matrix_stores_four_tables_for_any_number_of_columns(spark, frame, monkeypatch):
    stored = []
    kept = ranks.materialize
    monkeypatch.setattr(ranks, "materialize", lambda df, **options: stored.append(1) or kept(df, **options))
    df = spark.createDataFrame(frame)
    found = ranks.correlation_matrix(df, frame.columns, "spearman")
    compare(found, frame, itertools.combinations_with_replacement(frame.columns, 2))
    assert len(stored) <= 4


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, y double")
    rows = ranks._gapped_correlations(df, [("x", "x"), ("x", "y")]).collect()
    assert sorted((r["column_a"], r["column_b"], r["n"], r["r"]) for r in rows) == [
        ("x", "x", 0, None), ("x", "y", 0, None), ("y", "x", 0, None)
    ]


def test_hot_values_do_not_reach_the_shuffled_join(spark, frame):
    df = spark.createDataFrame(frame)
    found = ranks._gapped_correlations(df, [("hot", "gaps")], (), ranks.TASK_ROWS, 10)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") >= 3 and "CartesianProduct" not in text
