"""Exact selection and ranks against brute force, with limits small enough to take every path."""

import itertools
import math
import random

import numpy as np
import pytest

from plumbline.functions.columns import small_table
from plumbline.operators import quantiles as q
from plumbline.operators import ranks


def frame(spark, values, schema="x double"):
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    return small_table(spark, rows, schema).repartition(4)


def skewed(n, seed):
    """A third of the rows hold one value."""
    rng = random.Random(seed)
    return [7.0 if rng.random() < 1 / 3 else round(rng.gauss(0, 50), 2) for _ in range(n)]


@pytest.mark.parametrize("task_rows", [20, 300, 10**6])
def test_order_statistics(spark, task_rows):
    values = skewed(4000, 1)
    wanted = [0, 1, 999, 1000, 2000, 2100, 3998, 3999]
    found = q.order_statistics(frame(spark, values), {"x": wanted}, task_rows=task_rows, sketch_size=64)
    ordered = sorted(values)
    assert found == {("x", r): ordered[r] for r in wanted}


def test_order_statistics_with_infinite_and_two_values(spark):
    values = [math.inf, -math.inf] + [1.0] * 500 + [2.0] * 500
    found = q.order_statistics(frame(spark, values), {"x": [0, 1, 500, 501, 1001]}, task_rows=10, sketch_size=16)
    assert [found["x", r] for r in (0, 1, 500, 501, 1001)] == [-math.inf, 1.0, 1.0, 2.0, math.inf]


def test_order_statistics_rejects_ranks_outside(spark):
    with pytest.raises(ValueError):
        q.order_statistics(frame(spark, [1.0, 2.0]), {"x": [2]})


@pytest.mark.parametrize("task_rows", [50, 10**6])
def test_quantiles_match_numpy(spark, task_rows):
    values = skewed(3001, 2)
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = q.quantiles(frame(spark, values), ["x"], ps, task_rows=task_rows)["x"]
    assert found == pytest.approx(list(np.quantile(values, ps)))


@pytest.mark.parametrize("values, schema", [
    ([3.5] * 40, "x double"),
    ([1.0, 2.0, 2.0, 2.0, 9.0] * 30, "x double"),
    ([-math.inf, *map(float, range(7))], "x double"),
    ([math.inf, math.inf, -math.inf, 0.0, 1.5, math.nan, None], "x double"),
    ([0.1 * i for i in range(500)], "x double"),
    ([2**60 + i for i in range(300)], "x bigint"),
])
def test_one_path_whatever_the_size(spark, values, schema):
    ps = [0.0, 0.1, 0.25, 0.4, 0.5, 0.9, 1.0]
    df = frame(spark, values, schema)
    small = q.quantiles(df, ["x"], ps, task_rows=1)["x"]
    assert str(small) == str(q.quantiles(df, ["x"], ps)["x"])
    if schema == "x bigint":
        found = q.order_statistics(df, {"x": [0, 17, 299]}, task_rows=1)
        assert [found["x", r] for r in (0, 17, 299)] == [2**60, 2**60 + 17, 2**60 + 299]


def test_quantiles_skip_missing(spark):
    df = frame(spark, [1.0, 3.0, math.nan, None])
    assert q.quantiles(df, ["x"], [0.5])["x"] == [2.0]
    assert q.quantiles(df.where("x < 0"), ["x"], [0.5])["x"] == [None]
    assert q.quantiles(df, ["x"], [0.5], exact=False)["x"][0] in (1.0, 3.0)


def brute_average_ranks(values):
    ordered = sorted(values)
    first = {}
    for i, v in enumerate(ordered):
        first.setdefault(v, i)
    return {v: first[v] + (ordered.count(v) + 1) / 2 for v in set(values)}


@pytest.mark.parametrize("task_rows", [37, 10**6])
def test_rank_values(spark, task_rows):
    values = skewed(1500, 3)
    ranking = ranks.rank_values(frame(spark, values), ["x"], task_rows=task_rows)
    rows = ranking.of("x").select("value", ranks.average_rank().alias("r"), "position").collect()
    assert {r["value"]: r["r"] for r in rows} == brute_average_ranks(values)
    assert [r["position"] for r in sorted(rows, key=lambda r: r["value"])] == list(range(len(set(values))))


def brute_spearman(pairs):
    rx, ry = brute_average_ranks([p[0] for p in pairs]), brute_average_ranks([p[1] for p in pairs])
    return np.corrcoef([rx[p[0]] for p in pairs], [ry[p[1]] for p in pairs])[0, 1]


@pytest.mark.parametrize("limits", [(10**6, 10**6), (50, 10)])
def test_spearman_with_hot_value(spark, limits):
    xs, ys = skewed(1200, 4), skewed(1200, 5)
    pairs = [(x, y + 0.5 * x) for x, y in zip(xs, ys)]
    df = frame(spark, pairs + [(None, 1.0), (2.0, math.nan)], "x double, y double")
    row = ranks.spearman(df, "x", "y", *limits).first()
    assert row["n"] == 1200
    assert row["r"] == pytest.approx(brute_spearman(pairs))


def brute_kendall(pairs):
    c = d = tx = ty = 0
    for (a, b), (e, f) in itertools.combinations(pairs, 2):
        tx += a == e
        ty += b == f
        c += (a - e) * (b - f) > 0
        d += (a - e) * (b - f) < 0
    n = len(pairs) * (len(pairs) - 1) / 2
    return c, d, tx, ty, (c - d) / math.sqrt((n - tx) * (n - ty))


@pytest.mark.parametrize("limits", [(10**6, 10**6), (30, 10)])
def test_kendall(spark, limits):
    rng = random.Random(6)
    pairs = [(float(rng.randint(0, 60)), float(rng.randint(0, 25)) if rng.random() > 0.3 else 3.0) for _ in range(400)]
    row = ranks.kendall(frame(spark, pairs, "x double, y double"), "x", "y", *limits).first()
    c, d, tx, ty, tau = brute_kendall(pairs)
    assert (row["concordant"], row["discordant"], row["ties_x"], row["ties_y"]) == (c, d, tx, ty)
    assert row["tau"] == pytest.approx(tau)


def test_kendall_crosses_slices(spark, monkeypatch):
    rng = random.Random(8)
    pairs = [(float(x), float(rng.randint(0, 9999))) for x in range(700)]
    monkeypatch.setattr(ranks, "SLICE_ROWS", 16)
    row = ranks.kendall(frame(spark, pairs, "x double, y double"), "x", "y").first()
    c, d, tx, ty, tau = brute_kendall(pairs)
    assert (row["concordant"], row["discordant"]) == (c, d)


def test_degenerate_correlations(spark):
    df = frame(spark, [(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert ranks.kendall(df, "x", "y").first()["tau"] is None
    assert ranks.spearman(df, "x", "y").first()["r"] is None
    matrix = ranks.correlation_matrix(df.where("x > 5"), ["x", "y"]).collect()
    assert len(matrix) == 4 and all(r["n"] == 0 for r in matrix)


def test_pearson_is_pairwise(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 1.0), (3.0, 5.0, None), (4.0, 9.0, 2.0)]
    df = frame(spark, rows, "a double, b double, c double")
    found = {(r["column_a"], r["column_b"]): (r["n"], r["r"]) for r in ranks.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert found["a", "b"][0] == 3 and found["b", "c"][0] == 2
    assert found["a", "b"][1] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 9])[0, 1])
