"""Successive halving against the full search."""

import random

import pytest

from plumbline.functions.columns import small_table
from plumbline.operators import tuning


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    rows = [(i, x, rng.gauss(0, 1), 3 * x + rng.gauss(0, 0.1)) for i, x in ((i, rng.gauss(0, 1)) for i in range(3000))]
    return small_table(spark, rows, "id bigint, x double, noise double, label double").repartition(4).cache()


# Small penalties are better here at every share of the rows, so the order of the trials is known.
SPACE = {"alpha": ["log_uniform", 10.0, 1e6]}


def test_same_winner_as_the_full_search(spark, planted):
    full = tuning.tune(planted, "Ridge", ["x", "noise"], ["id"], trials=16, k=4, space=SPACE)
    half = tuning.halve(planted, "Ridge", ["x", "noise"], ["id"], trials=16, k=4, space=SPACE)
    assert half.trials == full.trials and half.best == full.best
    assert half.best_rmse == pytest.approx(full.best_rmse, rel=1e-9)
    assert [len(r) for r in half.rungs] == [16, 8, 4, 2, 1] and half.fractions == (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)
    assert half.share_read < 1 / 3
    table = half.table(spark).collect()
    assert len(table) == 31 and [r["trial"] for r in table if r["rung"] == 4 and r["kept"]] == [full.best]
    for rung in range(4):
        kept = {r["trial"] for r in table if r["rung"] == rung and r["kept"]}
        assert kept == {r["trial"] for r in table if r["rung"] == rung + 1}
        worst = max(r["cv_rmse"] for r in table if r["rung"] == rung and r["kept"])
        assert all(r["cv_rmse"] >= worst for r in table if r["rung"] == rung and not r["kept"])
    assert tuning.refit(planted, half, ["x", "noise"]).name == "Ridge"


def test_rungs_equal_a_search_on_the_subset(planted):
    from plumbline.operators.split import in_subset

    half = tuning.halve(planted, "Ridge", ["x"], ["id"], trials=4, k=3, space=SPACE)
    part = tuning.tune(planted.where(in_subset(["id"], 0.25)), "Ridge", ["x"], ["id"], trials=4, k=3, space=SPACE)
    assert [e for _, e, _ in half.rungs[0]] == pytest.approx(list(part.scores), rel=1e-9)


def test_trees_drop_the_bad_trials(planted):
    space = {"max_depth": ["categorical", [1, 6]], "n_estimators": ["categorical", [4]]}
    half = tuning.halve(planted, "RandomForest", ["x", "noise"], ["id"], trials=4, k=2, seed=3, space=space)
    assert {p["max_depth"] for p in half.trials} == {1, 6}
    assert half.best_params["max_depth"] == 6 and [len(r) for r in half.rungs] == [4, 2, 1]


def test_ties_single_trials_and_bad_shares(planted):
    same = tuning.halve(planted, "Ridge", ["x"], ["id"], trials=4, k=2, space={"alpha": ["uniform", 1.0, 1.0]})
    assert same.best == 0 and [[t for t, _, _ in r] for r in same.rungs] == [[0, 1, 2, 3], [0, 1], [0]]
    one = tuning.halve(planted, "Ridge", ["x"], ["id"], trials=1, k=2, space=SPACE)
    assert one.fractions == (1.0,) and one.best == 0 and one.share_read == 1.0
    late = tuning.halve(planted, "Ridge", ["x"], ["id"], trials=4, k=2, space=SPACE, start=0.3)
    assert late.fractions == (0.3, 0.5, 1.0)
    for bad in ({"trials": 0}, {"start": 0.0}, {"start": 1.5}):
        with pytest.raises(ValueError):
            tuning.halve(planted, "Ridge", ["x"], ["id"], k=2, space=SPACE, **bad)
