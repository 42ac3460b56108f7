"""Second-order boosting against a plain implementation, and what each parameter does to the trees."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from plumbline.operators import boosting, training
from plumbline.operators.boosting import Penalties, SecondOrderBoosting


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 9, n)], axis=1).astype(float)
    y = 3 * x[:, 0] * (x[:, 1] > 1) + x[:, 2] ** 2 + rng.normal(size=n)
    return x, y


@pytest.fixture(scope="module")
def frame(spark):
    x, y = data()
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def plain(x, y, trees, rate, rules, depth, leaves):
    """Predictions of boosting that looks at every split of every leaf again and again."""
    out = np.full(len(y), y.mean())

    def best(rows, g):
        found = (0.0, None)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) < max(rules.min_child_samples, rules.min_child_weight):
                    continue
                score = [max(abs(g[r].sum()) - rules.reg_alpha, 0) ** 2 / (len(r) + rules.reg_lambda) for r in (left, right, rows)]
                gain = 0.5 * (score[0] + score[1] - score[2]) - rules.gamma
                if gain > found[0] + 1e-9 * max(found[0], 1):
                    found = (gain, (left, right))
        return found

    for _ in range(trees):
        g = out - y
        open_leaves, done = [(0, np.arange(len(y)), best(np.arange(len(y)), g))], []
        while open_leaves:
            at = max(range(len(open_leaves)), key=lambda i: open_leaves[i][2][0])
            level, rows, (gain, split) = open_leaves.pop(at)
            if split is None or level == depth or (leaves and len(open_leaves) + len(done) + 2 > leaves):
                done.append(rows)
            else:
                open_leaves += [(level + 1, r, best(r, g)) for r in split]
        for rows in done:
            s = g[rows].sum()
            out[rows] += rate * -np.sign(s) * max(abs(s) - rules.reg_alpha, 0) / (len(rows) + rules.reg_lambda)
    return out


CASES = [
    {}, {"num_leaves": 4}, {"num_leaves": 6, "max_depth": -1}, {"gamma": 900.0}, {"min_child_weight": 90.0}, {"min_child_samples": 40},
    {"reg_lambda": 20.0}, {"reg_alpha": 200.0},
]


def test_trees_equal_a_plain_implementation_and_each_parameter_counts(frame):
    x, y = data()
    seen = []
    for case in CASES:
        settings = {"max_depth": 3, "reg_lambda": 1.0, "reg_alpha": 0.0, "gamma": 0.0, "min_child_weight": 1.0, "min_child_samples": 1, "num_leaves": 0} | case
        model = SecondOrderBoosting(n_estimators=2, learning_rate=0.5, **settings).fit(frame)
        rules = Penalties(*(settings[k] for k in ("reg_lambda", "reg_alpha", "gamma", "min_child_weight", "min_child_samples")))
        expected = plain(x, y, 2, 0.5, rules, settings["max_depth"], settings["num_leaves"])
        got = np.array([r.prediction for r in model.transform(frame).orderBy("id").collect()])
        assert got == pytest.approx(expected, rel=1e-9), case
        seen.append(got)
        if settings["num_leaves"]:
            assert all(t.numNodes == 2 * settings["num_leaves"] - 1 for t in model.trees[1:])
    assert len({tuple(np.round(s, 6)) for s in seen}) == len(CASES)


def test_rows_stored_on_the_way_change_nothing(frame, monkeypatch):
    settings = {"n_estimators": 3, "max_depth": 2, "subsample": 0.7, "colsample_bytree": 0.7, "seed": 5}
    one = SecondOrderBoosting(**settings).fit(frame)
    monkeypatch.setattr(boosting, "STORED_EVERY", 1)
    monkeypatch.setattr(boosting, "CELLS", 1)
    two = SecondOrderBoosting(**settings).fit(frame)
    same = [np.array([r.prediction for r in m.transform(frame).orderBy("id").collect()]) for m in (one, two)]
    assert same[0] == pytest.approx(same[1])
    # Two of three features and a part of the rows serve each tree.
    assert all(len({i for i, v in enumerate(t.featureImportances.toArray()) if v}) <= 2 for t in one.trees[1:])


def test_edges(spark):
    assemble = VectorAssembler(inputCols=["a"], outputCol="features", handleInvalid="keep")
    make = lambda rows: assemble.transform(spark.createDataFrame(rows, "a double, label double"))
    constant = make([(1.0, 5.0), (2.0, 5.0), (2.0, 5.0)])
    model = SecondOrderBoosting(n_estimators=2).fit(constant)
    assert [r.prediction for r in model.transform(constant).collect()] == [5.0] * 3 and model.totalNumNodes == 3
    missing = make([(None, 9.0), (float("nan"), 9.0), (1.0, 1.0), (2.0, 1.0)])
    model = SecondOrderBoosting(n_estimators=1, learning_rate=1.0, reg_lambda=0.0).fit(missing)
    assert sorted(r.prediction for r in model.transform(missing).collect()) == [1.0, 1.0, 9.0, 9.0]
    with pytest.raises(ValueError, match="no rows"):
        SecondOrderBoosting().fit(constant.limit(0))


def test_by_name_stored_and_searched(spark, frame, tmp_path):
    fitted = training.train("LightGBM", frame.drop("features"), ["a", "b", "c"], params={"n_estimators": 2, "num_leaves": 5})
    paths = training.save_models([fitted], str(tmp_path))
    again = training.load_model(paths["LightGBM"])
    columns = [[r.prediction for r in m.transform(frame.drop("features")).orderBy("id").collect()] for m in (fitted, again)]
    assert columns[0] == columns[1] and len(set(columns[0])) >= 5


def test_opening_order_waits_behind_small_gains():
    tree, splits = boosting.Tree(), {0: (5.0, 0, 0, ((0, 1), (0, 1)))}
    left, right = tree.open(0, 0, 0, 5.0, ((0, 1), (0, 1)))
    splits |= {left: (1.0, 0, 0, ()), right: (3.0, 0, 0, ())}
    below = tree.open(left, 0, 0, 1.0, ((0, 1), (0, 1)))
    splits[below[0]] = (9.0, 0, 0, ())
    assert boosting._opened(tree, splits, 0) == [0, right, left, below[0]]
    assert boosting._opened(tree, splits, 3) == [0, right]
