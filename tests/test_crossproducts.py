"""Ridge fits from cross-products against fits of the rows themselves, and the scans that they take."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import crossproducts, evaluation, training, tuning
from plumbline.operators.split import hash_folds, learning_subsets


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) * [1, 100, 0.01] + [0, 1e6, 5]
    y = 2 * x[:, 0] - 0.01 * x[:, 1] + 30 * x[:, 2] + rng.normal(size=300)
    rows = [(i, *map(float, a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, `a.b` double, b double, c double, label double").repartition(4)


NAMES = ["a.b", "b", "c"]


def arrays(df):
    rows = df.collect()
    return np.array([[r[c] for c in NAMES] for r in rows]), np.array([r.label for r in rows]), rows


def plain(x, y, alpha):
    centre = x.mean(0)
    w = np.linalg.solve((x - centre).T @ (x - centre) + alpha * np.eye(x.shape[1]), (x - centre).T @ (y - y.mean()))
    return w, y.mean() - w @ centre


def test_merged_moments_equal_those_of_all_rows(frame):
    x, y, _ = arrays(frame)
    parts = crossproducts.gather(frame.withColumn("p", F.col("id") % 7), NAMES, "label", ["p"])
    whole = crossproducts.union(parts.values(), 3)
    both = np.column_stack([x, y])
    assert whole.n == 300 and whole.mean == pytest.approx(both.mean(0)) and whole.products == pytest.approx((both - both.mean(0)).T @ (both - both.mean(0)), rel=1e-6, abs=1e-6)
    for alpha in (0.0, 0.3, 50.0):
        w, b = plain(x, y, alpha)
        got = whole.ridge(alpha)
        assert got[0] == pytest.approx(w, rel=1e-6) and got[1] == pytest.approx(b, rel=1e-6)
        assert whole.mse(*got) == pytest.approx(((y - x @ w - b) ** 2).mean(), rel=1e-6)


def test_folds_trials_and_curves(spark, frame):
    x, y, rows = arrays(hash_folds(frame, ["id"], 4))
    folds = np.array([r.fold for r in rows])
    errors = {}
    for i in range(4):
        w, b = plain(x[folds != i], y[folds != i], 0.3)
        gap = y[folds == i] - x[folds == i] @ w - b
        errors[i] = (len(gap), (gap**2).mean(), np.abs(gap).mean())
    got = {r.fold: (r.n, r.mse, r.mae) for r in tuning.cross_validate(frame, "Ridge", NAMES, ["id"], k=4).collect()}
    assert all(got[i] == pytest.approx(errors[i], rel=1e-6) for i in range(4)) and len(got) == 4
    study = tuning.tune(frame, "Ridge", NAMES, ["id"], trials=1, k=4, space={"alpha": ["categorical", [0.3]]})
    roots = [errors[i][1] ** 0.5 for i in range(4)]
    assert (study.scores[0], study.deviations[0]) == pytest.approx((np.mean(roots), np.std(roots)), rel=1e-6)
    slow = evaluation.learning_curve(
        frame.withColumnRenamed("a.b", "a"), training.Pipeline(stages=[training.assembler(["a", "b", "c"]), training.make_estimator("Ridge")]), ["id"], k=3).orderBy("step").collect()
    fast = crossproducts.learning_curve(frame, NAMES, ["id"], alpha=0.3, k=3).orderBy("step").collect()
    assert [tuple(r) for r in fast] == [pytest.approx(tuple(r), rel=1e-6) for r in slow]


def jobs(spark, call):
    spark.sparkContext.setJobGroup(group := f"jobs{np.random.default_rng().integers(1 << 60)}", "")
    try:
        call()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_scans_do_not_grow_with_folds_trials_or_steps(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    one = jobs(spark, lambda: crossproducts.gather(hash_folds(df, ["id"], 3), NAMES, "label", ["fold"]))
    space = {"alpha": ["log_uniform", 0.1, 10.0]}
    assert jobs(spark, lambda: tuning.tune(df, "Ridge", NAMES, ["id"], trials=20, k=10, space=space)) <= one
    assert jobs(spark, lambda: crossproducts.learning_curve(df, NAMES, ["id"], k=5)) <= one
    assert jobs(spark, lambda: tuning.cross_validate(df, "Ridge", NAMES, ["id"], k=10)) <= 2 * one
    plan = learning_subsets(df, ["id"], 3, (0.5, 1.0), 1).groupBy("fold", "step").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_edges(spark, frame):
    with pytest.raises(ValueError, match="missing"):
        crossproducts.gather(frame.withColumn("b", F.when(F.col("id") > 3, F.col("b"))), NAMES, "label")
    with pytest.raises(ValueError, match="fold"):
        tuning.tune(frame.limit(2), "Ridge", NAMES, ["id"], trials=1, k=10)
    with pytest.raises(ValueError, match="no rows"):
        tuning.cross_validate(frame.limit(0), "Ridge", NAMES, ["id"], k=3)
    same = frame.withColumn("b", F.lit(1.0)).withColumn("label", F.lit(4.0))
    w, b = crossproducts.gather(same, NAMES, "label")[()].ridge(0.0)
    assert w == pytest.approx([0, 0, 0]) and b == pytest.approx(4.0)
