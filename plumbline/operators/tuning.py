"""Cross-validation, random search and successive halving."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted, small_table, union_all
from plumbline.operators import crossproducts
from plumbline.operators.evaluation import regression_metrics
from plumbline.operators.split import hash_folds, learning_subsets
from plumbline.operators.training import (
    BASELINES,
    FEATURES,
    Trained,
    assembled,
    assembler,
    make_estimator,
    spark_params,
    train,
)
from plumbline.session import materialize, shared_dir

# The search space of each model, without the parameters that Spark's trees do not have.
SEARCH_SPACES: dict[str, dict[str, list]] = {
    "Ridge": {"alpha": ["log_uniform", 0.001, 3], "max_iter": ["int", 500, 3000]},
    "RandomForest": {
        "n_estimators": ["int", 50, 500], "max_depth": ["int", 3, 30], "min_samples_leaf": ["int", 1, 10], "max_features": ["categorical", ["sqrt", "log2"]],
    },
    "XGBoost": {
        "n_estimators": ["int", 50, 500], "max_depth": ["int", 3, 15], "learning_rate": ["log_uniform", 0.001, 0.3],
        "subsample": ["uniform", 0.6, 1.0], "colsample_bytree": ["uniform", 0.6, 1.0], "gamma": ["uniform", 0, 5],
        "min_child_weight": ["int", 1, 10],
    },
    "LightGBM": {
        "n_estimators": ["int", 50, 500], "max_depth": ["int", 3, 15], "learning_rate": ["log_uniform", 0.001, 0.3],
        "min_child_samples": ["int", 5, 100], "subsample": ["uniform", 0.6, 1.0],
        "colsample_bytree": ["uniform", 0.6, 1.0],
    },
}


def draw(space: dict[str, list], rng: random.Random) -> dict[str, Any]:
    """One point of a search space."""
    point: dict[str, Any] = {}
    for name, (kind, *limits) in space.items():
        if kind == "int":
            point[name] = rng.randint(limits[0], limits[1])
        elif kind in ("float", "uniform"):
            point[name] = rng.uniform(limits[0], limits[1])
        elif kind == "log_uniform":
            point[name] = math.exp(rng.uniform(math.log(limits[0]), math.log(limits[1])))
        elif kind == "categorical":
            point[name] = rng.choice(limits[0])
        else:
            raise ValueError(f"unknown kind of parameter {kind!r}")
    return point


def draws(space: dict[str, list], trials: int, seed: int = 42) -> list[dict[str, Any]]:
    rng = random.Random(seed)
    return [draw(space, rng) for _ in range(trials)]


def cross_validated_predictions(
    df: DataFrame, estimator: Estimator, k: int = 10, fold: str = "fold"
) -> DataFrame:
    """Every row with the prediction of the model that has not seen its fold."""
    return union_all([
        estimator.fit(df.where(F.col(fold) != i)).transform(df.where(F.col(fold) == i)) for i in range(k)
    ])


def fold_metrics(predictions: DataFrame, fold: str = "fold", label: str = "label") -> DataFrame:
    """Errors per fold from one grouped aggregate."""
    return regression_metrics(predictions, label=label, by=[fold])


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold errors."""
    return folds.agg(
        F.count(F.lit(1)).alias("folds"), F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse")
    )


def _from_products(model: str, features: Sequence[str]) -> bool:
    """Whether folds are fitted from cross-products (``crossproducts``) and not one after another."""
    return model == "Ridge" and 0 < len(features) <= crossproducts.PRODUCT_FEATURES


def cross_validate(
    df: DataFrame,
    model: str,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    params: dict[str, Any] | None = None,
    k: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Errors per fold of one model.

    Ridge regression takes two scans for any number of folds: one for the models of all folds, one for the errors.
    """
    names = ["fold", "n", "mse", "rmse", "mae", "mape", "r2"]
    doubles = ", ".join(f"{n} double" for n in names[2:])
    if _from_products(model, features):
        chosen = (BASELINES[model] if params is None else params).get("alpha", 1.0)
        folds = hash_folds(df, keys, k, seed)
        models = crossproducts.fold_models(crossproducts.gather(folds, features, label, ["fold"]), k, chosen)
        scored = folds.select("fold", quoted(label).alias(label), crossproducts.by_fold(models, features).alias("prediction"))
        rows = [tuple(r[n] for n in names) for r in fold_metrics(scored, label=label).collect()]
        return small_table(df.sparkSession, rows, f"fold int, n bigint, {doubles}")
    shared_dir(df.sparkSession)
    frame = assembled(hash_folds(df, keys, k, seed), features, [label, "fold"]).persist()
    try:
        folds = fold_metrics(
            cross_validated_predictions(frame, make_estimator(model, params, label, seed), k), label=label
        )
        rows = [tuple(r[n] for n in names) for r in folds.collect()]
    finally:
        frame.unpersist()
    return small_table(df.sparkSession, rows, f"fold int, n bigint, {doubles}")


@dataclass(frozen=True)
class Study:
    """The outcome of a search."""

    model: str
    trials: tuple[dict[str, Any], ...]
    scores: tuple[float, ...]
    deviations: tuple[float, ...]
    seconds: float

    @property
    def best(self) -> int:
        return min(range(len(self.scores)), key=lambda i: (self.scores[i], i))

    @property
    def best_params(self) -> dict[str, Any]:
        return self.trials[self.best]

    @property
    def best_rmse(self) -> float:
        return self.scores[self.best]

    def table(self, spark) -> DataFrame:
        rows = [
            (self.model, i, json.dumps(p, sort_keys=True), self.scores[i], self.deviations[i])
            for i, p in enumerate(self.trials)
        ]
        return small_table(
            spark, rows, "model string, trial bigint, params string, cv_rmse double, cv_std double"
        )


def tune(
    df: DataFrame,
    model: str,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    trials: int = 50,
    k: int = 10,
    seed: int = 42,
    parallelism: int = 4,
    space: dict[str, list] | None = None,
) -> Study:
    """Random search scored by the mean of the fold errors.

    Ridge regression takes one scan for all folds and trials. For other models Spark's
    CrossValidator runs ``parallelism`` fits at a time on the same hash folds for every trial.
    """
    points = draws(space or SEARCH_SPACES[model], trials, seed)
    if _from_products(model, features):
        for p in points:
            spark_params(model, p)
        start = time.monotonic()
        parts = crossproducts.gather(hash_folds(df, keys, k, seed), features, label, ["fold"])
        errors = [crossproducts.fold_errors(parts, k, p.get("alpha", 1.0)) for p in points]
        means, deviations = ([float(f(e)) for e in errors] for f in (np.mean, np.std))
        return Study(model, tuple(points), tuple(means), tuple(deviations), time.monotonic() - start)
    shared_dir(df.sparkSession)
    estimator = make_estimator(model, {}, label, seed)
    maps = [
        {estimator.getParam(n): v for n, v in spark_params(model, p).items()} for p in points
    ]
    frame = assembled(hash_folds(df, keys, k, seed), features, [label, "fold"]).persist()
    start = time.monotonic()
    try:
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=maps,
            evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
            numFolds=k,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(frame)
    finally:
        frame.unpersist()
    return Study(
        model, tuple(points), tuple(search.avgMetrics), tuple(search.stdMetrics), time.monotonic() - start
    )


@dataclass(frozen=True)
class Halving:
    """The outcome of successive halving: (trial, error, deviation) of every rung's trials, and the rows read by all fits."""

    model: str
    trials: tuple[dict[str, Any], ...]
    fractions: tuple[float, ...]
    rungs: tuple[tuple[tuple[int, float, float], ...], ...]
    seconds: float

    @property
    def best(self) -> int:
        return _better(self.rungs[-1])[0]

    @property
    def best_params(self) -> dict[str, Any]:
        return self.trials[self.best]

    @property
    def best_rmse(self) -> float:
        return next(error for trial, error, _ in self.rungs[-1] if trial == self.best)

    @property
    def share_read(self) -> float:
        """Rows that all rungs fitted on, as a share of what a full search fits on."""
        return sum(f * len(rung) for f, rung in zip(self.fractions, self.rungs)) / len(self.trials)

    def table(self, spark) -> DataFrame:
        rows = []
        for i, rung in enumerate(self.rungs):
            kept = {self.best} if i + 1 == len(self.rungs) else {t for t, _, _ in self.rungs[i + 1]}
            rows += [
                (self.model, i, self.fractions[i], t, json.dumps(self.trials[t], sort_keys=True), error, deviation, t in kept)
                for t, error, deviation in rung
            ]
        return small_table(
            spark, rows, "model string, rung int, fraction double, trial bigint, params string, cv_rmse double, cv_std double, kept boolean"
        )


def _better(rung: Sequence[tuple[int, float, float]]) -> list[int]:
    """Trials of a rung by rising error; ties go to the earlier trial and failed fits come last."""
    return [t for t, error, _ in sorted(rung, key=lambda r: (math.isnan(r[1]), r[1], r[0]))]


def halve(
    df: DataFrame,
    model: str,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    trials: int = 16,
    k: int = 10,
    seed: int = 42,
    parallelism: int = 4,
    space: dict[str, list] | None = None,
    start: float | None = None,
) -> Halving:
    """Random search by successive halving: every trial on a small share of the rows, the better half on twice as many.

    The shares are nested hash subsets, so a rung adds rows and drops none, and the last rung has all rows.
    ``start`` is the first share, by default that at which each rung fits on as many rows: 16 trials take five rungs and
    5/16 of the rows of a full search. Ridge regression takes one scan for all rungs; other models read, per rung, only its subset.
    """
    if trials < 1:
        raise ValueError("no trials")
    if start is not None and not 0 < start <= 1:
        raise ValueError("the first share must lie above 0 and not above 1")
    steps = (trials - 1).bit_length() if start is None else max(0, math.ceil(math.log2(1 / start) - 1e-9))
    fractions = [2.0 ** (i - steps) for i in range(steps + 1)]
    if start is not None:
        fractions[0] = float(start)
    points = draws(space or SEARCH_SPACES[model], trials, seed)
    frame = learning_subsets(df, keys, k, fractions, seed)
    began = time.monotonic()
    if _from_products(model, features):
        for p in points:
            spark_params(model, p)
        score = _rungs_from_products(frame, features, label, points, k)
    else:
        shared_dir(df.sparkSession)
        # Written once and cut by step, so each rung reads only its own rows of it.
        stored = materialize(assembled(frame, features, [label, "fold", "step"]), partition_by="step")
        score = _rungs_by_validator(stored, model, label, points, k, seed, parallelism)
    alive, rungs = list(range(trials)), []
    for i in range(len(fractions)):
        rungs.append(tuple(score(i, alive)))
        alive = sorted(_better(rungs[-1])[: max(1, (len(alive) + 1) // 2)])
    return Halving(model, tuple(points), tuple(fractions), tuple(rungs), time.monotonic() - began)


def _rungs_from_products(frame: DataFrame, features: Sequence[str], label: str, points: Sequence[dict], k: int):
    parts = crossproducts.gather(frame, features, label, ["fold", "step"])

    def score(rung: int, alive: Sequence[int]) -> list[tuple[int, float, float]]:
        folds = {
            (i,): crossproducts.union((m for (fold, step), m in parts.items() if fold == i and step <= rung), len(features))
            for i in range(k)
        }
        folds = {key: m for key, m in folds.items() if m.n}
        errors = {t: crossproducts.fold_errors(folds, k, points[t].get("alpha", 1.0)) for t in alive}
        return [(t, float(np.mean(e)), float(np.std(e))) for t, e in errors.items()]

    return score


def _rungs_by_validator(
    stored: DataFrame, model: str, label: str, points: Sequence[dict], k: int, seed: int, parallelism: int
):
    estimator = make_estimator(model, {}, label, seed)

    def score(rung: int, alive: Sequence[int]) -> list[tuple[int, float, float]]:
        maps = [{estimator.getParam(n): v for n, v in spark_params(model, points[t]).items()} for t in alive]
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=maps,
            evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
            numFolds=k,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(stored.where(F.col("step") <= rung))
        return list(zip(alive, search.avgMetrics, search.stdMetrics))

    return score


def refit(df: DataFrame, study: Study | Halving, features: Sequence[str], label: str = "label", seed: int = 42) -> Trained:
    """Fit the best parameters on all rows."""
    return train(study.model, df, features, label, study.best_params, seed)


def choose_best(results: DataFrame, metric: str = "cv_rmse") -> DataFrame:
    """The row with the lowest error, ties by model name."""
    return results.orderBy(F.asc_nulls_last(metric), "model").limit(1)


def tune_and_choose(
    df: DataFrame,
    models: Sequence[str],
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    trials: int = 50,
    k: int = 10,
    seed: int = 42,
    metric: str = "cv_rmse",
    spaces: dict[str, dict[str, list]] | None = None,
) -> tuple[Trained, DataFrame]:
    """Tune and refit several models and choose one.

    ``metric`` is ``cv_rmse`` (on held-out folds) or ``train_rmse`` (on the
    training rows themselves).
    """
    spaces = spaces or SEARCH_SPACES
    studies = [tune(df, m, features, keys, label, trials, k, seed, space=spaces[m]) for m in models]
    fitted = [refit(df, s, features, label, seed) for s in studies]
    rows = []
    for s, t in zip(studies, fitted):
        errors = regression_metrics(t.transform(df), label).first()
        rows.append((s.model, json.dumps(s.best_params, sort_keys=True), s.best_rmse, errors["rmse"], s.seconds))
    results = small_table(
        df.sparkSession, rows, "model string, params string, cv_rmse double, train_rmse double, tuning_seconds double"
    )
    winner = choose_best(results, metric).first()["model"]
    return next(t for t in fitted if t.name == winner), results


def trial_history(trials: DataFrame) -> DataFrame:
    """Trials with the best error so far. One row per trial, so one small window."""
    so_far = Window.partitionBy("model").orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.withColumn("best_so_far", F.min("cv_rmse").over(so_far))


def trial_slices(trials: DataFrame) -> DataFrame:
    """(model, trial, parameter, value, cv_rmse): the error along each parameter."""
    pairs = F.from_json("params", "map<string,string>")
    return trials.select("model", "trial", F.explode(pairs).alias("parameter", "value"), "cv_rmse")


def parameter_importance(trials: DataFrame, seed: int = 42) -> DataFrame:
    """Share of each parameter in a forest that predicts the error of a trial.

    Works on the trials of one model; words are numbered in sorted order.
    """
    slices = trial_slices(trials)
    names = [r["parameter"] for r in slices.select("parameter").distinct().orderBy("parameter").collect()]
    coded = slices.withColumn(
        "code",
        F.coalesce(
            F.expr("try_cast(value AS double)"),
            F.dense_rank().over(Window.partitionBy("parameter").orderBy("value")).cast("double"),
        ),
    )
    wide = coded.groupBy("trial", "cv_rmse").pivot("parameter", names).agg(F.first("code"))
    plain = [f"__f{i}" for i in range(len(names))]
    wide = wide.toDF("trial", "cv_rmse", *plain)
    forest = RandomForestRegressor(
        featuresCol=FEATURES, labelCol="cv_rmse", numTrees=20, seed=seed, featureSubsetStrategy="all"
    ).fit(assembler(plain).transform(wide))
    weights = forest.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return small_table(trials.sparkSession, rows, "parameter string, importance double")
