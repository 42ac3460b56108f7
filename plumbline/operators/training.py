"""Regressors by name, baselines, ranking and storage of models."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted, require_columns, small_table
from plumbline.operators.boosting import SecondOrderBoosting
from plumbline.operators.evaluation import regression_metrics
from plumbline.session import shared_dir

FEATURES = "features"


# Most features of Spark's normal equations; beyond them the same loss is minimised step by step.
NORMAL_FEATURES = 4096


class Ridge(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Least squares with penalty ``alpha`` times the squared coefficients.

    Spark's penalty is relative to the number of rows and to the deviation of
    the label, so both are taken from the frame that is fitted: one small
    aggregate, then the normal equations in one pass.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty of the squared coefficients", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations, for iterative solvers", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", alpha=1.0, maxIter=2000):
        super().__init__()
        self._setDefault(alpha=1.0, maxIter=2000)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        label = self.getLabelCol()
        row = dataset.agg(F.count(quoted(label)), F.stddev_pop(quoted(label))).first()
        if not row[0]:
            raise ValueError("no rows to fit")
        vector = dataset.select(self.getFeaturesCol()).first()[0]
        width = vector.size
        return LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol=label,
            predictionCol=self.getPredictionCol(),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal" if width <= NORMAL_FEATURES else "l-bfgs",
            maxIter=self.getOrDefault(self.maxIter),
            regParam=self.getOrDefault(self.alpha) * row[1] / row[0],
        ).fit(dataset)


# Parameters of the four baseline models.
BASELINES: dict[str, dict[str, Any]] = {
    "Ridge": {"alpha": 0.3, "max_iter": 2000},
    "XGBoost": {
        "n_estimators": 200, "max_depth": 6, "learning_rate": 0.04, "subsample": 0.6, "colsample_bytree": 0.8,
    },
    "LightGBM": {
        "n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8, "num_leaves": 31,
    },
    "RandomForest": {"n_estimators": 120, "max_depth": 7, "min_samples_split": 4, "min_samples_leaf": 3},
}

# Names of the parameters in Spark.
_SPARK_NAMES = {
    "Ridge": {"alpha": "alpha", "max_iter": "maxIter"},
    "RandomForest": {
        "n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode",
        "max_features": "featureSubsetStrategy", "max_bins": "maxBins", "bootstrap": "bootstrap",
    },
    "XGBoost": {n: n for n in (
        "n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "min_child_weight", "gamma", "reg_lambda",
        "reg_alpha", "max_bin")},
    "LightGBM": {
        "n_estimators": "n_estimators", "max_depth": "max_depth", "learning_rate": "learning_rate", "subsample": "subsample",
        "colsample_bytree": "colsample_bytree", "num_leaves": "num_leaves", "min_child_samples": "min_child_samples",
        "min_child_weight": "min_child_weight", "min_split_gain": "gamma", "reg_lambda": "reg_lambda", "reg_alpha": "reg_alpha",
        "max_bin": "max_bin",
    },
}
# What the two boosting methods take where nothing is given.
_BOOSTING = {
    "XGBoost": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "reg_lambda": 1.0, "min_child_weight": 1.0, "min_child_samples": 1},
    "LightGBM": {
        "n_estimators": 100, "max_depth": -1, "num_leaves": 31, "learning_rate": 0.1, "reg_lambda": 0.0, "min_child_weight": 0.001,
        "min_child_samples": 20,
    },
}
# Without effect on the result, or held to follow from other parameters.
_WITHOUT_COUNTERPART = {"min_samples_split", "random_state", "n_jobs", "objective"}
DEEPEST_TREE = 30


def spark_params(model: str, params: dict[str, Any]) -> dict[str, Any]:
    """Translate parameter names and values for Spark's estimators.

    Spark's forest has no ``min_samples_split``: it is accepted where it follows from the leaf size, and raises an
    error where it would change the trees.
    """
    names = _SPARK_NAMES.get(model)
    if names is None:
        raise ValueError(f"unknown model {model!r}")
    out: dict[str, Any] = {}
    for name, value in params.items():
        if name in names:
            out[names[name]] = value
        elif name not in _WITHOUT_COUNTERPART:
            raise ValueError(f"{model} has no parameter {name!r}")
    depth = int(out.get("maxDepth", 5))
    if depth > DEEPEST_TREE:
        raise ValueError(f"{model}: max_depth is at most {DEEPEST_TREE}")
    if params.get("min_samples_split", 2) > max(2, 2 * int(out.get("minInstancesPerNode", 1))):
        raise ValueError(f"{model}: min_samples_split over 2 * min_samples_leaf has no counterpart")
    if "featureSubsetStrategy" in out:
        chosen = out["featureSubsetStrategy"]
        whole = chosen is None or chosen == 1.0
        out["featureSubsetStrategy"] = "all" if whole else str(chosen)
    return out


def make_estimator(
    model: str, params: dict[str, Any] | None = None, label: str = "label", seed: int = 42,
    prediction: str = "prediction",
) -> Estimator:
    """An estimator on the assembled features, by model name."""
    chosen = spark_params(model, BASELINES.get(model, {}) if params is None else params)
    columns = {"featuresCol": FEATURES, "labelCol": label, "predictionCol": prediction}
    if model == "Ridge":
        return Ridge(**columns, **chosen)
    if model == "RandomForest":
        return RandomForestRegressor(**{"featureSubsetStrategy": "all", **columns, "seed": seed, **chosen})
    return SecondOrderBoosting(**{**columns, "seed": seed, **_BOOSTING[model], **chosen})


def assembler(features: Sequence[str], on_missing: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid=on_missing)


def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Only the vector and the columns that travel with it."""
    require_columns(df, [*features, *keep])
    # VectorAssembler cannot read names with dots, so inputs get plain ones.
    plain = [f"__f{i}" for i in range(len(features))]
    slim = df.select(
        *[quoted(c) for c in keep], *[quoted(c).cast("double").alias(p) for c, p in zip(features, plain)]
    )
    return assembler(plain).transform(slim).drop(*plain)


def _inputs(features: Sequence[str]) -> list[Transformer]:
    """Stages that assemble the features, whatever their names."""
    if not any("." in c or "`" in c for c in features):
        return [assembler(features)]
    plain = [f"__f{i}" for i in range(len(features))]
    named = ", ".join(f"CAST(`{c.replace('`', '``')}` AS DOUBLE) AS {p}" for c, p in zip(features, plain))
    # The assembler cannot read such names; the plain ones travel on and are dropped with the vector.
    return [SQLTransformer(statement=f"SELECT *, {named} FROM __THIS__"), assembler(plain)]


def without_inputs(df: DataFrame) -> DataFrame:
    """Drop the vector and the plain copies of features that a pipeline has added."""
    return df.drop(FEATURES, *[c for c in df.columns if re.fullmatch(r"__f\d+", c)])


@dataclass(frozen=True)
class Trained:
    """A fitted pipeline with what it was fitted from."""

    name: str
    params: dict[str, Any]
    features: tuple[str, ...]
    model: PipelineModel
    seconds: float

    def transform(self, df: DataFrame) -> DataFrame:
        return without_inputs(self.model.transform(df))


def train(
    model: str,
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    params: dict[str, Any] | None = None,
    seed: int = 42,
) -> Trained:
    """Fit one model by name and time it."""
    require_columns(df, [*features, label])
    shared_dir(df.sparkSession)  # boosting cuts its lineage there
    start = time.monotonic()
    pipeline = Pipeline(stages=[*_inputs(features), make_estimator(model, params, label, seed)])
    fitted = pipeline.fit(df)
    used = BASELINES[model] if params is None else params
    return Trained(model, dict(used), tuple(features), fitted, time.monotonic() - start)


def train_baselines(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    params: dict[str, dict[str, Any]] | None = None,
    seed: int = 42,
) -> list[Trained]:
    """Fit every baseline; the frame is kept while the fits run."""
    frame = df.select(*[quoted(c) for c in [*features, label]]).persist()
    try:
        return [train(m, frame, features, label, p, seed) for m, p in (params or BASELINES).items()]
    finally:
        frame.unpersist()


def training_table(spark, models: Sequence[Trained]) -> DataFrame:
    rows = [(t.name, json.dumps(t.params, sort_keys=True), len(t.features), t.seconds) for t in models]
    return small_table(spark, rows, "model string, params string, n_features bigint, training_seconds double")


def score_models(df: DataFrame, models: Sequence[Trained], label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """Predictions of all models as (model, ..., label, prediction) rows, from one scan."""
    features = models[0].features
    if any(t.features != features for t in models):
        raise ValueError("models must share their features")
    frame = df
    for stage in models[0].model.stages[:-1]:
        frame = stage.transform(frame)
    cells = []
    for i, t in enumerate(models):
        stage = t.model.stages[-1].copy().setPredictionCol(f"__p{i}")
        frame = stage.transform(frame)
        cells.append(F.struct(F.lit(t.name).alias("model"), F.col(f"__p{i}").alias("prediction")))
    return frame.select(
        F.explode(F.array(*cells)).alias("__m"), *[quoted(c) for c in keep], quoted(label).alias("label")
    ).select("__m.model", *[quoted(c) for c in keep], "label", "__m.prediction")


def evaluate_models(df: DataFrame, models: Sequence[Trained], label: str = "label") -> DataFrame:
    """Errors per model, all from one grouped aggregate."""
    return regression_metrics(score_models(df, models, label), by=["model"])


def top_models(metrics: DataFrame, k: int = 2, metric: str = "rmse") -> DataFrame:
    """The ``k`` models with the lowest error, ranked; ties go by name."""
    if k < 1:
        raise ValueError("k must be positive")
    return metrics.orderBy(F.asc_nulls_last(metric), "model").limit(k)


def save_models(models: Sequence[Trained], folder: str) -> dict[str, str]:
    """Store fitted pipelines; returns the path per model."""
    paths = {}
    for t in models:
        paths[t.name] = f"{folder}/{t.name}"
        t.model.write().overwrite().save(paths[t.name])
    return paths


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def select_and_save(
    df: DataFrame, models: Sequence[Trained], folder: str, k: int = 2, label: str = "label"
) -> DataFrame:
    """Evaluate all models, keep the best ``k`` and store them: (model, errors, path)."""
    ranked = top_models(evaluate_models(df, models, label), k).collect()
    chosen = [next(t for t in models if t.name == r["model"]) for r in ranked]
    paths = save_models(chosen, folder)
    rows = [
        (r["model"], i + 1, *[r[m] for m in ("rmse", "mse", "mae", "mape")], paths[r["model"]])
        for i, r in enumerate(ranked)
    ]
    schema = "model string, place bigint, rmse double, mse double, mae double, mape double, path string"
    return small_table(df.sparkSession, rows, schema)
