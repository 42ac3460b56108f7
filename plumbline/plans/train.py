"""Train baselines, tune the best, and promote the winner."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators import registry, training, tuning
from plumbline.operators.evaluation import regression_metrics


@dataclass(frozen=True)
class TrainOptions:
    features: tuple[str, ...]
    keys: tuple[str, ...]
    label: str = "label"
    baselines: dict[str, dict[str, Any]] | None = None
    spaces: dict[str, dict[str, list]] | None = None
    top_k: int = 2
    trials: int = 50
    folds: int = 10
    seed: int = 42
    metric: str = "cv_rmse"
    threshold: float = registry.THRESHOLD


@dataclass(frozen=True)
class TrainOutcome:
    baselines: DataFrame
    ranked: DataFrame
    tuned: DataFrame
    decision: DataFrame
    winner: training.Trained
    uri: str
    version: int | None


def train_and_promote(df: DataFrame, options: TrainOptions, folder: str, registry_path: str) -> TrainOutcome:
    """Baselines, their ranking, tuning of the best, the gate and the registry.

    Champion and challenger are compared on the same rows.
    """
    spark = df.sparkSession
    frame = df.persist()
    try:
        models = training.train_baselines(frame, options.features, options.label, options.baselines, options.seed)
        ranked = training.select_and_save(frame, models, f"{folder}/top", options.top_k, options.label)
        names: Sequence[str] = [r["model"] for r in ranked.orderBy("place").collect()]
        winner, tuned = tuning.tune_and_choose(
            frame, names, options.features, options.keys, options.label, options.trials, options.folds,
            options.seed, options.metric, options.spaces,
        )
        challenger = regression_metrics(winner.transform(frame), options.label).first()["rmse"]
        errors = [("challenger", challenger)]
        current = registry.champion(registry.read_registry(spark, registry_path)).first()
        if current is not None:
            model = training.load_model(current["uri"])
            scored = regression_metrics(model.transform(frame), options.label).first()
            errors.append(("champion", scored["rmse"]))
    finally:
        frame.unpersist()
    table = small_table(spark, errors, "model string, rmse double")
    decision = registry.gate(table, "champion", "challenger", options.threshold)
    version = None
    uri = current["uri"] if current is not None else ""
    if decision.select(F.col("promote")).first()[0]:
        name = f"{winner.name}_model"
        last = registry.read_registry(spark, registry_path).agg(F.max("sequence")).first()[0] or 0
        uri = f"{folder}/registered/{name}-{last + 1}"
        winner.model.write().overwrite().save(uri)
        version = registry.register(
            spark, registry_path, name, winner.name, challenger, uri, options.features, promoted=True
        )
    return TrainOutcome(
        training.training_table(spark, models), ranked, tuned, decision, winner, uri, version
    )
