"""Score the promoted model on a hold-out table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from plumbline.functions.columns import quoted, require_columns
from plumbline.operators import evaluation, registry
from plumbline.operators.training import without_inputs


def evaluate_champion(
    test: DataFrame,
    registry_path: str,
    keys: Sequence[str],
    label: str = "label",
    repeats: int = 10,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Predictions, errors, residuals and permutation importance of the model in use."""
    model, info = registry.load_champion(test.sparkSession, registry_path)
    features = list(info["feature_names"])
    require_columns(test, [*features, *keys, label])

    def predict(frame: DataFrame) -> DataFrame:
        return without_inputs(model.transform(frame))

    predictions = predict(test).select(*[quoted(c) for c in keys], quoted(label).alias("label"), "prediction")
    return {
        "predictions": predictions,
        "metrics": evaluation.regression_metrics(predictions),
        "residuals": evaluation.residuals(predictions),
        "importance": evaluation.permutation_importance(test, predict, features, keys, label, repeats, seed),
    }
