"""Recursive feature elimination with cross-validation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators.split import hash_folds
from plumbline.operators.training import FEATURES, assembled
from plumbline.session import shared_dir


def forest(label: str = "label", trees: int = 300, depth: int = 30, seed: int = 42) -> Estimator:
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="all"
    )


def _weights(model, features: Sequence[str]) -> dict[str, float]:
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients.toArray())
    return {f: float(v) for f, v in zip(features, values)}


@dataclass(frozen=True)
class Selection:
    """Chosen features, elimination ranks (1 = kept) and errors per subset size and fold."""

    selected: tuple[str, ...]
    ranking: dict[str, int]
    scores: tuple[tuple[int, int, float], ...]

    def table(self, spark) -> DataFrame:
        rows = [(f, r, r == 1) for f, r in self.ranking.items()]
        return small_table(spark, rows, "feature string, rank int, selected boolean")

    def score_table(self, spark) -> DataFrame:
        return small_table(spark, list(self.scores), "n_features int, fold int, mse double")

    @staticmethod
    def from_table(table: DataFrame) -> "Selection":
        rows = table.orderBy("rank", "feature").collect()
        return Selection(
            tuple(r["feature"] for r in rows if r["selected"]), {r["feature"]: r["rank"] for r in rows}, ()
        )


def _eliminate(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    estimator: Estimator,
    smallest: int,
    visit: Callable[[list[str], object], None] | None = None,
) -> tuple[list[str], list[str]]:
    """Fit, drop the weakest feature, repeat: (kept, dropped in order)."""
    left, dropped = list(features), []
    while True:
        # The last subset is fitted only where it is scored.
        if len(left) <= smallest and visit is None:
            return left, dropped
        model = estimator.fit(assembled(frame, left, [label]))
        if visit is not None:
            visit(left, model)
        if len(left) <= smallest:
            return left, dropped
        weights = _weights(model, left)
        weakest = min(left, key=lambda f: (weights[f], f))
        left = [f for f in left if f != weakest]
        dropped.append(weakest)


def recursive_elimination(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    estimator: Estimator | None = None,
    k: int = 5,
    smallest: int = 1,
    seed: int = 42,
) -> Selection:
    """Choose the number of features by cross-validation, then the features on all rows.

    Every fold eliminates on its own training rows. The size with the lowest
    mean error wins, the smaller one on ties. There are k * p + p distributed
    fits on one persisted frame; the driver sees one number per fit.
    """
    estimator = estimator or forest(label, seed=seed)
    shared_dir(df.sparkSession)
    frame = hash_folds(df, keys, k, seed).select(*features, label, "fold").persist()
    scores: list[tuple[int, int, float]] = []
    try:
        for fold in range(k):
            held_out = frame.where(F.col("fold") == fold)

            def score(subset: list[str], model, fold=fold, held_out=held_out) -> None:
                gap = F.col(label) - F.col("prediction")
                row = model.transform(assembled(held_out, subset, [label])).agg(F.avg(gap * gap)).first()
                scores.append((len(subset), fold, row[0]))

            _eliminate(frame.where(F.col("fold") != fold), features, label, estimator, smallest, score)
        sizes = sorted({s for s, _, _ in scores})
        mean = {n: sum(m for s, _, m in scores if s == n) / k for n in sizes}
        best = min(sizes, key=lambda n: (mean[n], n))
        kept, dropped = _eliminate(frame, features, label, estimator, best)
    finally:
        frame.unpersist()
    ranking = {f: 1 for f in kept}
    ranking.update({f: i + 2 for i, f in enumerate(reversed(dropped))})
    return Selection(tuple(kept), ranking, tuple(scores))
