"""Ridge regression on parts of a table from one scan: centred cross-products that add up.

One grouped aggregate gives, for each part (a fold, or a fold and a step of a learning curve), the row count, the
means and the covariances of features and label. Parts are merged on the driver, a few numbers each, so the
fit on any union of parts, for any penalty, and its squared error on any other union need no further scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted, require_columns, small_table
from plumbline.operators.split import LEARNING_FRACTIONS, learning_subsets

#: Features up to which one aggregate holds all pairs; beyond them models are fitted part by part.
PRODUCT_FEATURES = 40


@dataclass(frozen=True)
class Moments:
    """Rows, means and centred cross-products of the features and, last, the label."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        share = other.n / n
        return Moments(n, self.mean + share * gap, self.products + other.products + np.outer(gap, gap) * (self.n * share))

    def ridge(self, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of least squares with penalty ``alpha`` times the squared coefficients."""
        if not self.n:
            raise ValueError("no rows to fit")
        width = len(self.mean) - 1
        left, right = self.products[:width, :width] + alpha * np.eye(width), self.products[:width, width]
        weights = np.linalg.lstsq(left, right, rcond=None)[0] if width else np.zeros(0)
        return weights, float(self.mean[width] - weights @ self.mean[:width])

    def mse(self, weights: np.ndarray, intercept: float) -> float:
        """Mean squared error of a linear model on these rows."""
        contrast = np.append(-weights, 1.0)
        return max(float(contrast @ self.products @ contrast) / self.n, 0.0) + float(contrast @ self.mean - intercept) ** 2


def gather(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()) -> dict[tuple, Moments]:
    """The moments of each part of ``df``, from one aggregate; missing values are an error."""
    require_columns(df, [*features, label, *by])
    if len(features) > PRODUCT_FEATURES:
        raise ValueError(f"at most {PRODUCT_FEATURES} features")
    plain = [f"__x{i}" for i in range(len(features) + 1)]
    rows = df.select(*[quoted(c) for c in by], *[quoted(c).cast("double").alias(p) for c, p in zip([*features, label], plain)])
    pairs = [(i, j) for i in range(len(plain)) for j in range(i, len(plain))]
    known = reduce(lambda a, b: a & b, [F.col(p).isNotNull() & ~F.isnan(p) for p in plain])
    found = rows.groupBy(*[quoted(c) for c in by]).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(known).alias("__known"), *(F.avg(p).alias(f"__m{i}") for i, p in enumerate(plain)),
        *(F.covar_pop(plain[i], plain[j]).alias(f"__c{i}_{j}") for i, j in pairs)).collect()
    parts = {}
    for r in found:
        if r["__known"] < r["__n"]:
            raise ValueError("missing values in features or label")
        products = np.zeros((len(plain), len(plain)))
        for i, j in pairs:
            products[i, j] = products[j, i] = r["__n"] * (r[f"__c{i}_{j}"] or 0.0)
        if r["__n"]:
            parts[tuple(r[c] for c in by)] = Moments(r["__n"], np.array([r[f"__m{i}"] for i in range(len(plain))]), products)
    return parts


def union(parts: Iterable[Moments], width: int) -> Moments:
    """All rows of some parts."""
    return reduce(lambda a, b: a + b, parts, Moments(0, np.zeros(width + 1), np.zeros((width + 1, width + 1))))


def fold_models(parts: dict[tuple, Moments], k: int, alpha: float) -> list[tuple[np.ndarray, float]]:
    """The model of each fold, fitted on all other folds."""
    width = len(next(iter(parts.values())).mean) - 1 if parts else 0
    return [union((m for key, m in parts.items() if key[0] != i), width).ridge(alpha) for i in range(k)]


def fold_errors(parts: dict[tuple, Moments], k: int, alpha: float) -> list[float]:
    """Root of the mean squared error of each fold under the model that has not seen it."""
    if any((i,) not in parts for i in range(k)):
        raise ValueError("a fold has no rows")
    return [parts[(i,)].mse(*model) ** 0.5 for i, model in enumerate(fold_models(parts, k, alpha))]


def by_fold(models: Sequence[tuple[np.ndarray, float]], features: Sequence[str], fold: str = "fold") -> Column:
    """The prediction of the model of each row's fold."""
    def of(values: Iterable[float]) -> Column:
        return F.get(F.array(*(F.lit(float(v)) for v in values)), F.col(fold))

    terms = [quoted(c).cast("double") * of(m[0][i] for m in models) for i, c in enumerate(features)]
    return reduce(lambda a, b: a + b, terms, of(m[1] for m in models))


def learning_curve(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], label: str = "label", alpha: float = 1.0, k: int = 5,
    fractions: Sequence[float] = LEARNING_FRACTIONS, seed: int = 42,
) -> DataFrame:
    """``evaluation.learning_curve`` of ridge regression: the same errors from one scan instead of two for each fold and share."""
    parts = gather(learning_subsets(df, keys, k, fractions, seed), features, label, ["fold", "step"])
    width, rows = len(features), []
    for step, fraction in enumerate(fractions):
        errors = []
        for i in range(k):
            seen = union((m for (fold, s), m in parts.items() if fold != i and s <= step), width)
            held = union((m for (fold, _), m in parts.items() if fold == i), width)
            model = seen.ridge(alpha)
            errors.append((seen.mse(*model), held.mse(*model) if held.n else None, seen.n))
        known = [e[1] for e in errors if e[1] is not None]
        rows.append((
            step, float(fraction), float(np.mean([e[0] for e in errors])) ** 0.5, float(np.mean(known)) ** 0.5 if known else None,
            float(np.mean([e[2] for e in errors]))))
    schema = "step int, fraction double, train_rmse double, validation_rmse double, train_rows double"
    return small_table(df.sparkSession, rows, schema)
