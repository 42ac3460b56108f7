"""Aggregate expressions: corrected moments and regression errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def corrected_skewness(c: Column) -> Column:
    """Sample skewness with the small-sample correction; NULL below 3 values."""
    n = F.count(c).cast("double")
    spread = F.var_samp(c)
    return (
        F.when(n < 3, F.lit(None))
        .when(spread == 0, F.lit(0.0))
        .otherwise(F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))
    )


def corrected_kurtosis(c: Column) -> Column:
    """Excess kurtosis with the small-sample correction; NULL below 4 values."""
    n = F.count(c).cast("double")
    spread = F.var_samp(c)
    return (
        F.when(n < 4, F.lit(None))
        .when(spread == 0, F.lit(0.0))
        .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))
    )


# Smallest denominator of the percentage error: the float64 machine epsilon.
MAPE_FLOOR = 2.220446049250313e-16


def regression_errors(label: Column, prediction: Column) -> dict[str, Column]:
    """mse, rmse, mae, mape and r2 as aggregates of one pass.

    r2 uses the variance of the label, not raw sums of squares, so that a large
    mean does not cancel. Constant labels give 1 for a perfect fit and 0
    otherwise.
    """
    gap = label - prediction
    seen = gap.isNotNull()
    y = F.when(seen, label)
    mse = F.avg(gap * gap)
    spread = F.var_pop(y)
    r2 = (
        F.when(spread > 0, 1 - mse / spread)
        .when(mse == 0, F.lit(1.0))
        .when(mse > 0, F.lit(0.0))
    )
    return {
        "mse": mse,
        "rmse": F.sqrt(mse),
        "mae": F.avg(F.abs(gap)),
        "mape": F.avg(F.abs(gap) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))),
        "r2": r2,
    }
