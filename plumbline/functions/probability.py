"""Tail probabilities of single test statistics.

The statistics come from distributed aggregates; only the last scalar uses the
commons-math library that Spark ships.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession


def _distributions(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.commons.math3.distribution


def _unusable(*values: float | None) -> bool:
    return any(v is None or math.isnan(v) for v in values)


def t_two_sided(spark: SparkSession, statistic: float | None, df: float | None) -> float | None:
    if _unusable(statistic, df) or df <= 0:
        return None
    if math.isinf(statistic):
        return 0.0
    return 2.0 * _distributions(spark).TDistribution(float(df)).cumulativeProbability(-abs(float(statistic)))


def t_quantile(spark: SparkSession, probability: float, df: float | None) -> float | None:
    if _unusable(df) or df <= 0:
        return None
    return _distributions(spark).TDistribution(float(df)).inverseCumulativeProbability(float(probability))


def f_upper(spark: SparkSession, statistic: float | None, df1: float, df2: float) -> float | None:
    if _unusable(statistic) or df1 <= 0 or df2 <= 0:
        return None
    if math.isinf(statistic):
        return 0.0
    special = spark.sparkContext._jvm.org.apache.commons.math3.special
    return special.Beta.regularizedBeta(df2 / (df2 + df1 * float(statistic)), df2 / 2.0, df1 / 2.0)


def chi2_upper(spark: SparkSession, statistic: float | None, df: float) -> float | None:
    if _unusable(statistic):
        return None
    if df <= 0:
        return 1.0
    special = spark.sparkContext._jvm.org.apache.commons.math3.special
    return special.Gamma.regularizedGammaQ(df / 2.0, float(statistic) / 2.0)


def normal_two_sided(spark: SparkSession, statistic: float | None) -> float | None:
    if _unusable(statistic):
        return None
    return math.erfc(abs(statistic) / math.sqrt(2.0))
