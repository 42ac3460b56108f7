"""Statistical tests. Tables are reduced on Spark; the last scalar gives the p-value."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import probability as prob
from plumbline.functions.columns import known, quoted, require_columns, small_table
from plumbline.operators import ranks
from plumbline.session import materialize


def _group_moments(df: DataFrame, value: str, group: str, levels: Sequence | None = None) -> DataFrame:
    """(level, n, mean, var) per group with known values."""
    require_columns(df, [value, group])
    v = known(df, value).cast("double")
    kept = df.where(v.isNotNull() & quoted(group).isNotNull())
    if levels is not None:
        kept = kept.where(quoted(group).isin(list(levels)))
    return kept.groupBy(quoted(group).alias("level")).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var")
    )


def _two_groups(df: DataFrame, value: str, group: str, levels: Sequence):
    if len(levels) != 2:
        raise ValueError("two levels are needed")
    rows = {r["level"]: r for r in _group_moments(df, value, group, levels).collect()}
    if any(level not in rows for level in levels):
        raise ValueError(f"no rows for one of {list(levels)}")
    return rows[levels[0]], rows[levels[1]]


def t_test(df: DataFrame, value: str, group: str, levels: Sequence, equal_var: bool = True) -> DataFrame:
    """Two-sample t test, pooled or Welch."""
    a, b = _two_groups(df, value, group, levels)
    if a["n"] < 2 or b["n"] < 2:
        statistic = degrees = None
    elif equal_var:
        degrees = a["n"] + b["n"] - 2.0
        pooled = ((a["n"] - 1) * a["var"] + (b["n"] - 1) * b["var"]) / degrees
        error = math.sqrt(pooled * (1.0 / a["n"] + 1.0 / b["n"]))
        statistic = _ratio(a["mean"] - b["mean"], error)
    else:
        ea, eb = a["var"] / a["n"], b["var"] / b["n"]
        degrees = _ratio((ea + eb) ** 2, ea**2 / (a["n"] - 1) + eb**2 / (b["n"] - 1))
        statistic = _ratio(a["mean"] - b["mean"], math.sqrt(ea + eb))
    spark = df.sparkSession
    p = prob.t_two_sided(spark, statistic, degrees)
    return small_table(spark, [(statistic, degrees, p)], "statistic double, df double, p_value double")


def _ratio(a: float, b: float) -> float | None:
    if b == 0:
        return None if a == 0 else math.copysign(math.inf, a)
    return a / b


def cohen_d(df: DataFrame, value: str, group: str, levels: Sequence, ddof: int = 1) -> DataFrame:
    """Difference of means in pooled standard deviations; ``ddof=0`` pools population variances."""
    a, b = _two_groups(df, value, group, levels)

    def variance(r):
        if ddof == 1:
            return r["var"]
        return 0.0 if r["n"] == 1 else r["var"] * (r["n"] - 1) / r["n"]

    effect = None
    if min(a["n"], b["n"]) > ddof - 1 and a["n"] + b["n"] > 2 and None not in (variance(a), variance(b)):
        pooled = ((a["n"] - 1) * variance(a) + (b["n"] - 1) * variance(b)) / (a["n"] + b["n"] - 2)
        effect = _ratio(a["mean"] - b["mean"], math.sqrt(pooled))
    return small_table(df.sparkSession, [(effect,)], "effect_size double")


def anova(df: DataFrame, value: str, group: str) -> DataFrame:
    """One-way analysis of variance over all levels of ``group``."""
    v = known(df, value).cast("double")
    centre = df.where(quoted(group).isNotNull()).agg(F.avg(v)).first()[0]
    groups = _group_moments(df, value, group)
    n, mean = F.col("n"), F.col("mean")
    inside = F.coalesce((n - 1) * F.col("var"), F.lit(0.0))
    row = groups.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(n * F.pow(mean - F.lit(centre).cast("double"), F.lit(2.0))).alias("between"),
        F.sum(inside).alias("within"),
    ).first()
    statistic = p = None
    d1, d2 = row["k"] - 1.0, (row["n"] or 0) - float(row["k"])
    if d1 > 0 and d2 > 0:
        statistic = _ratio(row["between"] / d1, row["within"] / d2)
        p = prob.f_upper(df.sparkSession, statistic, d1, d2)
    return small_table(
        df.sparkSession, [(statistic, d1, d2, p)], "statistic double, df_between double, df_within double, p_value double"
    )


def chi_squared(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Independence of two categorical columns; Yates' correction on 2 by 2 tables.

    Empty cells need no rows of their own: the statistic is
    n * (sum of observed^2 / (row total * column total) - 1).
    """
    require_columns(df, [a, b])
    # The cells are stored: the table is read and shuffled once for all that follows.
    cells = materialize(
        df.select(quoted(a).cast("string").alias("a"), quoted(b).cast("string").alias("b"))
        .dropna()
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("o"))
    )
    row_totals = cells.groupBy("a").agg(F.sum("o").alias("ra"))
    column_totals = cells.groupBy("b").agg(F.sum("o").alias("cb"))
    full = cells.join(row_totals, "a").join(column_totals, "b")
    share = F.col("o").cast("double") / F.col("ra") * F.col("o") / F.col("cb")
    row = full.agg(F.sum("o").alias("n"), F.sum(share).alias("s")).first()
    n, r, c = row["n"] or 0, row_totals.count(), column_totals.count()
    degrees = (r - 1) * (c - 1)
    statistic = None
    if n and degrees == 0:
        statistic = 0.0
    elif n:
        statistic = n * (row["s"] - 1.0)
        if correction and r == 2 and c == 2:
            statistic = _yates(cells)
    p = prob.chi2_upper(df.sparkSession, statistic, degrees)
    return small_table(
        df.sparkSession, [(statistic, float(degrees), p)], "statistic double, df double, p_value double"
    )


def _yates(cells: DataFrame) -> float:
    """At most four cells, so the driver may hold them."""
    found = {(r["a"], r["b"]): r["o"] for r in cells.select("a", "b", "o").collect()}
    rows, columns = sorted({k[0] for k in found}), sorted({k[1] for k in found})
    n = sum(found.values())
    total = 0.0
    for x in rows:
        for y in columns:
            observed = found.get((x, y), 0)
            expected = sum(found.get((x, k), 0) for k in columns) * sum(found.get((k, y), 0) for k in rows) / n
            total += max(0.0, abs(observed - expected) - min(0.5, abs(observed - expected))) ** 2 / expected
    return total


def correlation_test(df: DataFrame, x: str, y: str, method: str = "pearson") -> DataFrame:
    """(n, r, p_value) by Pearson, Spearman or Kendall."""
    require_columns(df, [x, y])
    spark = df.sparkSession
    if method == "kendall":
        row = ranks.kendall(df, x, y).first()
        n, r, p = row["n"], row["tau"], prob.normal_two_sided(spark, row["z"])
    else:
        if method == "pearson":
            a, b = known(df, x).cast("double"), known(df, y).cast("double")
            row = df.agg(
                F.count_if(a.isNotNull() & b.isNotNull()).alias("n"), F.corr(a, b).alias("r")
            ).first()
        elif method == "spearman":
            row = ranks.spearman(df, x, y).first()
        else:
            raise ValueError(f"unknown method {method!r}")
        n, r = row["n"], row["r"]
        if r is None or n < 3:
            p = None
        else:
            gap = (1.0 - r) * (1.0 + r)
            statistic = math.inf if gap <= 0 else r * math.sqrt((n - 2.0) / gap)
            p = prob.t_two_sided(spark, statistic, n - 2.0)
    return small_table(spark, [(method, n, r, p)], "method string, n bigint, r double, p_value double")


def mean_interval(df: DataFrame, columns: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Mean, standard error and Student t interval per column, over known values."""
    require_columns(df, columns)
    parts = []
    for i, name in enumerate(columns):
        c = known(df, name).cast("double")
        parts += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    row = df.agg(*parts).first()
    moments = {c: (row[f"n{i}"], row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}
    return interval_table(df.sparkSession, moments, confidence)


def interval_table(
    spark: SparkSession, moments: dict[str, tuple[int, float | None, float | None]], confidence: float = 0.95
) -> DataFrame:
    """The intervals of columns whose count, mean and sample deviation are known."""
    out = []
    for c, (n, mean, std) in moments.items():
        error = reach = None
        if std is not None and n > 1:
            error = std / math.sqrt(n)
            reach = error * prob.t_quantile(spark, (1.0 + confidence) / 2.0, n - 1.0)
        out.append((c, n, mean, error, None if reach is None else mean - reach, None if reach is None else mean + reach))
    return small_table(
        spark, out, "column string, n bigint, mean double, standard_error double, ci_low double, ci_high double"
    )
