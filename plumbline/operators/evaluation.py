"""Regression errors, residuals, permutation importance, learning curves and noise checks."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import hashing
from plumbline.functions.columns import known, quoted, require_columns, small_table, union_all
from plumbline.functions.moments import regression_errors
from plumbline.operators.split import LEARNING_FRACTIONS, learning_subsets

Predict = Callable[[DataFrame], DataFrame]


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows, mse, rmse, mae, mape and r2, over all rows or per group.

    Only sums per group are shuffled, so a group of any size costs the same.
    """
    require_columns(df, [label, prediction, *by])
    y, p = known(df, label).cast("double"), known(df, prediction).cast("double")
    errors = [e.alias(n) for n, e in regression_errors(y, p).items()]
    count = F.count(y - p).alias("n")
    if not by:
        return df.agg(count, *errors)
    return df.groupBy(*[quoted(c) for c in by]).agg(count, *errors)


def original_scale_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Errors after taking label and prediction back from the log scale."""
    back = df.select(F.expm1(quoted(label)).alias("label"), F.expm1(quoted(prediction)).alias("prediction"))
    return regression_metrics(back)


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("residual", quoted(label) - quoted(prediction))


# --- permutation importance -------------------------------------------------------

# Rows that one window partition is meant to hold.
_BUCKET_ROWS = 100_000


def shuffled_neighbours(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], seed: int | str, rows: int, bucket_rows: int = _BUCKET_ROWS
) -> DataFrame:
    """Give each row, as ``__d0``, ``__d1``, ..., the given columns of another, random row.

    Rows are dealt into buckets by key hash and put into hash order inside
    them; each takes the values of the next one and the last those of the
    first. Every row gives its values once, so this is a permutation, at the
    price of one shuffle: no row numbers and no join.
    """
    buckets = max(1, -(-rows // bucket_rows))
    dealt = df.withColumn("__h", hashing.digest(keys, seed)).select(
        *[quoted(c) for c in df.columns],
        F.floor(hashing.uniform(F.col("__h"), 1) * buckets).cast("int").alias("__b"),
        # Two words of 52 bits sort like the digest and cost less to shuffle.
        hashing.word(F.col("__h"), 0).alias("__w0"),
        hashing.word(F.col("__h"), 1).alias("__w1"),
    )
    # Rows that share a key come in the order of what they hold, so a task that runs again deals alike.
    order = Window.partitionBy("__b").orderBy("__w0", "__w1", *[quoted(c) for c in df.columns])
    values = F.struct(*[quoted(c).alias(f"__d{i}") for i, c in enumerate(columns)])
    donor = F.coalesce(F.lead(values).over(order), F.first(values).over(order))
    return dealt.withColumn("__donor", donor).select(*[quoted(c) for c in df.columns], "__donor.*")


def permutation_drops(
    df: DataFrame,
    predict: Predict,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    repeats: int = 10,
    seed: int = 42,
    bucket_rows: int = _BUCKET_ROWS,
) -> DataFrame:
    """(feature, repeat, drop): loss of r2 when a feature is shuffled, for each repeat.

    The donor row of a repeat serves all features, so shuffles grow with the
    repeats but not with the features. ``predict`` adds a ``prediction`` to a
    frame that has the features. Keys must tell rows apart.
    """
    require_columns(df, [*features, *keys, label])
    slim = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *features, label])])
    squared = F.pow(quoted(label) - F.col("prediction"), F.lit(2.0))
    base = predict(slim).agg(
        F.count(F.lit(1)).alias("n"),
        F.approx_count_distinct(F.struct(*[quoted(k) for k in keys])).alias("different"),
        F.var_pop(quoted(label)).alias("spread"),
        F.avg(squared).alias("mse"),
    ).first()
    if not base["n"]:
        raise ValueError("the table is empty")
    if base["different"] < 0.7 * base["n"]:
        raise ValueError(f"the key {list(keys)} repeats, so its hash cannot shuffle the rows")
    parts = []
    for r in range(repeats):
        rows = shuffled_neighbours(slim, keys, features, f"{seed}.{r}", base["n"], bucket_rows)
        variants = [
            F.struct(
                F.lit(f).alias("feature"),
                *[(F.col(f"__d{i}") if i == k else quoted(c)).alias(c) for i, c in enumerate(features)],
            )
            for k, f in enumerate(features)
        ]
        parts.append(
            rows.select(F.lit(r).alias("repeat"), quoted(label), F.explode(F.array(*variants)).alias("v"))
            .select("repeat", quoted(label), "v.*")
        )
    return predict(union_all(parts)).groupBy("feature", "repeat").agg(
        ((F.avg(squared) - F.lit(base["mse"])) / F.lit(base["spread"] or math.nan)).alias("drop")
    )


def permutation_importance(
    df: DataFrame,
    predict: Predict,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    repeats: int = 10,
    seed: int = 42,
    bucket_rows: int = _BUCKET_ROWS,
) -> DataFrame:
    """Loss of r2 when a feature is shuffled: mean and population deviation over repeats."""
    return importance_summary(permutation_drops(df, predict, features, keys, label, repeats, seed, bucket_rows))


def importance_summary(drops: DataFrame) -> DataFrame:
    """Mean, deviation and place of each feature from the drops of all repeats."""
    summary = drops.groupBy("feature").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")
    )
    # One row per feature, so a window over all of them is small.
    return summary.withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("importance_mean"), "feature"))
    )


# --- learning curve -----------------------------------------------------------------


def learning_curve(
    df: DataFrame,
    estimator: Estimator,
    keys: Sequence[str],
    label: str = "label",
    k: int = 5,
    fractions: Sequence[float] = LEARNING_FRACTIONS,
    seed: int = 42,
) -> DataFrame:
    """Root of the mean fold error on training and held-out rows per training share.

    ``estimator`` is fitted once per fold and share on a persisted frame; its
    stages must use the columns of ``df``.
    """
    frame = learning_subsets(df, keys, k, fractions, seed).persist()
    try:
        cells = []
        for step in range(len(fractions)):
            for fold in range(k):
                training = (F.col("fold") != fold) & (F.col("step") <= step)
                model = estimator.fit(frame.where(training))
                scored = model.transform(frame.where(training | (F.col("fold") == fold)))
                gap = F.pow(quoted(label) - F.col("prediction"), F.lit(2.0))
                row = scored.agg(
                    F.avg(F.when(F.col("fold") != fold, gap)), F.avg(F.when(F.col("fold") == fold, gap)),
                    F.count_if(F.col("fold") != fold),
                ).first()
                cells.append((step, float(fractions[step]), fold, row[0], row[1], row[2]))
    finally:
        frame.unpersist()
    schema = "step int, fraction double, fold int, train_mse double, validation_mse double, train_rows bigint"
    return (
        small_table(df.sparkSession, cells, schema)
        .groupBy("step", "fraction")
        .agg(
            F.sqrt(F.avg("train_mse")).alias("train_rmse"),
            F.sqrt(F.avg("validation_mse")).alias("validation_rmse"),
            F.avg("train_rows").alias("train_rows"),
        )
    )


# --- noise ---------------------------------------------------------------------------


def add_noise(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], scale: float = 0.1, seed: int = 42
) -> DataFrame:
    """Add normal noise drawn from the row key, a separate stream per column."""
    require_columns(df, [*columns, *keys])
    return df.withColumns({
        c: quoted(c) + F.lit(float(scale)) * hashing.normal(hashing.digest(keys, f"{seed}.{i}"))
        for i, c in enumerate(columns)
    })


def noise_robustness(
    df: DataFrame,
    predict: Predict,
    features: Sequence[str],
    keys: Sequence[str],
    label: str = "label",
    scale: float = 0.1,
    seed: int = 42,
) -> DataFrame:
    """Errors on the features as they are and with noise: (data, n, mse, ...)."""
    # Both versions of a row come from one scan.
    names = list(dict.fromkeys([*features, label]))
    noise = {c: hashing.normal(hashing.digest(keys, f"{seed}.{i}")) for i, c in enumerate(features)}
    versions = F.array(*[
        F.struct(F.lit(data).alias("data"), *[
            (quoted(c) + F.lit(float(scale)) * noise[c] if data == "noisy" and c in noise else quoted(c).cast("double")).alias(c)
            for c in names])
        for data in ("clean", "noisy")])
    rows = df.select(F.explode(versions).alias("__v")).select("__v.*")
    scored = predict(rows).select("data", quoted(label).alias("label"), "prediction")
    return regression_metrics(scored, by=["data"])
