"""Reproducible splits and folds.

Membership is a function of the row key, so a split is a filter: no join, no
shuffle, and the same rows after a task is retried.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import hashing
from plumbline.functions.columns import quoted, require_columns
from plumbline.operators.quantiles import TASK_ROWS, order_statistics


# Hold-outs up to this size need no search: the uniform digests tell where their edge lies.
DIRECT_ROWS = 100_000


def _first_n(
    df: DataFrame, keys: Sequence[str], n: int, seed: int, task_rows: int, direct_rows: int = DIRECT_ROWS
) -> Column:
    """Condition met by the ``n`` rows with the smallest digests.

    Only the few digests around the edge reach the driver, whatever the
    number of rows or tasks.
    """
    hashed = hashing.digest(keys, seed)
    if n <= 0:
        return F.lit(False)
    words = df.select(hashed.alias("h")).select(hashing.word(F.col("h")).alias("w"), "h")
    total = df.count()
    if n >= total:
        return F.lit(True)
    # The n-th of uniform values is within ten deviations of n / total.
    reach = 10.0 * math.sqrt(n) + 50.0
    low, high = (int(hashing.WORD_RANGE * max(0.0, x) / total) for x in (n - reach, n + reach))
    edge = None
    if n <= direct_rows:
        edge = _edge(words, low, high, n, keys)
    else:
        near = (F.col("w") >= low) & (F.col("w") <= high)
        seen = words.agg(F.count_if(F.col("w") < low).alias("below"), F.count_if(near).alias("inside")).first()
        rank = n - 1 - seen["below"]
        if 0 <= rank < seen["inside"]:
            place = _word_at(words.where(near), rank, seen["inside"], task_rows)
            edge = _edge(words, place, place, n, keys)
    if edge is None:
        # Keys that repeat so much that their digests are not uniform.
        place = _word_at(words, n - 1, total, task_rows)
        edge = _edge(words, place, place, n, keys)
    if edge is None:
        raise RuntimeError("the table changed while it was split")
    return hashed <= F.lit(edge)


def _word_at(words: DataFrame, rank: int, count: int, task_rows: int) -> int:
    return int(order_statistics(words.select("w"), {"w": [rank]}, {"w": count}, task_rows)["w", rank])


def _edge(words: DataFrame, low: int, high: int, n: int, keys: Sequence[str]) -> str | None:
    """The n-th smallest digest if its word lies between ``low`` and ``high``.

    Rows below ``low`` are one count; digests in between come back once each.
    """
    found = (
        words.where(F.col("w") <= high)
        .groupBy(F.when(F.col("w") >= low, F.col("h")).alias("h"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    taken = sum(r["n"] for r in found if r["h"] is None)
    if taken >= n:
        return None
    for row in sorted((r for r in found if r["h"] is not None), key=lambda r: r["h"]):
        taken += row["n"]
        if taken == n:
            return row["h"]
        if taken > n:
            raise ValueError(f"the key {list(keys)} is not unique, so {n} rows cannot be told apart")
    return None


def holdout(
    df: DataFrame,
    keys: Sequence[str],
    size: int,
    seed: int = 42,
    task_rows: int = TASK_ROWS,
    direct_rows: int = DIRECT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``size`` test rows, whatever ``size`` is."""
    require_columns(df, keys)
    chosen = _first_n(df, keys, size, seed, task_rows, direct_rows)
    return df.where(~chosen), df.where(chosen)


def label_holdout(
    df: DataFrame, keys: Sequence[str], size: int, seed: int = 42, task_rows: int = TASK_ROWS
) -> DataFrame:
    """The same split as one frame with a ``split`` column, for a partitioned sink."""
    require_columns(df, keys)
    chosen = _first_n(df, keys, size, seed, task_rows)
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def split_check(source: DataFrame, train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlap and sizes of a split, and whether they add up."""
    names = [quoted(k) for k in keys]
    tagged = train.select(*names, F.lit(0).alias("__part")).unionByName(
        test.select(*names, F.lit(1).alias("__part"))
    )
    # One grouped pass instead of a semi join: a hot key folds into two counts per task.
    per_key = tagged.groupBy(*names).agg(
        F.count_if(F.col("__part") == 0).alias("a"), F.count_if(F.col("__part") == 1).alias("b")
    )
    sizes = per_key.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("test_rows"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("overlap"),
    )
    total = source.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    complete = F.col("train_rows") + F.col("test_rows") == F.lit(total)
    return sizes.withColumn("source_rows", F.lit(total).cast("bigint")).withColumn(
        "passed", complete & (F.col("overlap") == 0)
    )


def fraction_labels(
    df: DataFrame, keys: Sequence[str], fractions: dict[str, float], seed: int = 42, output: str = "split"
) -> DataFrame:
    """n-way split by hash thresholds; the fractions must add up to 1."""
    require_columns(df, keys)
    if abs(sum(fractions.values()) - 1.0) > 1e-9:
        raise ValueError("fractions must add up to 1")
    place = hashing.uniform(hashing.digest(keys, seed))
    names = list(fractions)
    edge, label = 0.0, None
    for name in names[:-1]:
        edge += fractions[name]
        condition = place < F.lit(edge)
        label = F.when(condition, name) if label is None else label.when(condition, name)
    last = F.lit(names[-1])
    return df.withColumn(output, last if label is None else label.otherwise(last))


def hash_folds(
    df: DataFrame, keys: Sequence[str], k: int, seed: int = 42, output: str = "fold"
) -> DataFrame:
    """Shuffled folds 0..k-1; rows with equal keys share a fold."""
    require_columns(df, keys)
    return df.withColumn(output, hashing.bucket(hashing.digest(keys, seed), k))


def contiguous_folds(
    df: DataFrame, order_key: str, k: int, output: str = "fold", task_rows: int = TASK_ROWS
) -> DataFrame:
    """Unshuffled folds in key order; the first ``n % k`` folds are one row larger.

    Only the k-1 cut points are looked up, so the rows are neither sorted nor
    moved. The key must be numeric, known and unique where folds meet.
    """
    require_columns(df, [order_key])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(quoted(order_key)).alias("known")).first()
    n = row["n"]
    if row["known"] != n:
        raise ValueError(f"{order_key} has missing values")
    if n < k:
        raise ValueError(f"{n} rows cannot fill {k} folds")
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    starts = [sum(sizes[:i]) for i in range(1, k)]
    ranks = sorted({r for s in starts for r in (s - 1, s)})
    found = order_statistics(df, {order_key: ranks}, {order_key: n}, task_rows)
    if any(found[order_key, s - 1] == found[order_key, s] for s in starts):
        raise ValueError(f"{order_key} repeats where two folds meet")
    fold = F.lit(0)
    for s in starts:
        fold = fold + (quoted(order_key) >= F.lit(found[order_key, s])).cast("int")
    return df.withColumn(output, fold)


# Share of the training rows at each point of a learning curve: fixed values.
LEARNING_FRACTIONS = (0.1, 0.325, 0.55, 0.775, 1.0)


def in_subset(keys: Sequence[str], fraction: float, seed: int = 42) -> Column:
    """Nested hash subsets: a smaller fraction is part of every larger one."""
    return hashing.uniform(hashing.digest(keys, f"subset{seed}")) < F.lit(fraction)


def learning_subsets(
    df: DataFrame,
    keys: Sequence[str],
    k: int = 5,
    fractions: Sequence[float] = LEARNING_FRACTIONS,
    seed: int = 42,
) -> DataFrame:
    """Rows with their fold and ``step``: the first fraction whose subset holds the row.

    The training rows of fold f at step s are those with fold != f and
    step <= s, so the frame is stored once for all fits.
    """
    place = hashing.uniform(hashing.digest(keys, f"subset{seed}"))
    step = F.lit(0)
    for fraction in fractions[:-1]:
        step = step + (place >= F.lit(float(fraction))).cast("int")
    return hash_folds(df, keys, k, seed).withColumn("step", step)


def hash_sample(df: DataFrame, keys: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows drawn by key hash, or all of them if there are fewer."""
    return holdout(df, keys, size, seed)[1]
