"""Descriptive statistics as tidy tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    known,
    labelled,
    numeric_columns,
    require_columns,
    rows_from,
    small_table,
    string_columns,
)
from plumbline.functions.moments import corrected_kurtosis, corrected_skewness
from plumbline.operators.quantiles import quantiles
from plumbline.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """One row per numeric column: count, moments, extremes and quartiles.

    All moments come from one aggregate; the quartiles need the counts first
    and are found without sorting the table.
    """
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    row = _moments(df, columns).first()
    counts = {c: row[f"count_{i}"] for i, c in enumerate(columns)}
    return summary_table(df.sparkSession, columns, row, quantiles(df, columns, QUARTILES, exact=exact, counts=counts))


def summary_table(
    spark: SparkSession, columns: Sequence[str], row: Row, cuts: dict[str, list[float | None]]
) -> DataFrame:
    """The summary of columns whose moments (:func:`moment_parts`) and quartiles are known."""
    names = ["count", "mean", "std", "min", "max", "variance", "skewness", "kurtosis"]
    rows = [
        (c, *[row[f"{n}_{i}"] for n in names], *cuts[c]) for i, c in enumerate(columns)
    ]
    doubles = ", ".join(f"{n} double" for n in names[1:])
    schema = f"column string, count bigint, {doubles}, p25 double, p50 double, p75 double"
    return small_table(spark, rows, schema).select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "variance", "skewness", "kurtosis"
    )


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*moment_parts(df, columns))


def moment_parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    parts = []
    for i, name in enumerate(columns):
        c = known(df, name).cast("double")
        parts += [
            F.count(c).alias(f"count_{i}"),
            F.avg(c).alias(f"mean_{i}"),
            F.sqrt(F.var_samp(c)).alias(f"std_{i}"),
            F.min(c).alias(f"min_{i}"),
            F.max(c).alias(f"max_{i}"),
            F.var_samp(c).alias(f"variance_{i}"),
            corrected_skewness(c).alias(f"skewness_{i}"),
            corrected_kurtosis(c).alias(f"kurtosis_{i}"),
        ]
    return parts


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows of the given columns, as strings."""
    require_columns(df, columns)
    return rows_from(
        df,
        [labelled(column=F.lit(c), value=known(df, c).cast("string")) for c in columns],
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of each known value, per column. Partial counts are made before the shuffle."""
    return (
        long_values(df, columns)
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )


def categorical_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per string column: known values, distinct values, most frequent value and its count.

    Equal counts are decided by the smaller value.
    """
    columns = list(columns or string_columns(df))
    return summarise_counts(value_counts(df, columns), columns)


def summarise_counts(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The categorical summary from (column, value, count) rows."""
    found = (
        counts
        .groupBy("column")
        .agg(
            F.sum("count").alias("count"),
            F.count("*").alias("unique"),
            F.max("count").alias("freq"),
            _smallest_top().alias("top"),
        )
    )
    return with_every_column(found, columns, {"count": 0, "unique": 0}).select(
        "column", "count", "unique", "top", "freq"
    )


def _smallest_top():
    # pairs compare by falling count first, then by rising value
    return F.min(F.struct((-F.col("count")).alias("n"), F.col("value").alias("v")))["v"]


def with_every_column(found: DataFrame, columns: Sequence[str], fill: dict[str, int]) -> DataFrame:
    """Add the columns that had no row at all, e.g. all-null ones."""
    names = small_table(found.sparkSession, [(c,) for c in columns], "column string")
    return F.broadcast(names).join(found, "column", "left").fillna(fill)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Number of distinct known values per column."""
    columns = list(columns or df.columns)
    require_columns(df, columns)
    count = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*[count(known(df, c)).alias(f"d{i}") for i, c in enumerate(columns)])
    return rows_from(wide, [labelled(column=F.lit(c), distinct=F.col(f"d{i}")) for i, c in enumerate(columns)])


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Counts of one column with their share of all known values."""
    # The total is added up from the counts, which are stored so that the table is read once.
    counts = materialize(value_counts(df, [column]))
    total = counts.agg(F.sum("count")).first()[0] or 1
    return counts.select("value", "count", (F.col("count") / F.lit(total).cast("double")).alias("share"))


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Missing cells of a row."""
    columns = list(columns or df.columns)
    return sum((known(df, c).isNull().cast("bigint") for c in columns), F.lit(0).cast("bigint"))


def missing_total(df: DataFrame, columns: Sequence[str] | None = None) -> int:
    """Number of missing cells of the table."""
    return df.agg(F.coalesce(F.sum(missing_cells(df, columns)), F.lit(0))).first()[0]
