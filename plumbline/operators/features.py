"""Feature transforms, encoders and scalers.

Each fit is one aggregate and gives a small parameter object; applying it is a
projection that Catalyst fuses with the scan. Parameters convert to and from a
table so that they can be stored next to the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    known,
    numeric_columns,
    quoted,
    require_columns,
    small_table,
    string_columns,
)
from plumbline.operators.describe import long_values
from plumbline.session import materialize

def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def log_transform(df: DataFrame, columns: Sequence[str], drop_original: bool = True) -> DataFrame:
    """``<c>_log`` = ln(1 + c); NULL where c <= -1."""
    require_columns(df, columns)
    out = df.withColumns({f"{c}_log": F.log1p(known(df, c).cast("double")) for c in columns})
    return out.drop(*columns) if drop_original else out


def sqrt_transform(df: DataFrame, columns: Sequence[str], drop_original: bool = True) -> DataFrame:
    """``<c>_sqrt``; NULL below zero."""
    require_columns(df, columns)
    out = df.withColumns({f"{c}_sqrt": _finite(F.sqrt(known(df, c).cast("double"))) for c in columns})
    return out.drop(*columns) if drop_original else out


def transform_features(
    df: DataFrame, log_columns: Sequence[str] = (), sqrt_columns: Sequence[str] = (), drop_original: bool = True
) -> DataFrame:
    return sqrt_transform(log_transform(df, log_columns, drop_original), sqrt_columns, drop_original)


def inverse_log(df: DataFrame, columns: Sequence[str], suffix: str = "_expm1") -> DataFrame:
    """Back from the log scale: exp(c) - 1."""
    return df.withColumns({f"{c}{suffix}": F.expm1(known(df, c)) for c in columns})


@dataclass(frozen=True)
class Encoder:
    """Sorted categories per string column."""

    categories: dict[str, list[str]]

    def flags(self) -> list[tuple[str, str, str]]:
        """(flag, column, category). Names that are taken, whatever their case, get a number."""
        found, taken = [], set()
        for c, values in self.categories.items():
            for v in values:
                name, n = f"{c}_{v}", 2
                while name.lower() in taken:
                    name, n = f"{c}_{v}_{n}", n + 1
                taken.add(name.lower())
                found.append((name, c, v))
        return found

    def flag_names(self) -> list[str]:
        return [name for name, _, _ in self.flags()]

    def one_hot(self, df: DataFrame, drop_source: bool = True) -> DataFrame:
        """One 0/1 column ``<column>_<category>`` per category; unseen values give only zeros."""
        require_columns(df, self.categories)
        there = {c.lower() for c in df.columns}
        taken = [name for name in self.flag_names() if name.lower() in there]
        if taken:
            raise ValueError(f"columns already there: {sorted(taken)}")
        flags = {name: F.coalesce((quoted(c) == F.lit(v)).cast("double"), F.lit(0.0)) for name, c, v in self.flags()}
        # One projection: a chain of withColumn would grow the plan with every category.
        out = df.withColumns(flags)
        return out.drop(*self.categories) if drop_source else out

    def label(self, df: DataFrame, suffix: str = "_index") -> DataFrame:
        """Position in the sorted categories; NULL for unseen values."""
        require_columns(df, self.categories)
        codes = {}
        for c, values in self.categories.items():
            place = F.array_position(F.array(*[F.lit(v) for v in values]), quoted(c)) - 1
            codes[f"{c}{suffix}"] = F.when(place >= 0, place.cast("int"))
        return df.withColumns(codes)

    def to_table(self, spark) -> DataFrame:
        rows = [(c, i, v) for c, values in self.categories.items() for i, v in enumerate(values)]
        return small_table(spark, rows, "column string, position int, category string")

    @staticmethod
    def from_table(table: DataFrame) -> "Encoder":
        found: dict[str, list[str]] = {}
        for r in table.orderBy("column", "position").collect():
            found.setdefault(r["column"], []).append(r["category"])
        return Encoder(found)


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct known (column, category) pairs; tasks send each pair once."""
    return (
        long_values(df, columns)
        .where(F.col("value").isNotNull())
        .distinct()
        .select("column", F.col("value").alias("category"))
    )


def fit_encoder(df: DataFrame, columns: Sequence[str] | None = None, max_categories: int | None = None) -> Encoder:
    """Categories of the training frame, in sorted order.

    The encoder is part of the plan, one flag column per category. Columns with very
    many categories go through :func:`fit_positions` instead. With ``max_categories``, more
    of them raise an error.
    """
    columns = list(columns or string_columns(df))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in category_table(df, columns).collect():
        found[r["column"]].append(r["category"])
    wide = [c for c, values in found.items() if max_categories is not None and len(values) > max_categories]
    if wide:
        raise ValueError(f"more than {max_categories} categories in {wide}")
    return Encoder({c: sorted(values) for c, values in found.items()})


# Rows of a position table that every executor may hold.
BROADCAST_CATEGORIES = 1_000_000


def fit_positions(df: DataFrame, column: str, task_rows: int = 1_000_000) -> DataFrame:
    """(category, position) of a column with any number of categories, positions in sorted order.

    Categories are dealt into ranges and numbered inside each; one number per range is
    added up, so no task sorts them all.
    """
    distinct = category_table(df, [column]).select("category")
    ranges = distinct.count() // task_rows + 1
    ranged = materialize(distinct.repartitionByRange(ranges, "category").withColumn("part", F.spark_partition_id()))
    inside = ranged.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("category")) - 1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return inside.join(F.broadcast(starts), "part").select("category", (F.col("before") + F.col("place")).alias("position"))


def one_hot_vector(df: DataFrame, column: str, positions: DataFrame, output: str | None = None) -> DataFrame:
    """``<column>_vector``: a sparse vector with a 1 at the category's position; unseen values give zeros.

    The positions are joined, by broadcast where they are few.
    """
    require_columns(df, [column])
    output = output or f"{column}_vector"
    size = positions.count()
    table = positions.select(F.col("category").alias("__category"), F.col("position").cast("double").alias("__position"))
    table = F.broadcast(table) if size <= BROADCAST_CATEGORIES else table
    joined = df.join(table, quoted(column) == F.col("__category"), "left").fillna(float(size), subset=["__position"])
    # Index ``size`` stands for unseen values; it is the last one, which the encoder leaves out.
    sizes = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
    joined = joined.withColumn("__position", F.col("__position").alias("__position", metadata=sizes))
    encoder = OneHotEncoder(inputCols=["__position"], outputCols=[output], dropLast=True).fit(joined)
    return encoder.transform(joined).drop("__category", "__position")


@dataclass(frozen=True)
class Scaler:
    """``(value - centre) / spread`` per column; a zero spread divides by one."""

    centre: dict[str, float]
    spread: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.centre)
        return df.withColumns({
            c: (known(df, c).cast("double") - F.lit(self.centre[c])) / F.lit(self.spread[c] or 1.0)
            for c in self.centre
        })

    def restore(self, column: Column, name: str) -> Column:
        """A scaled column back on its own scale."""
        return column * F.lit(self.spread[name] or 1.0) + F.lit(self.centre[name])

    def to_table(self, spark) -> DataFrame:
        rows = [(c, self.centre[c], self.spread[c]) for c in self.centre]
        return small_table(spark, rows, "column string, centre double, spread double")

    @staticmethod
    def from_table(table: DataFrame) -> "Scaler":
        rows = table.orderBy("column").collect()
        return Scaler({r["column"]: r["centre"] for r in rows}, {r["column"]: r["spread"] for r in rows})


def scaling_columns(df: DataFrame, target: str | None = None, include_target: bool = False) -> list[str]:
    """All numeric columns, one-hot flags included; the target only on request."""
    return numeric_columns(df, exclude=() if include_target or target is None else (target,))


def fit_scaler(
    df: DataFrame, columns: Sequence[str] | None = None, strategy: str = "standardization"
) -> Scaler:
    """Mean and population deviation, or minimum and range, from one aggregate."""
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    parts = []
    for i, name in enumerate(columns):
        c = known(df, name).cast("double")
        if strategy == "standardization":
            parts += [F.avg(c).alias(f"c{i}"), F.stddev_pop(c).alias(f"s{i}")]
        elif strategy == "normalization":
            parts += [F.min(c).alias(f"c{i}"), (F.max(c) - F.min(c)).alias(f"s{i}")]
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
    row = df.agg(*parts).first()
    empty = [c for i, c in enumerate(columns) if row[f"c{i}"] is None]
    if empty:
        raise ValueError(f"no known values in {empty}")
    return Scaler(
        {c: row[f"c{i}"] for i, c in enumerate(columns)}, {c: row[f"s{i}"] for i, c in enumerate(columns)}
    )


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The chosen features and the columns that travel with them (key, target)."""
    require_columns(df, [*features, *keep])
    return df.select(*[quoted(c) for c in [*keep, *features]])
