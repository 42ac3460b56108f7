"""Column selectors, missing-value rules and small reshaping helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def quoted(name: str) -> Column:
    """Column by its literal name, even if it has dots, blanks or ampersands."""
    return F.col("`" + name.replace("`", "``") + "`")


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing."""
    column = quoted(name)
    return F.nanvl(column, F.lit(None).cast(df.schema[name].dataType)) if is_floating(df, name) else column


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace NaN by NULL so that every later aggregate skips it."""
    names = [c for c in (columns or df.columns) if is_floating(df, c)]
    return df.withColumns({c: known(df, c) for c in names}) if names else df


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in table: {absent}")


def rows_from(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One output row per struct, for each row of ``df``."""
    return df.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def labelled(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


_ARROW_TYPES = {
    "string": pa.string(),
    "double": pa.float64(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
    "timestamp": pa.timestamp("us", tz="UTC"),
    "array<string>": pa.list_(pa.string()),
}


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A DataFrame of a few rows that sits in the plan itself, without a job or Python workers.

    ``schema`` is a flat DDL string such as ``"column string, n bigint"``.
    """
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    arrays = [pa.array([r[i] for r in rows], _ARROW_TYPES[t]) for i, (_, t) in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=[n for n, _ in fields]))
