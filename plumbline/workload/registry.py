"""Named queries over the test tables, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, places: int | dict[str, int], columns: Iterable[str] | None = None) -> DataFrame:
    """Round the double columns: aggregates of two engines agree to about 14 digits only."""
    digits = places if isinstance(places, dict) else {
        c: places for c, t in df.dtypes if t == "double" and (columns is None or c in columns)
    }
    # + 0.0 turns a rounded -0.0 into 0.0
    return df.withColumns({c: F.round(quoted(c), d) + F.lit(0.0) for c, d in digits.items()})


def union_sql(parts: Iterable[str]) -> str:
    return "\nUNION ALL\n".join(parts)
