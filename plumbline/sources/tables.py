"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.columns import nan_to_null, quoted, require_columns
from plumbline.operators.clean import cast_types, narrow_types


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    categorical_columns: Sequence[str] = (),
    narrow: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header. A missing path raises Spark's AnalysisException.

    Give a schema for known sources: without one the file is read twice.
    """
    reader = spark.read.options(header=True, **options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = nan_to_null(reader.csv(path))
    df = cast_types(df, {c: "string" for c in categorical_columns})
    return narrow_types(df) if narrow else df


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    nan_as_null: bool = False,
) -> DataFrame:
    """A table from a path in the given format.

    All operators read NaN as missing, so it is replaced here only on request:
    a replaced column cannot be filtered inside the Parquet scan any more.
    """
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.format(fmt).load(path)
    return nan_to_null(df) if nan_as_null else df


def load_training(
    spark: SparkSession, path: str, target: str, features: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A train or test table with its target; fails if the target is absent."""
    return features_and_target(load_table(spark, path, fmt), target, features)


def features_and_target(df: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """Features and target side by side in one frame, the target as ``label``."""
    chosen = list(features) if features is not None else [c for c in df.columns if c != target]
    require_columns(df, [target, *chosen])
    return df.select(*[quoted(c) for c in chosen], quoted(target).alias("label"))


def dataset_metadata(df: DataFrame, target: str) -> DataFrame:
    """One row: number of features, their names and number of rows."""
    require_columns(df, [target])
    names = [c for c in df.columns if c != target]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(len(names)).alias("n_features"),
        F.array(*[F.lit(c) for c in names]).cast("array<string>").alias("feature_names"),
        "n_rows",
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def versioned_path(folder: str, name: str, version: int, stage: str = "processed") -> str:
    return f"{folder}/{name}_{stage}_v{version}"


def write_processed(df: DataFrame, folder: str, name: str, version: int) -> str:
    """Store a prepared split under its version and return the path."""
    path = versioned_path(folder, name, version)
    df.write.mode("overwrite").parquet(path)
    return path


def write_splits(labelled: DataFrame, folder: str, version: int) -> str:
    """Store raw splits as one table partitioned by ``split``: one pass for all parts."""
    path = versioned_path(folder, "splits", version, "raw")
    labelled.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One part of a stored split; the other partitions are not read."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")
