"""JSON reports: small tidy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row. Null fields are kept so that the schema survives."""
    report.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)
