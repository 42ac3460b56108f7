"""What an operator shares with its tasks: stored tables and broadcast objects."""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from plumbline.session import delete_path, owned, scratch_path


#: Rows that travel between Spark and a Python worker at once, where rows hold whole texts.
TEXT_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``TEXT_ROWS`` rows.

    The default of 10,000 rows is made for numbers; with texts of some kilobytes each batch takes
    tens of megabytes in the executor and again in its Python worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def share(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast an object of this package to workers that may not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast: Broadcast) -> Any:
    return pickle.loads(broadcast.value)


class Stored:
    """Writes intermediate tables and removes those that are no longer read.

    A stored table ends the lineage: a lost executor costs no recomputation of
    what came before it. ``close`` removes all tables that were not handed out
    with ``keep``; those go with the block of ``session.temporary_tables`` around them, or
    else stay until the cluster clears its shared folder.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def path(self, name: str, keep: bool = False) -> str:
        """A new path in the shared folder."""
        path = scratch_path(self.spark, name)
        if keep:
            owned(path)
        else:
            self._paths.append(path)
        return path

    def table(self, df: DataFrame, keep: bool = False, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
        """``df``, stored; ``codec`` packs it other than the session does (zstd for long texts)."""
        path = self.path("table", keep)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        (writer.option("compression", codec) if codec else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        for path in self._paths:
            delete_path(self.spark, path)
        self._paths = []
