"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "plumbline", memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a temporary
    folder. On a cluster a missing setting is an error, because a folder on
    one machine would be lost with it.
    """
    context = spark.sparkContext
    folder = (
        spark.conf.get(CHECKPOINT_KEY, None)
        or context.getConf().get(CHECKPOINT_KEY)
        or context.getCheckpointDir()
        or _local_folders.get(context.applicationId)
    )
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        folder = _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="run-"))
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_owners: list[list[str]] = []


def owned(path: str) -> str:
    """Hand a stored table to the innermost block of :func:`temporary_tables`, if there is one."""
    if _owners:
        _owners[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table through Spark's file systems."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, when the block ends, the intermediate tables that operators stored inside it.

    Take results inside the block: they are read from these tables. Without a block the tables stay
    in the shared folder until it is cleared.
    """
    _owners.append([])
    try:
        yield
    finally:
        for path in _owners.pop():
            delete_path(spark, path)


def materialize(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once: write it below the shared folder and read it back.

    The lineage ends at a stored table, so lost executors cost no recomputation,
    and later reads prune columns and partitions.
    """
    path = owned(scratch_path(df.sparkSession, "table"))
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
