"""Model registry: an append-only table of one small file per entry, and the promotion gate."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators.training import load_model
from plumbline.session import delete_path

SCHEMA = (
    "name string, version bigint, sequence bigint, promoted boolean, model_type string, rmse double, "
    "uri string, feature_names array<string>, registered_at timestamp"
)
# Least improvement, in percent of the champion's error, that promotes a challenger.
THRESHOLD = 0.1


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return small_table(spark, [], SCHEMA)


def register(
    spark: SparkSession,
    path: str,
    name: str,
    model_type: str,
    rmse: float,
    uri: str,
    features: Sequence[str] = (),
    promoted: bool = True,
) -> int:
    """Append the next version of ``name``; the registry holds one row per version.

    Writers may run at the same time. An entry is the file of its sequence number, which appears whole and only if
    no other writer was first; a writer that comes late reads the registry again. So sequences have no gaps,
    every entry has seen all earlier ones, and versions neither repeat nor leave one out, also after a lost writer.
    """
    while True:
        last = read_registry(spark, path).agg(
            F.max(F.when(F.col("name") == name, F.col("version"))).alias("v"), F.max("sequence").alias("s")
        ).first()
        version, sequence = (last["v"] or 0) + 1, (last["s"] or 0) + 1
        entry = {
            "name": name, "version": version, "sequence": sequence, "promoted": promoted, "model_type": model_type,
            "rmse": rmse, "uri": uri, "feature_names": list(features),
            "registered_at": datetime.datetime.now(datetime.timezone.utc).isoformat(),
        }
        if _publish(spark, path, f"entry-{sequence:012d}.json", json.dumps(entry) + "\n"):
            return version


def _publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Let a file with its whole text appear, unless there is one of this name; False if there is.

    The file system must rename, or on local disks link, in one step and never onto a file that exists, as HDFS does.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder, name)
    files = target.getFileSystem(conf)
    draft = hadoop.Path(folder, f".draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        if files.getScheme() == "file":
            # A rename on a local disk replaces what is there; a link doesn't.
            places = [jvm.java.nio.file.Path.of(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)) for p in (target, draft)]
            jvm.java.nio.file.Files.createLink(*places)
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            hadoop.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        delete_path(spark, draft.toString())
    return True


def with_alias(registry: DataFrame, alias: str = "production") -> DataFrame:
    """The registry with the alias on its latest promoted row."""
    latest = F.max(F.when(F.col("promoted"), F.col("sequence"))).over(Window.partitionBy(F.lit(1)))
    return registry.withColumn("alias", F.when(F.col("sequence") == latest, F.lit(alias)))


def champion(registry: DataFrame) -> DataFrame:
    """At most one row: the promoted model in use."""
    return registry.where("promoted").orderBy(F.desc("sequence")).limit(1)


def load_champion(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    row = champion(read_registry(spark, path)).first()
    if row is None:
        raise LookupError("no promoted model")
    return load_model(row["uri"]), row.asDict()


def gate(errors: DataFrame, champion: str, challenger: str, threshold: float = THRESHOLD) -> DataFrame:
    """Decide from (model, rmse) rows whether the challenger replaces the champion.

    Without a champion row the challenger is promoted.
    """
    wide = errors.agg(
        F.max(F.when(F.col("model") == champion, F.col("rmse"))).alias("champion_rmse"),
        F.max(F.when(F.col("model") == challenger, F.col("rmse"))).alias("challenger_rmse"),
    )
    improvement = F.try_divide(
        (F.col("champion_rmse") - F.col("challenger_rmse")) * 100.0, F.col("champion_rmse")
    )
    return wide.withColumn("improvement_percent", improvement).withColumn(
        "promote",
        F.col("champion_rmse").isNull() | F.coalesce(F.col("improvement_percent") >= threshold, F.lit(False)),
    )


def model_info(registry: DataFrame) -> DataFrame:
    """Name, version, alias, location and features of the model in use."""
    return with_alias(registry).where(F.col("alias").isNotNull()).select(
        "name",
        "version",
        "alias",
        "uri",
        "model_type",
        "feature_names",
        F.size("feature_names").alias("n_features"),
    )
