"""Scoring of records as they arrive. Stateless, so no watermark is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plumbline.functions.columns import quoted
from plumbline.operators.scoring import Scorer


def read_records(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Parquet files of a folder as a stream; new files are picked up in later triggers."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def score_stream(records: DataFrame, scorer: Scorer, keep: Sequence[str]) -> DataFrame:
    return scorer.score(records, keep)


def write_scores(scores: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append scores to a Parquet table.

    The file sink and the checkpoint give each record exactly once, also after
    a restart. ``once`` handles what is there and stops.
    """
    writer = scores.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


RESPONSE = ("predicted_price", "currency", "model_version", "prediction_timestamp", "confidence_interval")
REASONS = "violations"


def quarantine_batch(
    batch: DataFrame, batch_id: int, scorer: Scorer, keep: Sequence[str], scores: str, rejected: str
) -> None:
    """Write one batch: priced records to ``scores``; broken ones, as they came and with their violations, to ``rejected``.

    Each batch has a folder of its own, replaced when the batch runs again, so a batch that was cut off anywhere
    between the two writes leaves each record once.
    """
    clashing = sorted({*RESPONSE, REASONS, "valid", "batch"} & set(batch.columns))
    if clashing:
        raise ValueError(f"records must not have the columns {clashing}")
    # Scored once for both tables; a lost executor only costs its part of the batch.
    scored = scorer.score(batch, batch.columns).persist()
    try:
        good = scored.where("valid").select(*[quoted(c) for c in keep], *RESPONSE)
        bad = scored.where("NOT valid").select(*[quoted(c) for c in batch.columns], REASONS)
        for table, path in ((good, scores), (bad, rejected)):
            table.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    finally:
        scored.unpersist()


def write_checked(
    records: DataFrame, scorer: Scorer, keep: Sequence[str], scores: str, rejected: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Score arriving records into two tables, one of prices and one of rejected records that wait for repair.

    Every record is in exactly one of them, also after a restart: the checkpoint fixes which records a batch has.
    Both tables have the number of the batch as the partition column ``batch``.
    """
    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: quarantine_batch(batch, batch_id, scorer, keep, scores, rejected)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()
