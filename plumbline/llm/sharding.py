"""Global shuffle in two passes over external buckets.

The first pass scatters records over buckets of a size that fits in memory, by a
seeded hash of the whole record. The second reads one bucket at a time, puts it in
an order that does not depend on how it arrived, applies a seeded Fisher-Yates shuffle
and writes it. The buckets one after another are a uniform random order of all
records, and it is cut into shards of equal length: the counts of two shards
differ by one at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import quoted
from plumbline.llm.stored import Stored

#: Bytes of text in a bucket, on average.
BUCKET_BYTES = 16 << 20
#: Buckets whose counts are summed in one task.
GROUP = 4096


def _fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of ``n`` places: the j-th swap draws among the places not yet fixed."""
    order = list(range(n))
    draws = np.random.Generator(np.random.PCG64(seed)).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _shuffle_buckets(seed: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if parts:
                table = pa.Table.from_batches(parts)
                order = _fisher_yates(table.num_rows, (seed << 32) + current)
                for begin in range(0, len(order), 4096):
                    some = order[begin : begin + 4096]
                    out = table.take(pa.array(some))
                    out = out.append_column("place", pa.array(np.arange(begin, begin + len(some))))
                    yield from out.select([*columns, "bucket", "place"]).combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(bucket)]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if bucket[begin] != current:
                    yield from close()
                    current, parts = int(bucket[begin]), []
                parts.append(batch.slice(begin, end - begin))
        yield from close()

    return run


def shuffle(
    docs: DataFrame, shards: int = 16, seed: int = 1, id_col: str = "doc_id", text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All columns of ``docs`` in random order, with (size, text_crc32, shard, slot).

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` its checksum; a null text
    has no bytes. ``slot`` counts from 0 inside a shard, ``shard`` from 0 to ``shards - 1``,
    and the same rows and seed give the same order, however the rows are partitioned.

    Rows that repeat with equal id and text are told apart by a count, so that copies
    of one row, however many, are scattered like any others; which of them gets which
    slot is open where their other columns differ. Null ids and texts are values like others.
    An empty table gives no rows. Columns named ``size``, ``text_crc32``, ``shard`` or ``slot`` are
    replaced; all others stay, whatever their names.
    """
    spark = docs.sparkSession
    stored = Stored(spark)
    made = ["size", "text_crc32", "shard", "slot"]
    kept = [c for c in docs.columns if c.lower() not in made]
    # Plain names inside, because columns may have any names.
    columns = [f"c{i}" for i in range(len(kept))]
    place_of = {c.lower(): f"c{i}" for i, c in enumerate(kept)}
    text = F.coalesce(F.col(place_of[text_col.lower()]).cast("string"), F.lit(""))
    records = docs.select(*(quoted(c).alias(p) for c, p in zip(kept, columns))).select(
        *columns, (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    key = [F.col(place_of[id_col.lower()]), F.col("size"), F.col("text_crc32")]
    counted = stored.table(
        records.groupBy(F.xxhash64(F.lit(seed), *key).alias("mark")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")))
    total, most = counted.agg(F.sum("bytes"), F.max("n")).first()
    buckets = int((total or 0) // bucket_bytes) + 1

    marked = records.withColumn("mark", F.xxhash64(F.lit(seed), *key))
    if (most or 0) > 1:
        repeated = counted.filter("n > 1").select("mark", "n")
        # Rows of one mark are spread over partitions at random; a number drawn for each
        # from its place would change if a task ran again, so they are stored with it.
        spread = stored.table(marked.join(repeated.select("mark"), "mark", "left_semi").withColumn("copy", F.monotonically_increasing_id()))
        single = marked.join(repeated.select("mark"), "mark", "left_anti").withColumn("copy", F.lit(0).cast("long"))
        marked = single.unionByName(spread)
    else:
        marked = marked.withColumn("copy", F.lit(0).cast("long"))
    scattered = marked.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "mark", "copy"), F.lit(buckets)).cast("int"))
    own = [*columns, "size", "text_crc32"]
    ordered = (
        scattered.repartition(F.col("bucket")).sortWithinPartitions("bucket", F.xxhash64(F.lit(seed + 2), "mark", "copy"), "mark", "copy")
        .select(*own, "bucket")
    )
    schema = T.StructType([*ordered.schema.fields, T.StructField("place", T.LongType())])
    written = stored.table(ordered.mapInArrow(_shuffle_buckets(seed, own), schema), keep=True)

    counts = written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.floor(F.col("bucket") / GROUP))
    inside = counts.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("bucket")) - F.col("n"))
    parts = counts.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.withColumn("earlier", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    rows = written.count()
    starts = inside.join(parts, "part").select("bucket", (F.col("before") + F.col("earlier")).alias("first"))
    low, more = divmod(rows, shards)
    # The first shards have one record more than the others.
    edge = more * (low + 1)
    at = F.col("first") + F.col("place")
    if low:
        later = F.floor((at - edge) / low)
        shard = F.when(at < edge, F.floor(at / (low + 1))).otherwise(later + more)
        slot = F.when(at < edge, at % (low + 1)).otherwise((at - edge) % low)
    else:
        shard, slot = at, F.lit(0)
    stored.close()
    return written.join(starts, "bucket").select(
        *(F.col(p).alias(c) for c, p in zip(kept, columns)), "size", "text_crc32", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in slot order within each file."""
    shuffled.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(shuffled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return shuffled.select(
        F.col(f"`{id_col}`").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
