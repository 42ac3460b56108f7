"""Two-pass shuffle: whole, even, repeatable and random."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from plumbline.llm import sharding


def checked(df, n, shards=16, **options):
    rows = sharding.shuffle(df, shards=shards, **options).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert 0 <= r.shard < shards
        text = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    assert len(rows) == n and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    return rows


def test_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = checked(docs, 1000, bucket_bytes=100_000)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    place = {r.doc_id: (r.shard, r.slot) for r in rows}
    again = checked(docs.repartition(7), 1000, bucket_bytes=100_000)
    assert place == {r.doc_id: (r.shard, r.slot) for r in again}
    other = checked(docs, 1000, bucket_bytes=100_000, seed=2)
    assert sum(place[r.doc_id] == (r.shard, r.slot) for r in other) < 20
    # Ids and places are not related: the rank correlation of 1000 pairs is small.
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(sum((i - 499.5) * (d - 499.5) for i, d in enumerate(order))) / (1000 * 999 * 1001 / 12) < 0.12
    sharding.write_shards(sharding.shuffle(docs), f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 1000


def test_copies_of_one_row_are_scattered(spark):
    df = spark.createDataFrame([(1, "copy " * 20)] * 600 + [(i, f"text {i}") for i in range(2, 302)], "doc_id long, text string").repartition(5)
    rows = checked(df, 900, shards=9, bucket_bytes=4000)
    share = Counter(r.shard for r in rows if r.doc_id == 1)
    assert all(40 <= share[i] <= 95 for i in range(9))


def test_edges(spark):
    df = spark.createDataFrame(
        [(None, None, 1), (None, "x", 2), (3, "", 3), (3, None, 3), (4, "é" * 100_000, 4)], "doc_id long, text string, size int").withColumn("a.b", F.lit(1))
    rows = checked(df, 5)
    assert Counter(str(r.doc_id) for r in rows) == {"None": 2, "3": 2, "4": 1}
    assert sharding.shuffle(df.limit(0)).count() == 0
    assert sharding.digest(sharding.shuffle(df)).columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding._fisher_yates(4, s)) for s in range(24_000))
    assert len(seen) == 24 and max(seen.values()) < 1.2 * 1000 and min(seen.values()) > 0.8 * 1000


def test_columns_of_the_caller_stay(spark):
    df = spark.createDataFrame([(i, f"t {i % 3}", i, -i, str(i), 0) for i in range(30)] * 2,
                               "doc_id long, text string, copy int, bucket int, Place string, mark int")
    got = sharding.shuffle(df, shards=4)
    assert got.columns == [*df.columns, "size", "text_crc32", "shard", "slot"]
    assert sorted(map(tuple, got.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
