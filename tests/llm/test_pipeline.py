"""The corpus pipeline stage by stage, against brute force on planted cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from plumbline.llm import langid, packing
from plumbline.llm.queries import ORACLES, QUERIES
from plumbline.workload import QUERIES as OTHERS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents with planted copies, contaminated texts and texts without a language."""
    rng = random.Random(11)
    base = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(80).collect()]
    rows = [tuple(r) for r in base]
    items = [(i, " ".join(f"q{rng.randrange(10**6)}x" for _ in range(30))) for i in range(5)]
    words = base[7].text.split()
    near = " ".join([*words[:-1], "changed"])
    rows += [(1000, base[3].text, "en", "s", 1), (1001, near, "en", "s", 1), (1002, None, None, None, None), (1003, "12 34 !!", "en", "s", 1),
             (1004, "the and that with " + items[2][1], "en", "s", 1), (1005, "the and that with of " * 400 + items[3][1], "en", "s", 1)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_keep_columns_and_drop_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns and [f.dataType for f in result.schema] == [f.dataType for f in docs.schema]
            path = f"{folder}/out-{name}"
            result.write.parquet(path)
            docs = spark.read.parquet(path)
            seen[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "benchmark_decontamination", "packing"]
    assert not {1002, 1003} & seen["language_id"] and {1000, 1001, 1004, 1005, 0, 1, 2, 3} <= seen["language_id"]
    assert not {1000, 1001} & seen["minhash_near_dedup"] and {3, 7, 1004, 1005} <= seen["minhash_near_dedup"]
    # A twentieth of the words counts: the long text keeps its passage.
    gone = seen["minhash_near_dedup"] - seen["benchmark_decontamination"]
    assert gone == {1004}


def test_run_gives_the_pieces_of_what_is_left(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    left = {r.doc_id for r in rows}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    encoder = packing.Encoder()
    for doc in sorted(left)[:20]:
        ids, _ = encoder.encode(pa.array([texts[doc]], pa.string()), packing.END_ID)
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert [r.ids_crc32 for r in own] == [
            zlib.crc32(np.asarray(ids[r.start : r.start + r.length], "<u4").tobytes()) for r in own]


def test_empty_documents(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_survive(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as node", "'x' as `Component.id`", "2 as n_words", "3 as row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-4:] == ["node", "Component.id", "n_words", "row"], name
    assert docs.filter("node = 1 and n_words = 2 and row = 3").count() == docs.count() > 50


def test_names_and_queries():
    numbers = sorted(int(n.split("_")[0][2:]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES) and not set(QUERIES) & set(OTHERS)
    assert langid.UNKNOWN == "und"
