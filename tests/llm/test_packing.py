"""Packing: exact round trip against the public tokenizer."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = packing.Encoder()


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\u00a0\u3000\x0b\x1c'sabcÉ1.<|>", max_size=30) | st.text(max_size=20), max_size=6))
def test_ids_equal_those_of_the_tokenizer(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts] + ["a  b", "x <|endoftext|> y", " ", "  ", "don't  stop \n ", ""]
    ids, counts = ENCODER.encode(pa.array(texts, pa.string()), 1)
    assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == ids_of(texts[0]) + [1]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [ids_of(t) + [1] for t in texts]


def test_cut_lengths():
    assert packing.cut_lengths(1, 2048) == [1]
    assert packing.cut_lengths(2048 * 2 + 5, 2048) == [2048, 2048, 4, 1]
    for n in range(1, 5000, 7):
        cut = packing.cut_lengths(n, 1024)
        assert sum(cut) == n and sorted(cut, reverse=True) == cut


def rebuilt(rows):
    docs = {}
    for r in sorted(rows, key=lambda r: r.start):
        whole = docs.setdefault(r.doc_id, [])
        assert r.start == len(whole) and r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length == 1 << r.bucket
        whole += ids
    return docs


def test_all_documents_round_trip(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cut = packing.pieces(docs).cache()
    rows = cut.collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    whole = rebuilt(rows)
    assert whole == {r.doc_id: ids_of(r.text) + [1] for r in docs.collect()}
    assert all(r.doc_tokens == len(whole[r.doc_id]) for r in rows)
    sums = {(r.doc_id, r.start): r.ids_crc32 for r in packing.digest(cut).collect()}
    assert sums == {(r.doc_id, r.start): zlib.crc32(r.ids) for r in rows}
    packing.write_buckets(cut.select("doc_id", "ids", "bucket"), f"{tmp_path}/buckets")
    assert spark.read.parquet(f"{tmp_path}/buckets").count() == len(rows)


def test_edges(spark):
    texts = [None, "", " ", "a  b\n \n c", "word " * 30_000, "\u3000 \u3000 x", "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, start string")
    assert rebuilt(packing.pieces(df).collect()) == {i: ids_of(t) + [1] for i, t in enumerate(texts)}
    twice = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.length) for r in packing.pieces(twice).collect()) == [
        (0, 2), *[(1, n) for n in sorted(packing.cut_lengths(len(ids_of("one two")) + 1, 2048) * 2)]]
    assert packing.pieces(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(df, longest=1000)
