"""Token counts against a greedy splitter that builds the pieces."""

from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import token_count


def greedy(word: bytes, vocabulary: set[bytes]) -> int:
    at, count = 0, 0
    while at < len(word):
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in vocabulary), 0)
        if not size:
            return 1
        at, count = at + size, count + 1
    return count


def counted(words: list[bytes], vocabulary) -> list[int]:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return token_count.Automaton(vocabulary).count(data, ends - [len(w) for w in words], ends).tolist()


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("ab c", min_size=1, max_size=5), max_size=12), st.lists(st.text("abcd", min_size=1, max_size=12), min_size=1, max_size=8))
def test_any_vocabulary(tokens, words):
    vocabulary = {t.encode() for t in tokens}
    words = [w.encode() for w in words]
    assert counted(words, vocabulary) == [greedy(b" " + w, vocabulary) for w in words]


def test_all_documents(spark):
    vocabulary = token_count.read_ranks()
    known = set(vocabulary)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = {r.doc_id: r for r in token_count.count(docs).collect()}
    for r in docs.collect():
        words = [w for w in re.split("[\x20\x09-\x0d]+", r.text) if w]
        expected = sum(greedy(b" " + w.encode(), known) for w in words)
        assert (rows[r.doc_id].n_words, rows[r.doc_id].n_tokens, rows[r.doc_id].n_bytes) == (len(words), expected, len(r.text.encode()))


def test_edges(spark):
    df = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, " \n", 1), (4, "A" * 300_000, 1), (5, "aa ab", 1), (5, "aa ab", 1), (None, "zz", 1)],
        "doc_id long, text string, n_tokens int")
    rows = sorted(map(tuple, token_count.count(df, [b" a", b"a", b"b", b"A", b" "]).collect()), key=str)
    assert rows == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 2), (4, 1, 300_001, 300_000), (5, 2, 4, 5), (5, 2, 4, 5), (None, 1, 1, 2)], key=str)
    assert token_count.count(df.limit(0)).count() == 0
    assert {r.n_tokens for r in token_count.count(df, []).collect()} == {0, 1, 2}
