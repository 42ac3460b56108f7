"""Benchmark matches against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from plumbline.llm import decontaminate


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items, window=13):
    result = []
    for doc_id, text in docs:
        words, hit, names, longest = words_of(text), set(), set(), 0
        for item, item_text in items:
            own = words_of(item_text)
            size = min(window, len(own))
            if not own:
                continue
            for j in range(len(own) - size + 1):
                for i in range(len(words) - size + 1):
                    if words[i : i + size] == own[j : j + size]:
                        hit |= set(range(i, i + size))
                        names.add("" if item is None else str(item))
                        n = size
                        while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                            n += 1
                        longest = max(longest, n)
        result.append((doc_id, len(words), len(hit), sorted(names), longest))
    return result


def found(docs, items, **options):
    return [(r.doc_id, r.n_words, r.n_hit, r["items"], r.longest) for r in decontaminate.find(docs, items, **options).collect()]


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(40)}" for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice((13, 20, 45))))) for i in range(12)]
    items += [(100, "just these five words here"), (101, "w1 W2"), (102, ""), (103, None), (None, "no name but words"), (7, " ".join(prose(15))),
              (104, "a a a a a a a a a a a a a a a a")]
    docs = []
    for i in range(80):
        text = prose(rng.randrange(60))
        for _ in range(rng.randrange(3)):
            own = words_of(rng.choice(items)[1])
            begin = rng.randrange(max(len(own), 1))
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() for w in own[begin : begin + rng.randrange(1, 40)]]
        docs.append((i, ", ".join(text)))
    docs += [(200, None), (201, ""), (202, "..., !"), (203, "a " * 300), (None, "Just THESE five words, here"), (5, docs[5][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_planted_passages(spark, planted, block_bytes):
    docs, items = planted
    got = found(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n_words int, hit string").repartition(3),
        spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int"), block_bytes=block_bytes)
    assert sorted(got, key=str) == sorted(brute(docs, items), key=str)
    assert any(r[2] for r in got)


def test_digest_and_rows_kept(spark, planted):
    docs, items = planted
    df = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {(r.doc_id, r.n_words): r for r in decontaminate.digest(decontaminate.find(df, bench)).collect()}
    clean = []
    for doc_id, n_words, n_hit, names, _ in brute(docs, items):
        r = rows[doc_id, n_words]
        assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest() and r.n_items == len(names)
        assert r.contaminated == (n_hit > 0 and 20 * n_hit >= n_words)
        clean += [doc_id] * (not r.contaminated)
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, clean))


def test_empty_tables_and_one_long_text(spark):
    docs = spark.createDataFrame([(1, "x y z " * 100_000 + "alpha beta gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "alpha beta gamma")], "item_id long, text string")
    assert found(docs, items) == [(1, 300_003, 3, ["9"], 3)]
    assert found(docs, items.limit(0)) == [(1, 300_003, 0, [], 0)]
    assert found(docs.limit(0), items) == []
