"""Near duplicates against brute force over all pairs of sets."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import near_dup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, width=3, percent=85):
    """(n_shingles, component) of each id by an inverted index."""
    sets = {}
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
        runs = [tuple(words)] if 0 < len(words) < width else zip(*(words[i:] for i in range(width)))
        sets[doc_id] = frozenset(runs)
    by_set = defaultdict(list)
    for doc_id, own in sets.items():
        by_set[own].append(doc_id)
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def tie(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    holders = defaultdict(list)
    for own, ids in by_set.items():
        if own:
            for other in ids[1:]:
                tie(ids[0], other)
            for run in own:
                holders[run].append(own)
    for own, ids in by_set.items():
        met = {other for run in own for other in holders[run] if other is not own}
        for other in met:
            shared = len(own & other)
            if 100 * shared >= percent * (len(own) + len(other) - shared):
                tie(ids[0], by_set[other][0])
    return {i: (len(own), find(i)) for i, own in sets.items()}


def result(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.link(df, **options).collect()}


def prose(rng, n, words=300):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def test_families_chains_and_copies(spark, monkeypatch):
    """Chains without a centre, edited copies, exact copies; blocks and salts of the smallest size."""
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 4)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 20_000)
    rng, rows = random.Random(7), []
    for family in range(4):
        text = prose(rng, 220)
        for _ in range(40):  # every text is an edit of the one before it
            rows.append(" ".join(text))
            for _ in range(rng.choice((1, 2, 4, 9))):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
    base = prose(rng, 150)
    for _ in range(30):  # edits of one text that are further from each other than from it
        copy = list(base)
        for _ in range(rng.choice((2, 3, 4, 8))):
            copy[rng.randrange(len(copy))] = f"y{rng.randrange(10**6)}"
        rows.append(" ".join(copy))
    rows += [" ".join(base)] * 20 + [" ".join(base).upper() + "\n"] + [" ".join(prose(rng, 80)) for _ in range(60)]
    rng.shuffle(rows)
    table = list(enumerate(rows))
    got = result(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in table], SCHEMA).repartition(5))
    expected = brute(table)
    assert {i: v[:2] for i, v in got.items()} == expected
    assert all(v[2] == (v[1] == i) for i, v in got.items())


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Two one"), (8, "one  two\n"),
            (9, "a b c"), (10, "a b c a b c"), (11, "a b c"), (12, "a " * 200_000), (13, "A " * 90_000 + "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as node", "'x' as sig", "doc_id as rep")
    got = result(df)
    assert {i: v[:2] for i, v in got.items()} == brute(rows)
    assert got[12][1] == got[13][1] == 12 and got[2] == (0, 2, True)


def test_repeated_rows_null_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(3, "p q r s"), (3, "p q r s"), (5, "p q r s"), (None, "p q r s"), (None, "z z y y x"), (None, None)], schema)
    rows = sorted(map(tuple, near_dup.link(df).collect()), key=str)
    assert rows == sorted([(3, 2, 3, True), (3, 2, 3, True), (5, 2, 3, False), (None, 2, 3, False), (None, 3, None, True),
                           (None, 0, None, True)], key=str)
    assert near_dup.link(df.limit(0)).count() == 0


def test_all_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {i: v[:2] for i, v in result(docs).items()} == expected


def test_five_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], width=5, percent=90)
    assert {i: v[:2] for i, v in result(docs, width=5, percent=90).items()} == expected
    with pytest.raises(ValueError):
        near_dup.link(docs, percent=50)


def test_drop_duplicates_keeps_one_row_of_each_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = near_dup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], width=5, percent=80)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in expected.items() if c == i)
    odd = spark.createDataFrame(
        [(1, "a b c d e f", 1), (1, "a b c d e f", 1), (2, "a b c d e f", 1), (None, "a b c d e f", 1), (None, "x y", 1),
         (None, "x y", 2), (None, None, 3), (4, None, 4), (5, None, 4)], "doc_id long, text string, gone int")
    rows = sorted(((r.doc_id, r.text) for r in near_dup.drop_duplicates(odd).collect()), key=str)
    assert rows == sorted([(1, "a b c d e f"), (None, "x y"), (None, None), (4, None), (5, None)], key=str)


def test_distances_follow_the_similarity():
    assert near_dup._Scheme(85).distance == 23 and len(near_dup._Scheme(85).chunks) == 12
    for percent in (60, 80, 85, 95, 100):
        scheme = near_dup._Scheme(percent)
        assert 2 * len(scheme.chunks) > scheme.distance


def test_full_sets_alone_decide(spark):
    def cell(values):
        return np.array(values, np.uint64).tobytes()

    far = [bytes([i]) * 512 for i in range(4)]
    held = [(0, cell(range(100)), far[0], 0), (1, cell(range(85)), far[1], 0), (2, cell(range(84)), far[2], 0), (3, cell(range(200)), far[3], 0)]
    sets = spark.createDataFrame(held, "node long, set binary, fine binary, spot int")
    requests = spark.createDataFrame([(0, 0, [1, 2, 3])], "a long, block int, others array<long>")
    assert [(r.a, r.b) for r in near_dup._confirm(requests, sets, 1, near_dup._Scheme(85)).collect()] == [(0, 1)]


def test_rows_of_one_id_are_judged_by_their_own_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (5, a), (5, b), (5, b), (5, b + " more"), (6, b), (7, ""), (7, None), (8, "c " * 9), (None, a), (None, "d e f g h i")]
    kept = near_dup.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
    assert [r for r in found if r[0] != 5] == [(1, a), (7, ""), (8, "c " * 9), (None, "d e f g h i")]
    # One of the three rows of id 5 in the group of b; its copy of a goes with row 1.
    assert len([r for r in found if r[0] == 5]) == 1 and all(r[1].startswith(b) for r in found if r[0] == 5)


def test_sets_of_a_family_are_sent_once(spark, monkeypatch):
    """All texts of a family ask for each other; a family beyond the bytes of a home is cut, and only then are sets copied."""
    rows = [(10 * family + i, int(i == 0)) for family in range(12) for i in range(8)]
    members = spark.createDataFrame([(n - n % 10, n, n - n % 10) for n, _ in rows], "key long, node long, least long")
    groups = spark.createDataFrame([(n, n, 100, b"") for n, _ in rows], "node long, doc_id long, n_shingles long, sig binary")
    sets = [(n, np.arange(n % 10, 100 + n % 10, dtype=np.uint64).tobytes()) for n, _ in rows]
    for limit, cut in ((1 << 20, False), (1600, True)):
        monkeypatch.setattr(near_dup, "BLOCK_BYTES", limit)
        stored = near_dup.Stored(spark)
        homes = {r.node: r.spot for r in near_dup._homes(members, groups, stored).collect()}
        stored.close()
        assert len(homes) == len(rows) and (len(set(homes.values())) > 12) == cut
        held = spark.createDataFrame([(n, s, homes[n]) for n, s in sets], "node long, set binary, spot long")
        asked = [(n, homes[n], homes[n - n % 10], [n - n % 10]) for n, first in rows if not first]
        requests = spark.createDataFrame(asked, "a long, own long, block long, others array<long>")
        sent = near_dup._sent(requests, held, near_dup.HOMES).filter("set is not null").groupBy("node", "block").count().collect()
        assert all(r["count"] == 1 for r in sent)
        away = sum(own != block for _, own, block, _ in asked)
        assert (away > 0) == cut and len(sent) <= len(rows) + away
        found = {(r.a, r.b) for r in near_dup._confirm(requests, held, near_dup.HOMES, near_dup._Scheme(85)).collect()}
        assert found == {(n, n - n % 10) for n, first in rows if not first}


def test_links_that_meet_in_a_task_settle_in_one_round(spark, monkeypatch):
    """A path of 60 links, all in one partition, and the same path dealt over three, take the same components."""
    path = [(i + 1, i) if i % 2 else (i, i + 1) for i in range(60)] + [(100, 101), (101, 101)]
    links = spark.createDataFrame(path, "a long, b long")
    tables = []
    table = near_dup.Stored.table
    monkeypatch.setattr(near_dup.Stored, "table", lambda self, *a, **k: tables.append(1) or table(self, *a, **k))
    expected = {i: 0 for i in range(61)} | {100: 100, 101: 100}
    for parts in (1, 3):
        tables.clear()
        stored = near_dup.Stored(spark)
        found = near_dup.components(links.repartition(parts), stored).collect()
        stored.close()
        assert len(found) == len(expected) and {r.node: r.component for r in found} == expected
        assert parts > 1 or len(tables) == 2
