"""The prefix trie against a plain one, and its helpers on pieces of every size."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import prefix_trie, spread
from plumbline.llm.stored import Stored

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(sequences):
    """Nodes of {conversation: [(role, text)]}, by walking."""
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    found = []
    for k, own in members.items():
        below = [x for x in members if x[: len(k)] == k]
        children = [x for x in below if len(x) == len(k) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        names = ",".join(map(str, sorted(ends.get(k, []))))
        found.append((min(own), len(k), min(members[k[:-1]]) if k else None, len(own), len(children), len(leaves), saved,
                      hashlib.sha256(names.encode()).hexdigest()))
    return sorted(found, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def tables(spark, seed, hot):
    rng = random.Random(seed)
    rows, sequences = [], {}
    for c in [*range(0, 30), *range(100, 130), 305, 306, -7, 10**12]:
        turns = []
        for i in range(rng.choice([1, 2, 3, 5, 6, 11, 70 if c == 7 else 4])):
            common = rng.random() < (0.9 if c % 3 == 0 and hot else 0.5)
            turns.append((rng.choice([None, "user"]) if i % 2 else "user", f"t{i % 3}é😀" if common else rng.choice([None, "", f"x{c % 4} {i}"])))
        rows += [(c, i * 2 if i or c % 2 else None, r, t, 1.0, c) for i, (r, t) in enumerate(turns)]
        sequences[c] = [(r or "", t or "") for r, t in turns]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows + [(None, 1, "user", "lost", 1.0, 1)], "conv_id long, turn long, role string, text string, depth double, `n_convs` long")
    return df.repartition(5), sequences


@pytest.mark.parametrize("hot", [False, True])
def test_trie_equals_a_plain_one(spark, hot):
    df, sequences = tables(spark, 3 + hot, hot)
    assert rows_of(prefix_trie.trie(df)) == plain(sequences)


def test_rebuilt_conversations_and_block_sizes(spark):
    df, own = tables(spark, 9, True)
    sequences = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - c % 100 if c >= 0 else 0
        sequences[c] = own.get(base, [])[:h] + turns[h:]
    assert any(not s for s in sequences.values())
    assert rows_of(prefix_trie.rebuilt_trie(df)) == plain(sequences)
    stored = Stored(spark)
    ids, turns = prefix_trie.rebuilt(df, stored)
    for block in (1, 3):
        assert rows_of(prefix_trie.nodes(ids, turns, stored, block)) == plain(sequences)


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], schema)).count() == 0
    # Repeated rows are turns each; equal numbers come in one order for all.
    same = [(c, 1, "u", t) for c in (1, 2) for t in ("a", "b", "a")]
    rows = rows_of(prefix_trie.trie(spark.createDataFrame(same, schema)))
    assert len(rows) == 4 and all(r[0] == 1 and r[3] == 2 for r in rows)
    assert [r[6] for r in sorted(rows, key=lambda r: r[1])][0] == 3
    # A very long text, and two texts that differ at their end.
    long = "é" * 2_000_000
    rows = rows_of(prefix_trie.trie(spark.createDataFrame([(1, 0, "u", long), (2, 0, "u", long), (3, 0, "u", long + "x")], schema)))
    assert len(rows) == 3 and max(r[6] for r in rows) == 2_000_000


def test_long_conversations_and_many_ends_are_cut(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 100)
    n = 3000
    rows = [(1, i, "u", f"t{i}") for i in range(n)] + [(2, i, "u", f"t{i}" if i != 1500 else "other") for i in range(n)] + [(c, 0, "u", "t0") for c in range(3, 900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    found = {(r.conv_id, r.depth): r for r in prefix_trie.trie(df).collect()}
    assert len(found) == 1 + n + (n - 1500) and found[1, 1].n_convs == 899 and found[1, 1500].n_children == 2 and found[2, 1501].n_convs == 1
    assert found[1, 1].ends_sha256 == hashlib.sha256(",".join(map(str, range(3, 900))).encode()).hexdigest()
    assert (found[1, 0].n_leaves, found[1, n].n_leaves, found[1, 1500].saved_tokens) == (2, 1, len("t1499"))


def test_running_places_and_joins(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, 40]), i, rng.getrandbits(63) - 2**62, rng.getrandbits(63)) for i in range(4000)]
    stored = Stored(spark)
    df = spark.createDataFrame(rows, "g long, i long, `v w` long, x long").repartition(7)
    got = {r.i: (r.place, r["v w_before"], r.x_before) for r in spread.running(df, "g", [-F.col("i")], stored, sums=("v w",), xors=("x",)).collect()}
    state = {}
    for g, i, v, x in sorted(rows, key=lambda r: -r[1]):
        place, total, mixed = state.get(g, (0, 0, 0))
        assert got[i] == (place, (total + 2**63) % 2**64 - 2**63, mixed)
        state[g] = (place + 1, total + v, mixed ^ x)
    left, right = df.select("g", "i"), spark.createDataFrame([(1, "a"), (2, "b")], "g long, name string")
    joined = spread.keyed_join(left, right, ["g"]).collect()
    assert len(joined) == 4000 and all(r.name == {1: "a", 2: "b"}.get(r.g) for r in joined)
    assert spread.keyed_join(left, right, ["g"], "inner").count() == sum(g in (1, 2) for g, *_ in rows)
