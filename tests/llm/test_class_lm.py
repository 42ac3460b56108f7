"""Class model: counts and base scores against brute force, exchange, edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import class_lm, langid
from plumbline.llm.stored import Stored


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + [None]


def base(train, text):
    counts = Counter(t for x in train for t in tokens_of(x))
    total, kinds = sum(counts.values()), len(counts)
    own = tokens_of(text)
    return (len(own), sum(t in counts for t in own), total,
            sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (kinds + 1))) for t in own))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(120).cache()


def scored(docs, train, **options):
    return {r.doc_id: r for r in class_lm.score(docs, train, **options).collect()}


def test_counts_and_base_scores(docs, monkeypatch):
    train = docs.filter(langid.remainder("doc_id", 5) != 1)
    texts = [r.text for r in train.collect()]
    rows = scored(docs, train, classes=8, rounds=3)
    for r in docs.collect():
        n, known, total, expected = base(texts, r.text)
        got = rows[r.doc_id]
        assert (got.n_tokens, got.n_known, got.train_tokens) == (n, known, total)
        assert math.isclose(got.base_score, expected, rel_tol=1e-9)
        assert math.isclose(got.perplexity, 10 ** (-got.score / n), rel_tol=1e-9)
    # The same scores if nearly all counts come by the join and tables are handed on early.
    monkeypatch.setattr(class_lm, "WORDS_AT_HAND", 20)
    monkeypatch.setattr(class_lm, "FOLDED", 700)
    monkeypatch.setattr(class_lm, "GATHERED", 500)
    again = scored(docs, train, classes=8, rounds=3)
    for i, r in rows.items():
        assert again[i].n_known == r.n_known and math.isclose(again[i].score, r.score, rel_tol=1e-9)
        assert math.isclose(again[i].base_score, r.base_score, rel_tol=1e-9)


def class_of_words(model, counts, classed):
    """(classes of units by their hash, class of each word) by the model's tables alone."""
    of_unit = {int(w): int(c) for w, c in zip(model.words.view(np.int64), model.classes) if c >= 0}
    of_unit.update({r.unit: r["class"] for r in classed.collect()} if classed is not None else {})
    return of_unit, {r.word: of_unit[r.word] if r.n >= class_lm.LEAST_SEEN else int(model.class_of_shape[r["shape"]]) for r in counts.collect()}


def hashed(words):
    """(hash, shape) of each word, one text per word."""
    view = class_lm.Words(pa.array(words), class_lm.NOT_SPACE)
    return dict(zip(words, zip(view.hashes().view(np.int64).tolist(), class_lm._shapes(view).tolist())))


def test_scores_equal_a_plain_class_bigram_model(docs, spark, monkeypatch):
    train = docs.filter(langid.remainder("doc_id", 5) != 1)
    texts = [tokens_of(r.text) for r in train.collect()]
    every = sorted({t for r in docs.collect() for t in tokens_of(r.text) if t})
    names = hashed(every)
    for at_hand in (1 << 20, 300):
        monkeypatch.setattr(class_lm, "WORDS_AT_HAND", at_hand)
        stored = Stored(spark)
        model, counts, classed = class_lm.learn(train.select("text"), stored, classes=12, rounds=4)
        assert model.more_units == (at_hand == 300)
        of_unit, known = class_of_words(model, counts, classed)
        # Every word seen five times or more is a unit with a class of its own.
        often = {w for w, n in Counter(t for x in texts for t in x if t).items() if n >= 5}
        assert len(often) > 300 and {names[w][0] for w in often} == set(of_unit)
        its = lambda t: 0 if t is None else known.get(names[t][0], int(model.class_of_shape[names[t][1]]))

        seen, kinds, pairs, times = Counter(), Counter(), Counter(), Counter(t for x in texts for t in x)
        for t, n in times.items():
            seen[its(t)] += n
            kinds[its(t)] += 1
        for x in texts:
            for before, t in zip([None, *x], x):
                pairs[its(before), its(t)] += 1
        froms, tos = Counter(), Counter()
        for (a, b), n in pairs.items():
            froms[a] += n
            tos[b] += n
        everything = sum(n + 0.5 for n in (tos[c] for c in range(12)))
        expected = {}
        for r in docs.collect():
            own, total = tokens_of(r.text), 0.0
            for before, t in zip([None, *own], own):
                a, b = its(before), its(t)
                total += math.log10((pairs[a, b] + class_lm.PRIOR * (tos[b] + 0.5) / everything) / (froms[a] + class_lm.PRIOR))
                total += math.log10((times[t] + 0.5) / (seen[b] + 0.5 * (kinds[b] + 1)))
            expected[r.doc_id] = total
        local = stored.table(class_lm._local_scores(docs, model).withColumn("row", F.col("doc_id")))
        met, moved = class_lm._asked(local, model, counts, classed)
        more = Counter({r.row: r.more for r in met.collect()})
        for r in (moved.collect() if moved is not None else []):
            more[r.row] += r.moved
        for r in local.collect():
            assert math.isclose(r.score + more[r.doc_id], expected[r.doc_id], rel_tol=1e-9)
        stored.close()


def test_model_is_a_distribution_and_beats_the_base(docs, spark):
    train = docs.filter(langid.remainder("doc_id", 5) != 1)
    stored = Stored(spark)
    model, counts, classed = class_lm.learn(train.select("text"), stored, classes=16, rounds=9)
    assert np.allclose((10.0**model.transition).sum(axis=1), 1)
    # Shares of all words of a class, and half a count for one that was never seen, sum to 1.
    share = np.zeros(16)
    _, known = class_of_words(model, counts, classed)
    for r in counts.collect():
        share[known[r.word]] += r.n + 0.5
    share[0] += model.ends + 0.5
    assert np.allclose(share + 0.5, 10.0**model.room)
    total = class_lm.score(docs, train, classes=16, rounds=9).filter(langid.remainder("doc_id", 5) == 1).agg(
        F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1] + 1000
    stored.close()


def test_gains_are_the_changes_of_the_likelihood():
    rng = np.random.default_rng(3)
    table = rng.integers(1, 30, (9, 9))
    np.fill_diagonal(table, 0)
    of = np.array([0, 1, 1, 2, 2, 3, 3, 1, 2])

    def joint(of):
        j = np.zeros((4, 4))
        np.add.at(j, (of[:, None].repeat(9, 1), of[None].repeat(9, 0)), table)
        return j

    entries = []
    for u in range(1, 9):
        for other in range(9):
            entries += [(u - 1, of[other], table[u, other]), (u - 1, 4 + of[other], table[other, u])]
    sums = Counter()
    for u, c, n in entries:
        sums[u, c] += int(n)
    keys = sorted(k for k, n in sums.items() if n)
    row, near = (np.array(x) for x in zip(*keys))
    gains = class_lm._gains(row, near, np.array([sums[k] for k in keys]), of[1:], joint(of))
    for u in range(1, 9):
        for c in range(1, 4):
            new = of.copy()
            new[u] = c
            true = class_lm._likelihood(joint(new)) - class_lm._likelihood(joint(of))
            assert math.isclose(gains[u - 1, c], true, rel_tol=1e-9, abs_tol=1e-9)


def test_exchange_raises_the_likelihood_and_finds_groups(spark):
    rng = np.random.default_rng(2)
    # Units 1 to 10 follow 11 to 20 and the reverse: two classes explain that.
    pairs = {}
    for _ in range(6000):
        a, b = int(rng.integers(1, 11)), int(rng.integers(11, 21))
        for key in ((a, b), (b, int(rng.integers(1, 11)))):
            pairs[key] = pairs.get(key, 0) + 1
    pairs[0, 1] = pairs[20, 0] = 1
    # Units 11 to 20 are not at hand in the second turn: their classes come by joins.
    for most in (21, 11):
        df = spark.createDataFrame(
            [(a, b, (a >= most) + 2 * (b >= most), n) for (a, b), n in pairs.items()], "before long, unit long, bits int, n long")
        weight = Counter()
        for (_, b), n in pairs.items():
            weight[b] += n
        far = spark.createDataFrame([(u,) for u in range(11, 21)], "unit long") if most == 11 else None
        near, far, joint, history = class_lm.exchange(df, np.arange(most), np.array([weight[u] for u in range(most)]), far, classes=3, rounds=12)
        class_of = np.concatenate([near, [r["class"] for r in sorted(far.collect())] if far is not None else []]).astype(int)
        assert all(b >= a for a, b in zip(history, history[1:]))
        assert class_of[0] == 0 and set(class_of[1:11]) != set(class_of[11:]) and len(set(class_of[1:11])) == len(set(class_of[11:])) == 1
        expected = np.zeros((3, 3))
        for (a, b), n in pairs.items():
            expected[class_of[a], class_of[b]] += n
        assert (joint == expected).all()


def unpacked(cells):
    """Pairs of packed cells, and the number of cells."""
    rows, found = cells.collect(), Counter()
    for r in rows:
        kind = np.int64 if r.far else np.int32
        for a, b, n in zip(np.frombuffer(r.before, kind), np.frombuffer(r.unit, kind), np.frombuffer(r.n, np.int64)):
            found[int(a), int(b)] += int(n)
    return found, rows


def test_cells_hold_all_pairs_in_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # One word makes half of the tokens; w0 to w39 are frequent, the words of x only twice each.
    texts = [" ".join("the" if rng.random() < 0.5 else f"w{rng.integers(40)}" for _ in range(60)) for _ in range(200)]
    texts += [f"x{i} The x{i}" for i in range(50)] + [None, "", "the"]
    train = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    names = hashed(sorted({t for x in texts for t in tokens_of(x) if t}))
    times = Counter(t for x in texts for t in tokens_of(x) if t)
    for gathered, block, most, blocks in ((1 << 21, 1 << 20, 1 << 20, 1), (900, 500, 1 << 20, 25), (900, 500, 20, 10)):
        monkeypatch.setattr(class_lm, "GATHERED", gathered)
        monkeypatch.setattr(class_lm, "BLOCK", block)
        hand = dict(times.most_common(most))
        least = 1 if most > len(times) else min(hand.values())
        words = np.array(sorted(names[w][0] for w in hand), np.int64).view(np.uint64)
        words.sort()
        by_hash = {names[w][0]: n for w, n in hand.items()}
        n = np.array([by_hash[int(h)] for h in words.view(np.int64)])
        units = {int(h): class_lm.SHAPES + 1 + i for i, h in enumerate(words.view(np.int64)[n >= 5])}
        weight = np.concatenate([[len(texts)], np.zeros(class_lm.SHAPES, np.int64), n[n >= 5]])
        for w, t in times.items():
            if t < 5:
                weight[1 + names[w][1]] += t
        its = lambda t: 0 if t is None else units.get(names[t][0], 1 + names[t][1] if least == 1 else names[t][0])
        expected = Counter((its(a), its(b)) for x in texts for a, b in zip([None, *tokens_of(x)], tokens_of(x)))
        found, rows = unpacked(class_lm._pair_cells(train, (words, n), weight, least))
        assert found == expected
        assert sum(r.far for r in rows) == 0 if least == 1 else any(r.far for r in rows)
        # Rows are cells, not pairs; the pairs of a frequent word fill several of them.
        assert len(rows) <= 30 * blocks and len(expected) > 400
        hot = units[names["the"][0]]
        assert (sum(hot in np.frombuffer(r.before, np.int32) for r in rows if not r.far) > 1) == (block == 500)


def test_blocks_change_no_score(docs, monkeypatch):
    train = docs.filter(langid.remainder("doc_id", 5) != 1)
    rows = scored(docs, train, classes=8, rounds=4)
    monkeypatch.setattr(class_lm, "BLOCK", 2000)
    for at_hand in (1 << 20, 300):
        monkeypatch.setattr(class_lm, "WORDS_AT_HAND", at_hand)
        again = scored(docs, train, classes=8, rounds=4)
        assert again.keys() == rows.keys()
        # Moves of words that are not at hand start from the same classes by hash.
        if at_hand > 300:
            assert all(math.isclose(again[i].score, r.score, rel_tol=1e-9) for i, r in rows.items())
        assert all(math.isclose(again[i].base_score, r.base_score, rel_tol=1e-9) and again[i].n_known == r.n_known for i, r in rows.items())


def test_edges(spark):
    schema = "doc_id long, text string, word int, score string, row int"
    rows = [(1, "A b A", 0, "x", 1), (1, "A b A", 0, "x", 1), (2, None, 0, "x", 1), (3, "", 0, "x", 1), (None, "b " * 60_000, 0, "x", 1),
            (5, "new words only", 0, "x", 1)]
    df = spark.createDataFrame(rows, schema)
    train = df.filter("doc_id is null or doc_id < 5")
    texts = [r[1] for r in rows if r[0] != 5]
    got = sorted(class_lm.score(df, train, classes=4, rounds=2).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    for r, (doc_id, text, *_) in zip(got, sorted(rows, key=lambda r: (r[0] or 0, len(r[1] or "")))):
        n, known, total, expected = base(texts, text)
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (doc_id, n, known, total)
        assert math.isclose(r.base_score, expected, rel_tol=1e-9) and math.isfinite(r.score)
    assert class_lm.score(df.limit(0), train, classes=4, rounds=1).count() == 0
    nothing = class_lm.score(df, df.limit(0), classes=4, rounds=1).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isclose(r.base_score, 0, abs_tol=1e-9) and math.isfinite(r.score) for r in nothing)
