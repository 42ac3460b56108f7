"""Character models: probabilities, held-out accuracy, rejection and edge cases."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import langid
from plumbline.llm.stored import Stored


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.learn(docs.filter(langid.remainder("doc_id", 4) != 2), per_language=150)


def kneser_ney(words):
    """p(symbol | context) of one language from word counts, written out with dictionaries."""
    raw = [Counter() for _ in range(langid.ORDER)]
    for word, n in words.items():
        marked = "^" + word + "$"
        for t in range(1, len(marked)):
            for k in range(min(t + 1, langid.ORDER)):
                raw[k][marked[t - k : t + 1]] += n
    symbols = set(raw[0])
    used = []
    for k in range(langid.ORDER):
        if k == langid.ORDER - 1:
            used.append(dict(raw[k]))
        else:
            before = Counter(g[1:] for g in raw[k + 1])
            used.append({g: n if g[0] == "^" else before[g] for g, n in raw[k].items()})
    discounts = []
    for table in used:
        ones, twos = (sum(n == i for n in table.values()) for i in (1, 2))
        discounts.append(min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.95))

    def p(context, symbol):
        value = 1 / (len(symbols) + 1)
        for k in range(min(len(context), langid.ORDER - 1) + 1):
            own = context[len(context) - k :]
            following = {g: n for g, n in used[k].items() if g[:-1] == own}
            total = sum(following.values())
            if total:
                kinds = sum(n > 0 for n in following.values())
                value = max(following.get(own + symbol, 0) - discounts[k], 0) / total + discounts[k] * kinds / total * value
        return value

    return symbols, p


def test_probabilities_equal_a_plain_implementation(spark):
    words = {"the": 5, "then": 3, "that": 2, "hat": 4, "at": 1, "thaw": 1}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    model = langid.learn(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"))
    symbols, p = kneser_ney(words)
    for context in ("^", "^t", "^th", "^tha", "hat", "zz"):
        assert abs(sum(p(context, c) for c in symbols) + p(context, "?") - 1) < 1e-9
    asked = ["the", "that", "hat", "tat", "zebra", "t", "hatthen"]
    got, size = model.word_scores(asked)
    for word, score, n in zip(asked, got[:, 0], size):
        marked = "^" + word + "$"
        expected = sum(math.log10(p(marked[:t][-4:], marked[t])) for t in range(1, len(marked)))
        assert n == len(word) + 1 and abs(score - expected) < 1e-3


def test_held_out_accuracy(docs, model):
    from pyspark.sql import functions as F

    found = langid.predict(docs, model).withColumn("held_out", langid.remainder("doc_id", 4) == 2)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"),
        F.avg(F.col("rejected").cast("int")).alias("rejected"), F.min("score"), F.max("score")).first()
    assert rows.n > 200 and rows.right >= 0.98 and rows.rejected <= 0.01
    assert 0 <= rows[3] <= rows[4] <= 1


def test_edges(spark, model):
    texts = [None, "", "123 !? €", "x", "the and that with", "xqzj kvbw " * 60, "der die das und " * 50_000, "ÉTRE LES DES QUE"]
    df = spark.createDataFrame([(i, t, "zz", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, score double")
    rows = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and [rows[i].score for i in (0, 1, 2)] == [0.0] * 3
    assert all(rows[i].rejected for i in (0, 1, 2, 5)) and not rows[6].rejected
    assert (rows[4].lang_pred, rows[6].lang_pred, rows[7].lang_pred) == ("en", "de", "fr")
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [i for i in rows if not rows[i].rejected]
    again = langid.predict(df.withColumn("lang", df.lang.substr(1, 1)).union(df), model).collect()
    assert len(again) == 2 * len(texts) and langid.predict(df.limit(0), model).count() == 0


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.learn(df)
    assert [(r.lang_pred, r.score) for r in langid.predict(df, model).collect()] == [("und", 0.0)] * 2
    assert langid.keep_identified(df, model).count() == 0


def test_copies_do_not_thin_the_sample(spark):
    rng = random.Random(5)
    letters = {"aa": "abcdefgh", "bb": "stuvwxyz"}
    texts = {c: [" ".join("".join(rng.choice(of) for _ in range(5)) for _ in range(20)) for _ in range(60)] for c, of in letters.items()}
    rows = [(t, c) for c in texts for t in texts[c]] + [(t, "aa") for t in texts["aa"][:3] for _ in range(3000)]
    df = spark.createDataFrame(rows, "text string, lang string")
    stored = Stored(spark)
    chosen, languages = langid._sample(df, 20, stored)
    found = {r.code: r for r in chosen.groupBy("code").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("teaches").cast("int")).alias("teach"), F.sum(F.col("tests").cast("int")).alias("test")).collect()}
    assert languages == ["aa", "bb"] and all((r.n, r.teach, r.test) == (40, 20, 20) for r in found.values()) and len(found) == 2
    stored.close()
    model = langid.learn(df, per_language=20)
    assert np.isfinite(model.limit).all()
    own = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(rows[:120])], "doc_id long, text string, lang string")
    assert langid.predict(own, model).join(own, "doc_id").filter("lang <> lang_pred or rejected").count() == 0


def test_labelled_garbage_does_not_turn_rejection_off(spark, docs):
    rng = random.Random(3)

    def garbage(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(n))

    schema = "doc_id long, text string, lang string"
    languages = ["de", "en", "es", "fr"]
    planted = spark.createDataFrame([(-i, garbage(rng.choice([12, 60, 300])), languages[i % 4]) for i in range(1, 17)], schema)
    both = docs.select("doc_id", "text", "lang").unionByName(planted)
    model = langid.learn(both, per_language=400)
    new = spark.createDataFrame([(i, garbage(rng.choice([12, 60, 300])), "en") for i in range(50)], schema)
    assert langid.predict(new, model).filter("not rejected").count() == 0
    assert langid.keep_identified(both, model).filter("doc_id < 0").count() == 0
    letters = F.length(F.regexp_replace("text", r"[^\\p{L}]", ""))
    real = docs.filter(letters >= langid.LEAST_LETTERS)
    assert langid.predict(real, model).filter("rejected").count() <= 0.01 * real.count()
    # The beginnings of texts are short, and spread wider.
    short = real.withColumn("text", F.substring("text", 1, 60))
    assert langid.predict(short, model).filter("rejected").count() <= 0.01 * real.count()
