"""Duplicates by digests: the same rows as by whole rows, and what is shuffled for it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import clean, quality

ROWS = [(None, "a", 0.0, [1.0]), ("a", None, -0.0, [1.0]), ("a", None, 0.0, [1.0]), ("a", "a", float("nan"), None), ("a", "a", None, None),
        ("b", "", 1.5, []), ("b", "", 1.5, [None]), (None, None, None, None), (None, None, None, None)]
SCHEMA = "`x.y` string, b string, v double, w array<double>"


def same(spark, df):
    one = quality.duplicate_count(df, two_phase=False).first()
    two = quality.duplicate_count(df, two_phase=True).first()
    assert tuple(one) == tuple(two)
    rows = [sorted(map(repr, clean.deduplicate(df, two_phase=p).select(*[F.col(f"`{c}`") if c != "v" else (F.col("v") + 0.0).alias("v") for c in df.columns]).collect())) for p in (False, True)]
    assert rows[0] == rows[1] and len(rows[0]) == one.distinct_rows
    return one


def test_digests_find_the_same_copies(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert same(spark, df).duplicates == 3
    assert same(spark, df.union(df)).duplicates == 3 + len(ROWS)
    assert same(spark, df.limit(0)).rows == 0
    assert same(spark, df.filter("b = ''")).duplicates == 0


def test_different_rows_of_one_digest_stay(spark, monkeypatch):
    def coarse(df, columns):
        return df.withColumns({"__d0": F.length("b").cast("long"), "__d1": F.lit(0).cast("long")})

    monkeypatch.setattr(quality, "with_digest", coarse)
    df = spark.createDataFrame([(str(i % 7), str(i % 3), 1.0, None) for i in range(50)], SCHEMA)
    assert same(spark, df).distinct_rows == 21


def test_wide_rows_without_copies_are_not_shuffled(spark):
    df = spark.range(500).select("id", *[F.concat(F.lit("x" * 50), F.col("id")).alias(f"c{i}") for i in range(20)])
    assert quality.is_wide(df, df.columns) and not quality.is_wide(df, ["id"])
    plan = clean.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # Of a row only the two halves of its digest, and a count, reach the shuffle.
    digests = quality.with_digest(df, df.columns).select("__d0", "__d1").groupBy("__d0", "__d1").count()
    plan = digests._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "partial_count" in x)
    assert "keys=[__d0" in line and "c1" not in line.split("functions")[0]
    assert quality.duplicate_count(df).first().duplicates == 0


@pytest.mark.parametrize("columns", [["b"], ["b", "v"]])
def test_some_columns(spark, columns):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert tuple(quality.duplicate_count(df, columns, True).first()) == tuple(quality.duplicate_count(df, columns, False).first())
