"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import hard_negatives
from plumbline.llm.stored import Stored

SCHEMA = "vec_id long, embedding array<float>, label int, score double, `row` int, cell string"


def brute(rows, is_anchor, positives=5, negatives=5, percent=80):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows
              if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for a, (anchor, own, label) in enumerate(usable):
        if not is_anchor(anchor):
            continue
        scored = sorted((-sum(x * y for x, y in zip(own, v)), i, b, of) for b, (i, v, of) in enumerate(usable) if b != a)
        for s, i, _, _ in [x for x in scored if x[3] == label][:positives]:
            hard = [x for x in scored if x[3] != label and percent * -s <= 100 * -x[0] <= 100 * -s][:negatives]
            found += [(anchor, i, n + 1, x[1], -s, -x[0]) for n, x in enumerate(hard)]
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 0.5, 1, "c") for i, v, label in rows], SCHEMA).repartition(6)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


@pytest.mark.parametrize("labels", [1, 2, 7])
def test_equals_brute_force(spark, labels):
    rng = random.Random(labels)
    rows = []
    for i in range(400):
        # Small integers give many ties; one label holds most rows.
        v = [rng.choice([-1.0, 0.0, 0.5, 0.5, 1.0]) for _ in range(rng.choice([3, 4]))]
        rows.append((i, v, rng.choice([0, 0, 0, rng.randrange(labels)])))
    rows += [(10, [1.0, 1.0, 1.0], 0), (10, [1.0, 1.0, 1.0], 1), (None, [1.0], 0), (1000, None, 0), (1001, [1.0, None], 0), (1002, [float("nan")], 0),
             (1003, [float("inf")], 0), (1010, [1.0, 1.0], None), (1020, [], 0), (1030, [2.0] * 3, 1)]
    df = frame(spark, rows)
    is_anchor = lambda i: i % 10 == 0
    for sizes in ({}, {"range_rows": 40, "group_rows": 7}):
        assert rows_of(hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **sizes)) == brute(rows, is_anchor)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, positives=2, negatives=9, percent=30)
    assert rows_of(got) == brute(rows, is_anchor, 2, 9, 30)


def test_edges(spark):
    df = frame(spark, [(1, [1.0], 0)])
    assert hard_negatives.mine(df, F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert hard_negatives.mine(df, F.col("vec_id") == 1).collect() == []
    wide = frame(spark, [(0, [3e18, 1.0], 0), (1, [3e18, 1.0], 0), (2, [3e18, 1.0], 1)])
    with pytest.raises(Exception, match="beyond 64 bits"):
        hard_negatives.mine(wide, F.col("vec_id") == 0).collect()


def test_products_are_exact():
    big = np.array([[2.0**40, 3.0], [5.0, -(2.0**39)]])
    assert hard_negatives.products(big, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 3], [5 * 2**20 - 2**39]]
    cells = pa.array([[0.5, -0.001], [], [1.0]], pa.list_(pa.float64()))
    assert hard_negatives.integers(cells).tolist() == [[128.0, -1.0], [0.0, 0.0], [256.0, 0.0]]


def test_anchors_are_not_materialised(spark, monkeypatch):
    """The last step sees one sorted stream and holds only the windows that are open."""
    rng = random.Random(2)
    rows = [(i, [rng.random() for _ in range(4)], i % 3) for i in range(300)]
    df = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 100 == 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(anchor") == 1 and "Window" not in plan
    assert rows_of(df) == brute(rows, lambda i: i % 100 == 0)
    Stored(spark).close()
