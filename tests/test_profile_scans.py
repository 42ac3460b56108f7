"""The profile: the same rows as its operators give one by one, from six scans."""

import math
import random

import pytest

from plumbline.functions.columns import numeric_columns, small_table, string_columns
from plumbline.operators import describe, plotdata, quality, ranks
from plumbline.plans import profile

SCHEMA = "id bigint, price double, hot double, flat double, gaps double, none double, word string, rare string"


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        rows.append((
            i % 3900, rng.gauss(100, 30), 5.0 if rng.random() < 0.4 else rng.uniform(0, 10), 1.0,
            rng.random() if i % 3 else None, None, rng.choice(["a", "b", None, ""]), f"w{int(rng.expovariate(0.01))}",
        ))
    return small_table(spark, rows + rows[:50], SCHEMA).repartition(4).cache()


def rows(df):
    def plain(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bins", [7, "auto"])
def test_parts_equal_the_operators(frame, bins):
    options = profile.ProfileOptions(
        expected_columns=("id", "absent"), target="price", exclude_from_counts=("rare",), bins=bins,
        shares=("word", "flat"), strict=False,
    )
    parts = profile.profile(frame, options)
    numeric, words = numeric_columns(frame), string_columns(frame)
    expected = {
        "quality": quality.quality_report(frame, ("id", "absent"), "price", outliers=False),
        "missing": quality.missing_summary(frame),
        "numeric_summary": describe.numeric_summary(frame, numeric),
        "outliers": quality.outlier_summary(frame, numeric),
        "histogram": plotdata.histogram(frame, numeric, bins),
        "box_stats": plotdata.box_stats(frame, numeric),
        "mean_intervals": plotdata.interval_bars(frame, numeric),
        "correlation_pearson": ranks.correlation_matrix(frame, numeric),
        "categorical_summary": describe.categorical_summary(frame, words),
        "count_plot": plotdata.count_plot(frame, words, ("rare",)),
    }
    assert set(parts) == {*expected, "value_share"}
    for name, one in expected.items():
        assert sorted(parts[name].columns) == sorted(one.columns), name
        assert rows(parts[name]) == rows(one), name
    shares = {(r["column"], r["value"]): (r["count"], r["share"]) for r in parts["value_share"].collect()}
    for c in ("word", "flat"):
        for r in describe.value_share(frame, c).collect():
            assert shares.pop((c, r["value"])) == (r["count"], r["share"])
    assert not shares


def counted(spark, frame):
    """The frame read through a step that counts its rows, so that scans can be counted."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    return frame.mapInPandas(pass_on, frame.schema), seen


@pytest.mark.parametrize("task_rows,scans", [(1_000_000, 4), (1000, 6)])
def test_scans(spark, frame, task_rows, scans):
    df, seen = counted(spark, frame)
    parts = profile.profile(df, profile.ProfileOptions(bins=10, shares=("word",), strict=False, task_rows=task_rows))
    for part in parts.values():
        part.collect()
    assert seen.value == scans * frame.count()


@pytest.mark.parametrize("schema", [SCHEMA, "word string", "x double"])
def test_empty_tables_have_all_parts(spark, schema):
    df = small_table(spark, [], schema)
    parts = profile.profile(df, profile.ProfileOptions(strict=False))
    assert {r["passed"] for r in parts["quality"].where("check = 'not_empty'").collect()} == {False}
    if numeric_columns(df):
        assert rows(parts["numeric_summary"]) == rows(describe.numeric_summary(df))
        assert rows(parts["box_stats"]) == rows(plotdata.box_stats(df)) and parts["histogram"].count() == 0
    if string_columns(df):
        assert rows(parts["categorical_summary"]) == rows(describe.categorical_summary(df))


def test_infinite_values_raise(spark):
    with pytest.raises(ValueError, match="infinite"):
        profile.profile(small_table(spark, [(1.0,), (math.inf,)], "x double"), profile.ProfileOptions(strict=False))
