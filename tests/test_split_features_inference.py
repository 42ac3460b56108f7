"""Splits, folds, encoders, scalers and statistical tests on hand-made frames."""

import hashlib
import math

import numpy as np
import pytest

from plumbline.functions import hashing, probability
from plumbline.functions.columns import small_table
from plumbline.operators import features, inference, split
from plumbline.operators.features import Encoder, Scaler
from plumbline.sources import reports, tables


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).selectExpr("id", "cast(id as string) AS name").repartition(5).cache()


def digests(n, seed=42):
    return sorted((hashlib.md5(f"{len(str(i))}:{i}|{seed}".encode()).hexdigest(), i) for i in range(n))


@pytest.mark.parametrize("limits", [{}, {"task_rows": 50, "direct_rows": 10}, {"task_rows": 10**6, "direct_rows": 10}])
@pytest.mark.parametrize("size", [0, 1, 1500, 2999, 3000, 5000])
def test_holdout_takes_the_smallest_digests(rows, size, limits):
    train, test = split.holdout(rows, ["id"], size, **limits)
    chosen = {r["id"] for r in test.collect()}
    assert chosen == {i for _, i in digests(3000)[:size]}
    assert {r["id"] for r in train.collect()} == set(range(3000)) - chosen


def test_keys_that_read_alike_are_told_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None)], "x string, y string")
    train, test = split.holdout(df, ["x", "y"], 2)
    assert train.count() == test.count() == 2


def test_flags_whose_names_clash(spark):
    df = spark.createDataFrame([("b_c", "x"), ("q", "c"), ("Q", "c")], "a string, a_b string")
    encoder = features.fit_encoder(df)
    assert len({n.lower() for n in encoder.flag_names()}) == 5
    rows = encoder.one_hot(df).collect()
    assert [sum(r) for r in rows] == [2.0, 2.0, 2.0]


def test_positions_of_many_categories(spark):
    df = spark.range(500).selectExpr("concat('c', id) AS word")
    positions = features.fit_positions(df, "word", task_rows=60)
    found = {r.category: r.position for r in positions.collect()}
    assert found == {w: i for i, w in enumerate(sorted(found))} and len(found) == 500
    coded = features.one_hot_vector(df.union(spark.sql("SELECT 'unseen'")), "word", positions)
    rows = coded.collect()
    assert all(list(r.word_vector.indices) == [found[r.word]] for r in rows if r.word != "unseen")
    assert [r.word_vector.numNonzeros() for r in rows if r.word == "unseen"] == [0] and rows[0].word_vector.size == 500


def test_holdout_check(rows):
    train, test = split.holdout(rows, ["id"], 700)
    ok = split.split_check(rows, train, test, ["id"]).first()
    assert ok["passed"] and (ok["train_rows"], ok["test_rows"]) == (2300, 700)
    bad = split.split_check(rows, train, rows, ["id"]).first()
    assert not bad["passed"] and bad["overlap"] == 2300


@pytest.mark.parametrize("direct_rows", [10, 10**5])
def test_holdout_rejects_repeated_keys(spark, direct_rows):
    df = spark.range(100).selectExpr("id % 2 AS id")
    with pytest.raises(ValueError, match="not unique"):
        split.holdout(df, ["id"], 30, direct_rows=direct_rows)
    assert split.holdout(df, ["id"], 100, direct_rows=direct_rows)[1].count() == 100


def test_fraction_labels(rows):
    labelled = split.fraction_labels(rows, ["id"], {"train": 0.7, "dev": 0.2, "test": 0.1})
    counts = {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000
    assert counts["train"] == pytest.approx(2100, abs=120) and counts["dev"] == pytest.approx(600, abs=90)
    with pytest.raises(ValueError):
        split.fraction_labels(rows, ["id"], {"a": 0.5})


def test_hash_folds_partition_the_rows(rows):
    counts = [r["count"] for r in split.hash_folds(rows, ["id"], 7).groupBy("fold").count().orderBy("fold").collect()]
    assert len(counts) == 7 and sum(counts) == 3000 and min(counts) > 350


@pytest.mark.parametrize("task_rows", [40, 10**6])
def test_contiguous_folds(spark, task_rows):
    df = spark.range(17).selectExpr("id * 3 AS id").repartition(3)
    found = split.contiguous_folds(df, "id", 5, task_rows=task_rows).orderBy("id").collect()
    assert [r["fold"] for r in found] == [0] * 4 + [1] * 4 + [2] * 3 + [3] * 3 + [4] * 3
    with pytest.raises(ValueError):
        split.contiguous_folds(df.selectExpr("id % 2 AS id"), "id", 5)
    with pytest.raises(ValueError):
        split.contiguous_folds(df, "id", 20)


def test_learning_subsets_are_nested(rows):
    labelled = split.learning_subsets(rows, ["id"], 5, (0.1, 0.5, 1.0))
    small = {r["id"] for r in labelled.where("step <= 0").collect()}
    half = {r["id"] for r in labelled.where("step <= 1").collect()}
    assert small < half and len(half) == pytest.approx(1500, abs=120)
    assert labelled.where("step <= 2").count() == 3000
    assert {r["id"] for r in rows.where(split.in_subset(["id"], 0.5)).collect()} == half


def test_normal_noise(rows):
    drawn = rows.select(hashing.normal(hashing.digest(["id"], 1)).alias("z")).toPandas()["z"]
    assert abs(drawn.mean()) < 0.08 and abs(drawn.std() - 1) < 0.06
    again = rows.repartition(2).select(hashing.normal(hashing.digest(["id"], 1)).alias("z")).toPandas()["z"]
    assert sorted(drawn) == sorted(again)


# --- features -------------------------------------------------------------------


def test_log_and_sqrt_outside_their_domain(spark):
    df = small_table(spark, [(-2.0,), (-1.0,), (0.0,), (1.0,)], "x double")
    logs = [r["x_log"] for r in features.log_transform(df, ["x"]).collect()]
    assert logs == [None, None, 0.0, pytest.approx(math.log(2))]
    roots = [r["x_sqrt"] for r in features.sqrt_transform(df, ["x"]).collect()]
    assert roots == [None, None, 0.0, 1.0]
    kept = features.transform_features(df, ["x"], [], drop_original=False)
    assert kept.columns == ["x", "x_log"]
    back = features.inverse_log(features.log_transform(df, ["x"]), ["x_log"])
    assert back.collect()[3]["x_log_expm1"] == pytest.approx(1.0)


def test_one_hot_unseen_and_names(spark):
    train = small_table(spark, [("Second Owner", 1), ("First Owner", 2), (None, 3)], "owner string, n int")
    encoder = features.fit_encoder(train)
    assert encoder.flag_names() == ["owner_First Owner", "owner_Second Owner"]
    test = small_table(spark, [("First Owner", 1), ("Third Owner", 2), (None, 3)], "owner string, n int")
    out = encoder.one_hot(test)
    assert out.columns == ["n", "owner_First Owner", "owner_Second Owner"]
    assert [tuple(r)[1:] for r in out.collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    assert [r["owner_index"] for r in encoder.label(test).collect()] == [0, None, None]
    seen = encoder.one_hot(train.dropna()).collect()
    assert all(sum(tuple(r)[1:]) == 1.0 for r in seen)
    with pytest.raises(ValueError):
        features.fit_encoder(train, max_categories=1)
    assert Encoder.from_table(encoder.to_table(spark)) == encoder


def test_odd_names_survive_storage(spark, tmp_path):
    df = small_table(spark, [("v1.2 & more", 1.0)], "kind string, n double")
    out = features.fit_encoder(df).one_hot(df)
    path = tables.write_processed(out, str(tmp_path), "train", 3)
    assert path.endswith("train_processed_v3")
    assert tables.load_table(spark, path).columns == ["n", "kind_v1.2 & more"]


def test_scaler(spark):
    df = small_table(spark, [(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, y double")
    scaler = features.fit_scaler(df)
    rows = scaler.apply(df).collect()
    assert [r["x"] for r in rows] == [-1.0, 1.0, None]
    assert [r["y"] for r in rows] == [0.0, 0.0, 0.0]
    assert Scaler.from_table(scaler.to_table(spark)) == scaler
    unit = features.fit_scaler(df, strategy="normalization").apply(df).collect()
    assert [r["x"] for r in unit] == [0.0, 1.0, None]
    scaled = scaler.apply(df)
    assert [r[0] for r in scaled.select(scaler.restore(scaled["x"], "x")).collect()] == [1.0, 3.0, None]
    with pytest.raises(ValueError):
        features.fit_scaler(df.where("x > 100"))
    assert features.scaling_columns(df, "y") == ["x"]
    assert features.scaling_columns(df, "y", include_target=True) == ["x", "y"]


# --- sources ----------------------------------------------------------------------


def test_csv_and_reports(spark, tmp_path):
    df = small_table(spark, [(1, "a,b", 0.5), (2, None, None)], "id int, s string, x double")
    path = str(tmp_path / "t.csv")
    tables.write_csv(df, path)
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()), key=str)
    narrow = tables.read_csv(spark, path, narrow=True, categorical_columns=["s"])
    assert dict(narrow.dtypes) == {"id": "tinyint", "s": "string", "x": "double"}
    assert tables.load_table(spark, path, "csv", df.schema).count() == 2
    reports.write_report(df, str(tmp_path / "r"))
    assert reports.read_report(spark, str(tmp_path / "r")).columns == ["id", "s", "x"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "nothing.csv"))


def test_target_must_exist(spark):
    df = small_table(spark, [(1, 2.0)], "a int, b double")
    assert tables.features_and_target(df, "b").columns == ["a", "label"]
    with pytest.raises(ValueError):
        tables.features_and_target(df, "z")


def test_split_sink(rows, spark, tmp_path):
    path = tables.write_splits(split.label_holdout(rows, ["id"], 100), str(tmp_path), 2)
    assert tables.read_split(spark, path, "test").count() == 100
    assert tables.read_split(spark, path, "train").count() == 2900


# --- inference ---------------------------------------------------------------------


def test_tail_probabilities(spark):
    # Textbook critical values.
    assert probability.t_two_sided(spark, 2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert probability.t_quantile(spark, 0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert probability.chi2_upper(spark, 3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert probability.f_upper(spark, 4.964603, 1, 10) == pytest.approx(0.05, abs=1e-6)
    assert probability.normal_two_sided(spark, 1.959964) == pytest.approx(0.05, abs=1e-6)
    assert 0 < probability.chi2_upper(spark, 900.0, 1) < 1e-150
    assert probability.t_two_sided(spark, None, 10) is None


def groups(spark):
    a, b = [5.1, 4.9, 6.2, 5.8], [7.0, 6.5, 7.7, 8.1, 6.9]
    rows = [(v, "a") for v in a] + [(v, "b") for v in b] + [(None, "a"), (1.0, None)]
    return small_table(spark, rows, "x double, g string"), np.array(a), np.array(b)


def test_t_test_and_effect(spark):
    df, a, b = groups(spark)
    na, nb = len(a), len(b)
    pooled = ((na - 1) * a.var(ddof=1) + (nb - 1) * b.var(ddof=1)) / (na + nb - 2)
    row = inference.t_test(df, "x", "g", ["a", "b"]).first()
    t = (a.mean() - b.mean()) / math.sqrt(pooled * (1 / na + 1 / nb))
    assert (row["statistic"], row["df"]) == (pytest.approx(t), 7.0)
    assert 0.0005 < row["p_value"] < 0.01
    # With two groups the analysis of variance is the squared t test.
    f = inference.anova(df, "x", "g").first()
    assert f["statistic"] == pytest.approx(t * t) and f["p_value"] == pytest.approx(row["p_value"])
    welch = inference.t_test(df, "x", "g", ["a", "b"], equal_var=False).first()
    se = math.sqrt(a.var(ddof=1) / na + b.var(ddof=1) / nb)
    assert welch["statistic"] == pytest.approx((a.mean() - b.mean()) / se) and welch["df"] < 7
    assert inference.cohen_d(df, "x", "g", ["a", "b"]).first()[0] == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled))
    population = ((na - 1) * a.var() + (nb - 1) * b.var()) / (na + nb - 2)
    assert inference.cohen_d(df, "x", "g", ["a", "b"], ddof=0).first()[0] == pytest.approx(
        (a.mean() - b.mean()) / math.sqrt(population)
    )
    with pytest.raises(ValueError):
        inference.t_test(df, "x", "g", ["a", "zzz"])


def test_chi_squared_with_an_empty_cell(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 5 + [("b", "z")] * 7
    df = small_table(spark, rows, "a string, b string")
    observed = np.array([[10, 20, 0], [5, 0, 7]])
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    row = inference.chi_squared(df, "a", "b").first()
    assert row["statistic"] == pytest.approx(((observed - expected) ** 2 / expected).sum()) and row["df"] == 2.0


def test_chi_squared_yates_with_an_empty_cell(spark):
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 5
    df = small_table(spark, rows, "a string, b string")
    o = np.array([[10.0, 20.0], [5.0, 0.0]])
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    gap = np.abs(o - e)
    assert inference.chi_squared(df, "a", "b").first()["statistic"] == pytest.approx(
        ((gap - np.minimum(0.5, gap)) ** 2 / e).sum()
    )
    plain = inference.chi_squared(df, "a", "b", correction=False).first()["statistic"]
    assert plain == pytest.approx((gap**2 / e).sum())
    assert inference.chi_squared(df.where("a = 'a'"), "a", "b").first()["p_value"] == 1.0


def test_correlation_tests(spark):
    df = small_table(spark, [(float(i), float((i * 7) % 11)) for i in range(11)] + [(None, 1.0)], "x double, y double")
    for method in ("pearson", "spearman", "kendall"):
        row = inference.correlation_test(df, "x", "y", method).first()
        assert row["n"] == 11 and -1 < row["r"] < 1 and 0 < row["p_value"] <= 1
    perfect = small_table(spark, [(float(i), 2.0 * i) for i in range(5)], "x double, y double")
    assert inference.correlation_test(perfect, "x", "y", "spearman").first()["p_value"] == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError):
        inference.correlation_test(df, "x", "y", "other")


def test_mean_interval(spark):
    x = np.array([2.0, 4.0, 4.0, 5.0, 9.0])
    df = small_table(spark, [(float(v), None) for v in x] + [(None, 1.0)], "x double, y double")
    found = {r["column"]: r for r in inference.mean_interval(df, ["x", "y"]).collect()}
    reach = 2.776445 * x.std(ddof=1) / math.sqrt(5)
    assert found["x"]["n"] == 5
    assert found["x"]["ci_low"] == pytest.approx(x.mean() - reach, abs=1e-5)
    assert found["y"]["ci_low"] is None
