"""Edge frames for checks, statistics and cleaning; recorded goldens of the vehicle table."""

import math

import numpy as np
import pytest

from plumbline.functions.columns import nan_to_null, small_table
from plumbline.operators import clean, describe, plotdata, quality

INF, NAN = math.inf, math.nan


def by(df, key="column"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture
def edge(spark):
    rows = [(1, 1.0, "a"), (2, NAN, "a"), (3, None, "b"), (4, INF, None), (-5, -INF, "c")]
    return small_table(spark, rows, "a int, b double, s string")


def test_normalisation(edge):
    assert nan_to_null(edge).where("b is null").count() == 2


def test_missing_counts_nan_and_null(edge):
    found = by(quality.missing_summary(edge))
    assert {c: r["missing"] for c, r in found.items()} == {"b": 2, "s": 1}
    assert found["b"]["percent"] == pytest.approx(40.0)
    grades = {c: r["severity"] for c, r in by(quality.missing_severity(edge)).items()}
    assert grades == {"a": "ok", "b": "critical", "s": "warning"}


def test_missing_of_empty_table(edge):
    empty = edge.where("a > 100")
    assert quality.missing_summary(empty).count() == 0
    assert {r["severity"] for r in quality.missing_severity(empty).collect()} == {"ok"}
    shape = by(quality.shape_checks(empty), "check")
    assert not shape["not_empty"]["passed"]


def test_negative_and_infinite(edge):
    assert {c: r["passed"] for c, r in by(quality.negative_check(edge)).items()} == {"a": False, "b": False}
    infinite = by(quality.infinite_check(edge))
    assert infinite["a"]["passed"] and not infinite["b"]["passed"]
    assert infinite["b"]["value"] == 2.0


def test_nan_alone_is_not_infinite(spark):
    df = small_table(spark, [(NAN,), (1.0,)], "x double")
    assert quality.infinite_check(df).first()["passed"]
    assert quality.value_ranges(df).first()["maximum"] == 1.0


def test_constant_columns(spark):
    df = small_table(spark, [(1, None, 1, "x"), (1, None, 2, None)], "a int, b int, c int, s string")
    passed = {c: r["passed"] for c, r in by(quality.constant_check(df)).items()}
    assert passed == {"a": False, "b": True, "c": True, "s": False}


def test_duplicates_treat_missing_as_equal(spark):
    df = small_table(spark, [(1, NAN), (1, None), (1, NAN), (2, 1.0)], "a int, x double")
    row = quality.duplicate_count(df).first()
    assert (row["rows"], row["distinct_rows"], row["duplicates"]) == (4, 2, 2)
    assert clean.deduplicate(df).count() == 2
    assert quality.duplicate_count(df.where("a > 9")).first()["duplicates"] == 0


def test_report_and_assert(spark):
    good = small_table(spark, [(1, 2.0, "a"), (2, 3.0, "b")], "a int, x double, s string")
    quality.assert_quality(quality.quality_report(good, ["a", "x"], "x"))
    with pytest.raises(ValueError, match=r"expected_column\(z\)"):
        quality.assert_quality(quality.quality_report(good, ["z"], "x"))
    with pytest.raises(ValueError, match=r"no_negative\(x\)"):
        quality.assert_quality(quality.quality_report(good.withColumn("x", -good["x"]), [], "x"))


# Quartiles of the recorded profile and the bounds recorded for them.
RECORDED = {
    "selling_price": (254999.0, 675000.0, -375002.5, 1305001.5),
    "km_driven": (35000.0, 98000.0, -59500.0, 192500.0),
    "mileage": (16.78, 22.32, 8.470000000000002, 30.63),
    "engine": (1197.0, 1582.0, 619.5, 2159.5),
    "max_power": (68.05, 102.0, 17.124999999999993, 152.925),
    "seats": (5.0, 5.0, 5.0, 5.0),
    "year": (2011.0, 2017.0, 2002.0, 2026.0),
}


@pytest.mark.parametrize("name", RECORDED)
def test_recorded_outlier_bounds(spark, name):
    q1, q3, low, high = RECORDED[name]
    df = small_table(spark, [(q1 - 1,), (q1,), ((q1 + q3) / 2,), (q3,), (q3 + 1,)], "x double")
    row = quality.outlier_summary(df).first()
    assert (row["lower_bound"], row["upper_bound"]) == pytest.approx((low, high))


def test_outlier_methods(spark):
    values = [float(i) for i in range(20)] + [1000.0, None]
    df = small_table(spark, [(v,) for v in values], "x double")
    assert quality.outlier_summary(df).first()["outliers"] == 1
    assert quality.outlier_summary(df, method="zscore", threshold=3.0).first()["outliers"] == 1
    assert quality.outlier_summary(df, threshold=1000.0).first()["outliers"] == 0
    capped = quality.cap_outliers(df, quality.iqr_bounds(df, ["x"]))
    assert capped.where("x is null").count() == 1
    assert quality.outlier_summary(capped).first()["outliers"] == 0
    with pytest.raises(ValueError):
        quality.outlier_summary(df, method="other")


def test_all_null_column(spark):
    df = small_table(spark, [(None, 1.0), (None, 2.0)], "x double, y double")
    row = by(quality.outlier_summary(df))["x"]
    assert row["outliers"] == 0 and row["lower_bound"] is None
    summary = by(describe.numeric_summary(df))["x"]
    assert summary["count"] == 0 and summary["mean"] is None and summary["p50"] is None
    assert by(plotdata.box_stats(df))["x"]["median"] is None
    assert plotdata.histogram(df, bins=2).where("column = 'x'").count() == 0


def test_record_rules(spark):
    fields = (
        "year int, km_driven double, mileage double, engine double, max_power double, seats double, fuel string, "
        "transmission string, owner string"
    )
    rows = [
        (2019, 15000.0, 18.9, 1197.0, 88.5, 5.0, "Petrol", "Manual", "First Owner"),
        (1899, -1.0, 18.9, 1197.0, 88.5, 11.0, "Steam", "Manual", "First Owner"),
        (2019, 0.0, None, 0.0, 0.0, 2.0, "CNG", None, "Test Drive Car"),
    ]
    checked = quality.apply_rules(small_table(spark, rows, fields), quality.vehicle_rules()).collect()
    assert [r["valid"] for r in checked] == [True, False, False]
    assert set(checked[1]["violations"]) == {"year_range", "km_driven_range", "seats_range", "fuel_allowed"}
    assert set(checked[2]["violations"]) == {"mileage_range", "transmission_allowed"}
    good, bad = quality.split_valid(small_table(spark, rows, fields), quality.vehicle_rules())
    assert good.count() == 1 and bad.count() == 2


def test_flag_rules(spark):
    df = small_table(spark, [(0, 1), (1, 1), (2, 0), (0, None)], "a int, b int")
    rules = quality.flags(["a", "b"], at_most_one="one")
    broken = [set(r["violations"]) for r in quality.apply_rules(df, rules).collect()]
    assert broken == [set(), {"one"}, {"a_flag", "one"}, {"b_flag", "one"}]


# --- statistics ---------------------------------------------------------------


def test_tiny_samples(spark):
    for n in range(5):
        df = small_table(spark, [(float(i * i),) for i in range(n)], "x double")
        row = describe.numeric_summary(df).first()
        assert (row["std"] is None) == (n < 2)
        assert (row["skewness"] is None) == (n < 3)
        assert (row["kurtosis"] is None) == (n < 4)


def test_corrected_moments(spark):
    x = np.array([1.0, 2.0, 2.5, 7.0, 11.0, 3.0])
    row = describe.numeric_summary(small_table(spark, [(float(v),) for v in x], "x double")).first()
    n, d = len(x), x - x.mean()
    m2, m3, m4 = (d**2).mean(), (d**3).mean(), (d**4).mean()
    assert row["skewness"] == pytest.approx(math.sqrt(n * (n - 1)) / (n - 2) * m3 / m2**1.5)
    assert row["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / m2**2 - 3) + 6))
    assert row["variance"] == pytest.approx(row["std"] ** 2) == pytest.approx(x.var(ddof=1))


def test_constant_moments(spark):
    row = describe.numeric_summary(small_table(spark, [(4.0,)] * 6, "x double")).first()
    assert (row["std"], row["skewness"], row["kurtosis"]) == (0.0, 0.0, 0.0)


def test_categorical_ties_and_gaps(spark):
    df = small_table(spark, [("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "s string, t string")
    found = by(describe.categorical_summary(df))
    assert tuple(found["s"])[1:] == (4, 2, "a", 2)
    assert tuple(found["t"])[1:] == (0, 0, None, None)
    shares = {r["value"]: r["share"] for r in describe.value_share(df, "s").collect()}
    assert shares == {"a": 0.5, "b": 0.5}


def test_distinct_counts(spark):
    df = small_table(spark, [(1.0, "a"), (NAN, "a"), (None, None), (0.0, "b"), (-0.0, "b")], "x double, s string")
    for exact in (True, False):
        assert {c: r["distinct"] for c, r in by(describe.distinct_counts(df, exact=exact)).items()} == {"x": 2, "s": 2}
    assert describe.missing_total(df) == 3


# --- cleaning -----------------------------------------------------------------


def test_impute(edge):
    df = edge.where("b is null or abs(b) < 100 or isnan(b)")
    mean = clean.impute(df, clean.fill_values(df, ["b"], "mean"))
    assert [r["b"] for r in mean.collect()] == [1.0, 1.0, 1.0]
    mode = clean.impute(edge, clean.fill_values(edge, ["s"], "mode"))
    assert mode.where("s = 'a'").count() == 3
    constant = clean.impute(edge, clean.fill_values(edge, ["s"], "constant", "none"))
    assert constant.where("s = 'none'").count() == 1
    with pytest.raises(ValueError):
        clean.fill_values(edge, ["s"], "guess")


def test_impute_integer_with_fraction(spark):
    df = small_table(spark, [(1,), (2,), (None,)], "a int")
    filled = clean.impute(df, clean.fill_values(df, ["a"], "median"))
    assert sorted(r["a"] for r in filled.collect()) == [1.0, 1.5, 2.0]


def test_drop_missing_drops_nan(edge):
    assert clean.drop_missing(edge, ["b"]).count() == 3


def test_age(spark):
    train = small_table(spark, [(2010,), (2020,)], "year int")
    test = small_table(spark, [(2005,), (2018,)], "year int")
    fitted = clean.latest_year(train, "year")
    assert [r["age"] for r in clean.age_from_year(test, "year", fitted).collect()] == [15, 2]
    assert [r["age"] for r in clean.age_from_year(test, "year").collect()] == [13, 0]
    assert clean.age_from_today(test, "year").first()["age"] >= 20


def test_narrow_types(spark):
    rows = [(1, 2.0, 0.5, 300, None), (100, 3.0, 1.0, -40000, NAN)]
    df = small_table(spark, rows, "a bigint, b double, c double, d bigint, e double")
    assert dict(clean.narrow_types(df).dtypes) == {"a": "tinyint", "b": "tinyint", "c": "double", "d": "int", "e": "double"}


def test_cast_and_drop_ignore_absent(edge):
    assert dict(clean.cast_types(edge, {"a": "string", "zzz": "int"}).dtypes)["a"] == "string"
    assert clean.absent(edge, ["a", "zzz"]) == ["zzz"]
    assert clean.drop_columns(edge, ["a", "zzz"]).columns == ["b", "s"]


def test_chain_shapes(spark):
    """13 columns, three dropped, one added: 11."""
    names = "name year selling_price km_driven fuel seller_type transmission owner mileage engine max_power torque seats"
    words = {"name", "fuel", "seller_type", "transmission", "owner", "torque"}
    schema = ", ".join(f"{n} {'string' if n in words else 'double'}" for n in names.split())
    full = tuple("x" if n in words else 2.0 for n in names.split())
    gap = tuple(None if n == "seats" else v for n, v in zip(names.split(), full))
    df = small_table(spark, [full, full, gap], schema)
    plan = clean.CleaningPlan(year_column="year", drop=("name", "torque", "year"))
    out = clean.clean(df, plan)
    assert (out.count(), len(out.columns)) == (1, 11)
    steps = {r["step"]: (r["rows"], r["columns"]) for r in clean.cleaning_report(df, plan).collect()}
    assert steps == {"input": (3, 13), "missing_values": (2, 13), "duplicates": (1, 13), "final": (1, 11)}


# --- plot data ------------------------------------------------------------------


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    df = small_table(spark, [(float(v),) for v in x], "x double")
    for bins in (7, "auto"):
        rows = plotdata.histogram(df, bins=bins).orderBy("bin").collect()
        counts, edges = np.histogram(x, bins=bins)
        assert [r["count"] for r in rows] == list(counts)
        assert [r["left_edge"] for r in rows] == pytest.approx(list(edges[:-1]))


def test_histogram_of_constant_and_infinite(spark):
    constant = small_table(spark, [(3.0,), (3.0,)], "x double")
    assert [r["count"] for r in plotdata.histogram(constant).collect()] == [2]
    with pytest.raises(ValueError):
        plotdata.histogram(small_table(spark, [(INF,), (1.0,)], "x double"), bins=3)


def test_density(spark):
    x = np.random.default_rng(1).normal(size=300)
    df = small_table(spark, [(float(v),) for v in x], "x double")
    h = x.std(ddof=1) * len(x) ** -0.2
    rows = plotdata.density(df, "x", points=40).orderBy("x").collect()
    for r in rows:
        expected = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(expected)
    binned = plotdata.density(df, "x", points=40, bins=500).orderBy("x").collect()
    assert max(abs(a["density"] - b["density"]) for a, b in zip(rows, binned)) < 0.01


def test_box_stats(spark):
    df = small_table(spark, [(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    assert plotdata.box_stats(df, quartiles={"x": (3.0, 5.0, 7.0)}).first() == plotdata.box_stats(df).first()
    row = plotdata.box_stats(df).first()
    assert (row["median"], row["whisker_low"], row["whisker_high"], row["fliers"]) == (5.0, 1.0, 8.0, 1)


# --- infinities, maps and filling by kind of column ------------------------------------


def test_infinite_cells_and_zscore_bounds(spark):
    df = small_table(spark, [(v,) for v in (1.0, 2.0, 3.0, 4.0, 5.0, math.inf, math.inf, -math.inf, math.nan, None)], "x double")
    row = quality.infinite_check(df).first()
    assert (row["passed"], row["value"]) == (False, 3.0)
    found = quality.outlier_summary(df, ["x"], method="zscore").first()
    assert found["outliers"] == 3 and math.isfinite(found["lower_bound"])
    capped = [r["x"] for r in quality.cap_outliers(df, quality.zscore_bounds(df, ["x"])).collect()]
    assert capped[:5] == [1.0, 2.0, 3.0, 4.0, 5.0] and capped[5] == found["upper_bound"] and capped[8] is None
    wide = small_table(spark, [(math.inf,), (math.inf,), (-math.inf,)], "x double")
    assert quality.outlier_summary(wide, ["x"]).first()["outliers"] == 0


def test_rules_take_nan_for_missing(spark):
    df = small_table(spark, [(1.0,), (math.nan,), (None,), (math.inf,)], "x double")
    assert [r["valid"] for r in quality.apply_rules(df, [quality.between("x", 0)]).collect()] == [True, False, False, True]


def test_report_covers_maps(spark):
    df = spark.sql("SELECT 1 AS a, map('k', i, 'j', 0) AS m FROM VALUES (1), (2), (NULL) AS t(i)").unionByName(
        spark.sql("SELECT 1 AS a, map('j', 0, 'k', 1) AS m")).unionByName(spark.sql("SELECT 1 AS a, CAST(NULL AS map<string,int>) AS m"))
    rows = {(r["check"], r["column"]): r["value"] for r in quality.quality_report(df).collect()}
    assert rows["duplicates", None] == 1.0 and rows["missing", "m"] == 1.0
    nested = spark.sql("SELECT map('a', map('b', 1)) AS m UNION ALL SELECT map('a', map('b', 1))")
    assert quality.duplicate_count(nested).first()["duplicates"] == 1


def test_filling_by_kind_of_column(spark):
    df = small_table(spark, [(1.0, "a"), (3.0, "a"), (None, "b"), (1.0, None)], "x double, w string")
    plan = clean.CleaningPlan(missing="mean", duplicates="keep")
    assert clean.clean(df, plan).collect()[2:] == [(5 / 3, "b"), (1.0, "a")]
    fixed = clean.CleaningPlan(missing="median", missing_words="constant", constants={"w": "?"})
    assert {r["w"] for r in clean.clean(df, fixed).collect()} == {"a", "b", "?"}
    with pytest.raises(ValueError):
        clean.clean(df, clean.CleaningPlan(missing="constant"))
    # Values of the training frame fill another one.
    fills = clean.fit_fills(df, plan)
    other = small_table(spark, [(None, None), (100.0, "z")], "x double, w string")
    assert clean.clean(other, plan, fills=fills).collect()[0] == (5 / 3, "a")
    report = {r["step"]: r["rows"] for r in clean.cleaning_report(df, clean.CleaningPlan(missing="mode")).collect()}
    assert report["final"] == clean.clean(df, clean.CleaningPlan(missing="mode")).count()
