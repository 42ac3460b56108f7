"""Queries: the four plans from end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import clean, registry, training
from plumbline.plans import evaluate, prepare, profile, train
from plumbline.session import scratch_path
from plumbline.sources.tables import load_table
from plumbline.workload.inputs import LINE_KEY, ORDER_42, line_features
from plumbline.workload.modelling import FEATURES_SQL, RIDGE_SPACE, neighbour_sql, ridge_sql
from plumbline.workload.profiling import (
    _box_sql,
    _categorical_sql,
    _histogram_sql,
    _iqr_sql,
    _report_sql,
    _summary_sql,
    interval_sql,
)
from plumbline.workload.registry import query, rounded, table, union_sql

PART_NUMBERS = ["p_partkey", "p_size", "p_retailprice"]
PART_WORDS = ["p_brand", "p_type"]
PART_SQL = "(SELECT p_partkey, p_size, p_retailprice, p_brand, p_type FROM part)"


def _melt_sql(part: str, source: str, item: str, metrics: list[str]) -> str:
    return union_sql(
        f"""SELECT '{part}' AS part, {item} AS item, '{m}' AS metric, CAST("{m}" AS DOUBLE) AS value FROM ({source})"""
        for m in metrics
    )


SUMMARY = ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "variance", "skewness", "kurtosis"]


@query("profile_plan", "SELECT part, item, metric, round(value, 6) + 0.0::DOUBLE AS value FROM (" + union_sql([
    _melt_sql("numeric_summary", _summary_sql(PART_NUMBERS, "part", dict.fromkeys(SUMMARY, 6)), '"column"', SUMMARY),
    _melt_sql("outliers", _iqr_sql(PART_NUMBERS, "part"), '"column"', ["outliers", "lower_bound", "upper_bound"]),
    _melt_sql("categorical_summary", _categorical_sql(PART_WORDS, "part"), """concat_ws('/', "column", top)""",
              ["count", "unique", "freq"]),
    _melt_sql("count_plot", union_sql(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count" FROM part GROUP BY {c}""" for c in ["p_type"]
    ), """concat_ws('/', "column", value)""", ["count"]),
]) + ")")
def _profile(spark, folder):
    part = table(spark, folder, "part").select(*PART_NUMBERS, *PART_WORDS)
    options = profile.ProfileOptions(
        expected_columns=tuple(PART_NUMBERS), target="p_retailprice", exclude_from_counts=("p_brand",)
    )
    parts = profile.profile(part, options)
    chosen = ("numeric_summary", "outliers", "categorical_summary", "count_plot")
    return rounded(profile.tidy({n: parts[n] for n in chosen}), 6)


@query("profile_notebook", "SELECT part, item, metric, round(value, 6) + 0.0::DOUBLE AS value FROM (" + union_sql([
    _melt_sql("value_share", union_sql(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count",
        count(*)::DOUBLE / (SELECT count(*) FROM part) AS share FROM part GROUP BY {c}""" for c in PART_WORDS
    ), """concat_ws('/', "column", value)""", ["count", "share"]),
    _melt_sql("count_plot", union_sql(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count" FROM part GROUP BY {c}""" for c in PART_WORDS
    ), """concat_ws('/', "column", value)""", ["count"]),
    _melt_sql("correlation_pearson", union_sql(
        f"""SELECT '{a}' AS x, '{b}' AS y, count(*) AS n, corr({a}, {b}) AS r FROM part""" for a in PART_NUMBERS for b in PART_NUMBERS
    ), "concat_ws('/', x, y)", ["n", "r"]),
    _melt_sql("numeric_summary", _summary_sql(PART_NUMBERS, "part", dict.fromkeys(SUMMARY, 6)), '"column"', SUMMARY),
]) + ")")
def _notebook(spark, folder):
    """The interactive profile: value shares, counts, correlations and summaries."""
    part = table(spark, folder, "part").select(*PART_NUMBERS, *PART_WORDS)
    parts = profile.profile(part, profile.ProfileOptions(shares=tuple(PART_WORDS)))
    chosen = ("value_share", "count_plot", "correlation_pearson", "numeric_summary")
    return rounded(profile.tidy({n: parts[n] for n in chosen}), 6)


CUSTOMER_NUMBERS = ["c_custkey", "c_nationkey", "c_acctbal"]
PART_EDGES = ["left_edge", "right_edge", "count"]


@query("profile_parts", "SELECT part, item, metric, round(value, 6) + 0.0::DOUBLE AS value FROM (" + union_sql([
    f"""SELECT 'quality' AS part, concat_ws('/', "check", "column") AS item, m.metric, m.value FROM ({_report_sql(outliers=False)}) q,
    LATERAL (VALUES ('passed', CAST(CAST(q.passed AS INTEGER) AS DOUBLE)), ('value', q.value)) m(metric, value)""",
    _melt_sql("box_stats", _box_sql(CUSTOMER_NUMBERS, "customer"), '"column"',
              ["q1", "median", "q3", "whisker_low", "whisker_high", "fliers"]),
    _melt_sql("mean_intervals", interval_sql(CUSTOMER_NUMBERS, "customer"), '"column"', ["n", "mean", "standard_error"]),
    *[
        _melt_sql("histogram", _histogram_sql(c, "customer", 8),
                  """concat("column", '/', bin)""", PART_EDGES) for c in CUSTOMER_NUMBERS
    ],
]) + ")")
def _parts(spark, folder):
    """The parts that the other profile queries leave out. Student's t is not in SQL, so interval ends are compared in tests."""
    customer = table(spark, folder, "customer").select(*CUSTOMER_NUMBERS, "c_name", "c_mktsegment")
    options = profile.ProfileOptions(expected_columns=("c_acctbal",), target="c_acctbal", bins=8, strict=False)
    parts = profile.profile(customer, options)
    chosen = {n: parts[n] for n in ("quality", "box_stats")}
    chosen["mean_intervals"] = parts["mean_intervals"].drop("ci_low", "ci_high")
    chosen["histogram"] = parts["histogram"].select(
        F.concat_ws("/", "column", F.col("bin").cast("string")).alias("column"), *PART_EDGES
    )
    return rounded(profile.tidy(chosen), 6)


PREPARE = prepare.PrepareOptions(
    keys=("o_orderkey",),
    target="o_totalprice_log",
    test_size=500,
    cleaning=clean.CleaningPlan(
        missing="mean", missing_columns=("priority",), year_column="year", drop=("year", "o_clerk")),
    log_columns=("o_totalprice",),
    sqrt_columns=("o_custkey",),
    encode=("o_orderstatus",),
)


def _orders(spark, folder):
    """Orders with gaps in the priority."""
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.length("o_orderpriority")).alias("priority"),
    )


def _scaled(c):
    """Scaled by the training half."""
    train = f"FILTER (part = 'train') OVER ()"
    return f"round(({c} - avg({c}) {train}) / stddev_pop({c}) {train}, 5) + 0.0::DOUBLE"


@query("prepare_plan", f"""
WITH raw AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, year(o_orderdate) AS year,
    CASE WHEN o_orderpriority <> '5-LOW' THEN length(o_orderpriority) END AS priority,
    row_number() OVER (ORDER BY {ORDER_42}) AS place FROM orders),
part AS (SELECT * REPLACE (coalesce(priority, (SELECT avg(priority) FROM raw WHERE place > 500)) AS priority),
    (SELECT max(year) FROM raw WHERE place > 500) AS top, CASE WHEN place > 500 THEN 'train' ELSE 'test' END AS part FROM raw),
kept AS (SELECT part, min(o_orderkey) AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, year, priority, any_value(top) AS top
    FROM part GROUP BY part, o_custkey, o_orderstatus, o_totalprice, year, priority),
f AS (SELECT part, o_orderkey, ln(1 + o_totalprice) AS o_totalprice_log, priority, top - year AS age, sqrt(o_custkey) AS o_custkey_sqrt,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS f, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS o,
    CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS p FROM kept)
SELECT part, o_orderkey, round(o_totalprice_log, 5) AS o_totalprice_log, {_scaled('priority')} AS priority, {_scaled('age')} AS age,
    {_scaled('o_custkey_sqrt')} AS o_custkey_sqrt, {_scaled('f')} AS "o_orderstatus_F", {_scaled('o')} AS "o_orderstatus_O",
    {_scaled('p')} AS "o_orderstatus_P" FROM f
""")
def _prepare(spark, folder):
    done = prepare.prepare(_orders(spark, folder), PREPARE)
    paths = prepare.write_prepared(done, scratch_path(spark, "prepared"), 1)
    halves = [load_table(spark, paths[p]).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return rounded(halves[0].unionByName(halves[1]), 5)


SMALL = {
    "Ridge": {"alpha": 0.3},
    "RandomForest": {"n_estimators": 3, "max_depth": 2, "min_samples_leaf": 3},
}
RIDGE_FIT_SQL = f"""(SELECT *, a + b * l_quantity AS prediction FROM {FEATURES_SQL}, {ridge_sql(FEATURES_SQL, 0.3)})"""


@query("train_plan", f"""
SELECT 'Ridge' AS model, CAST(1 AS BIGINT) AS place, round(sqrt(avg(pow(label - prediction, 2))), 3) AS rmse,
       'Ridge_model' AS name, CAST(1 AS BIGINT) AS version, 'production' AS alias FROM {RIDGE_FIT_SQL}
""")
def _train_plan(spark, folder):
    """The label is linear in the one feature, so ridge beats the shallow forest."""
    options = train.TrainOptions(
        features=("l_quantity",), keys=tuple(LINE_KEY), baselines=SMALL, spaces={"Ridge": RIDGE_SPACE},
        top_k=1, trials=2, folds=2,
    )
    models, path = scratch_path(spark, "models"), scratch_path(spark, "registry")
    outcome = train.train_and_promote(line_features(spark, folder), options, models, path)
    ranked = outcome.ranked.select("model", "place", "rmse")
    info = registry.model_info(registry.read_registry(spark, path)).select(
        F.col("model_type").alias("model"), "name", "version", "alias"
    )
    return rounded(F.broadcast(ranked).join(info, "model", "left"), 3)


def _evaluate_sql(repeats: int) -> str:
    shuffled = union_sql(
        f"""SELECT avg(pow(label - a - b * other, 2)) AS m FROM (SELECT *,
        coalesce(lead(l_quantity) OVER w, first_value(l_quantity) OVER w) AS other FROM {RIDGE_FIT_SQL}
        WINDOW w AS ({neighbour_sql(f'42.{r}')}))""" for r in range(repeats)
    )
    errors = ", ".join(f"{e} AS {n}" for n, e in {
        "n": "count(*)::DOUBLE", "mse": "avg(pow(label - prediction, 2))",
        "rmse": "sqrt(avg(pow(label - prediction, 2)))", "mae": "avg(abs(label - prediction))",
        "mape": "avg(abs(label - prediction) / abs(label))",
        "r2": "1 - avg(pow(label - prediction, 2)) / var_pop(label)",
    }.items())
    names = ["n", "mse", "rmse", "mae", "mape", "r2"]
    return f"""
WITH e AS (SELECT {errors}, var_pop(label) AS spread FROM {RIDGE_FIT_SQL}),
i AS (SELECT avg((m - mse) / spread) AS importance_mean, stddev_pop((m - mse) / spread) AS importance_std, 1.0::DOUBLE AS place
      FROM ({shuffled}), e)
SELECT part, item, metric, round(value, 2) + 0.0::DOUBLE AS value FROM (""" + union_sql(
        [f"SELECT 'metrics' AS part, '' AS item, '{n}' AS metric, {n} AS value FROM e" for n in names]
        + [f"SELECT 'importance', 'l_quantity', '{n}', {n} FROM i" for n in ("importance_mean", "importance_std", "place")]
    ) + ")"


@query("evaluate_plan", _evaluate_sql(2))
def _evaluate_plan(spark, folder):
    """Register a ridge model and evaluate it as the model in use."""
    frame = line_features(spark, folder)
    fitted = training.train("Ridge", frame, ["l_quantity"])
    models, path = scratch_path(spark, "models"), scratch_path(spark, "registry")
    uri = training.save_models([fitted], models)["Ridge"]
    registry.register(spark, path, "Ridge_model", "Ridge", 0.0, uri, fitted.features)
    found = evaluate.evaluate_champion(frame, path, LINE_KEY, repeats=2)
    return rounded(profile.tidy({"metrics": found["metrics"], "importance": found["importance"]}), 2)
