"""Queries: training, tuning, evaluation, registry and scoring.

Models that have a closed form (ridge on one feature, fixed formulas) come with
SQL; forests and boosting do not.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators import crossproducts, evaluation, registry, selection, training, tuning
from plumbline.operators.clean import CleaningPlan, fit_fills
from plumbline.operators.features import Encoder
from plumbline.operators.quality import between, one_of
from plumbline.operators.scoring import Preparation, Scorer, batch_summary
from plumbline.operators.split import hash_folds
from plumbline.session import scratch_path
from plumbline.streaming import scoring as streaming
from plumbline.workload.inputs import (
    LINE_KEY,
    LINE_KEY_SQL,
    MODEL_PREDICTIONS_SQL,
    PREDICTIONS_SQL,
    line_features,
    model_predictions,
    predictions,
)
from plumbline.workload.preparation import fold_sql, uniform_sql
from plumbline.workload.registry import query, rounded, table, union_sql

KEY_SQL = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LINE_HASH = f"md5({LINE_KEY_SQL})"
FEATURES = ["l_quantity", "l_discount", "l_tax"]
FEATURES_SQL = f"""(SELECT {KEY_SQL}, l_quantity, l_extendedprice, l_discount, l_tax,
    1000 * l_quantity * (1 - l_discount) + 0.01 * l_extendedprice AS label FROM lineitem)"""

METRICS_SQL = """count(*) AS n, round(avg(pow(label - prediction, 2)), 2) AS mse,
  round(sqrt(avg(pow(label - prediction, 2))), 5) AS rmse, round(avg(abs(label - prediction)), 5) AS mae,
  round(avg(abs(label - prediction) / greatest(abs(label), 2.220446049250313e-16)), 6) AS mape,
  round(1 - avg(pow(label - prediction, 2)) / var_pop(label), 6) AS r2"""
METRIC_PLACES = {"mse": 2, "rmse": 5, "mae": 5, "mape": 6, "r2": 6}


def ridge_sql(source: str, alpha: float, where: str = "true") -> str:
    """Slope and intercept of ridge regression on l_quantity."""
    return f"""(SELECT b, my - b * mx AS a FROM (SELECT avg(l_quantity) AS mx, avg(label) AS my,
      covar_pop(l_quantity, label) * count(*) / (var_pop(l_quantity) * count(*) + {alpha}) AS b
      FROM {source} WHERE {where}))"""


def _metrics(df):
    return rounded(df, METRIC_PLACES)


# --- errors of given predictions --------------------------------------------------


@query("regression_metrics", f"SELECT {METRICS_SQL} FROM {PREDICTIONS_SQL}")
def _regression_metrics(spark, folder):
    return _metrics(evaluation.regression_metrics(predictions(spark, folder)))


@query("metrics_by_model", f"SELECT model, {METRICS_SQL} FROM {MODEL_PREDICTIONS_SQL} GROUP BY model")
def _by_model(spark, folder):
    return _metrics(evaluation.regression_metrics(model_predictions(spark, folder), by=["model"]))


FOLDED_SQL = f"(SELECT *, {fold_sql(LINE_HASH.format(seed=42), 5)} AS fold FROM {PREDICTIONS_SQL})"


@query("cv_rmse_by_fold", f"""
WITH f AS (SELECT fold, sqrt(avg(pow(label - prediction, 2))) AS rmse FROM {FOLDED_SQL} GROUP BY fold)
SELECT count(*) AS folds, round(avg(rmse), 5) AS mean_rmse, round(stddev_pop(rmse), 5) AS std_rmse FROM f
""")
def _cv_given(spark, folder):
    folds = tuning.fold_metrics(hash_folds(predictions(spark, folder), LINE_KEY, 5))
    return rounded(tuning.fold_summary(folds), 5)


@query("top_k_models", f"""
SELECT model, {METRICS_SQL} FROM {MODEL_PREDICTIONS_SQL} GROUP BY model ORDER BY sqrt(avg(pow(label - prediction, 2))), model LIMIT 2
""")
def _top(spark, folder):
    errors = evaluation.regression_metrics(model_predictions(spark, folder), by=["model"])
    return _metrics(training.top_models(errors, 2))


@query("best_model", f"""
SELECT model, {METRICS_SQL} FROM {MODEL_PREDICTIONS_SQL} GROUP BY model ORDER BY sqrt(avg(pow(label - prediction, 2))), model LIMIT 1
""")
def _best(spark, folder):
    errors = evaluation.regression_metrics(model_predictions(spark, folder), by=["model"])
    return _metrics(tuning.choose_best(errors, "rmse"))


@query("original_scale_metrics", f"SELECT {METRICS_SQL} FROM (SELECT exp(ln(1 + label)) - 1 AS label, "
       f"exp(ln(1 + prediction)) - 1 AS prediction FROM {PREDICTIONS_SQL})")
def _original(spark, folder):
    logged = predictions(spark, folder).select(
        F.log1p("label").alias("label"), F.log1p("prediction").alias("prediction")
    )
    return _metrics(evaluation.original_scale_metrics(logged))


@query("residuals", f"SELECT {KEY_SQL}, round(label - prediction, 6) + 0.0::DOUBLE AS residual FROM {PREDICTIONS_SQL}")
def _residuals(spark, folder):
    return rounded(evaluation.residuals(predictions(spark, folder)).select(*LINE_KEY, "residual"), 6)


# --- ridge --------------------------------------------------------------------------


@query("ridge_single", f"""
SELECT {KEY_SQL}, round(a + b * l_quantity, 4) AS prediction FROM {FEATURES_SQL}, {ridge_sql(FEATURES_SQL, 0.3)}
""")
def _ridge(spark, folder):
    frame = line_features(spark, folder)
    fitted = training.train("Ridge", frame, ["l_quantity"])
    return rounded(fitted.transform(frame).select(*LINE_KEY, "prediction"), 4)


RIDGE_FOLDS_SQL = union_sql(
    f"""SELECT fold, {METRICS_SQL} FROM (SELECT fold, label, a + b * l_quantity AS prediction FROM f,
    {ridge_sql('f', 0.3, f'fold <> {i}')} WHERE fold = {i}) GROUP BY fold""" for i in range(4)
)


@query("cross_validate", f"WITH f AS (SELECT *, {fold_sql(LINE_HASH.format(seed=42), 4)} AS fold FROM {FEATURES_SQL})\n"
       + RIDGE_FOLDS_SQL)
def _cross_validate(spark, folder):
    return _metrics(tuning.cross_validate(line_features(spark, folder), "Ridge", ["l_quantity"], LINE_KEY, k=4))


RIDGE_SPACE = {"alpha": ["log_uniform", 1000.0, 3000000.0]}
RIDGE_POINTS = tuning.draws(RIDGE_SPACE, 3)


def _tuning_sql(whole=False):
    folds, trials = 3, []
    for t, point in enumerate(RIDGE_POINTS):
        per_fold = union_sql(
            f"""SELECT sqrt(avg(pow(label - a - b * l_quantity, 2))) AS rmse FROM f,
            {ridge_sql('f', point['alpha'], f'fold <> {i}')} WHERE fold = {i}""" for i in range(folds)
        )
        more = f", round(stddev_pop(rmse), 4) AS cv_std, '{json.dumps(point, sort_keys=True)}' AS params" if whole else ""
        trials.append(
            f"SELECT 'Ridge' AS model, CAST({t} AS BIGINT) AS trial, round(avg(rmse), 4) AS cv_rmse{more} FROM ({per_fold})"
        )
    return f"WITH f AS (SELECT *, {fold_sql(LINE_HASH.format(seed=42), folds)} AS fold FROM {FEATURES_SQL})\n" + union_sql(trials)


@query("tuning_trials", _tuning_sql(whole=True))
def _tuning(spark, folder):
    study = tuning.tune(
        line_features(spark, folder), "Ridge", ["l_quantity"], LINE_KEY, trials=3, k=3, space=RIDGE_SPACE
    )
    return rounded(study.table(spark), 4)


def _halving_sql(trials=4, folds=3):
    """Errors of all trials on all shares; each rung keeps the better half of those the rung before kept."""
    fractions = (0.25, 0.5, 1.0)
    points = tuning.draws(RIDGE_SPACE, trials)
    cells = union_sql(
        f"""SELECT {r} AS rung, {t} AS trial, sqrt(avg(pow(label - a - b * l_quantity, 2))) AS rmse
        FROM f, {ridge_sql('f', p['alpha'], f'fold <> {i} AND u < {share}')} WHERE fold = {i} AND u < {share}"""
        for r, share in enumerate(fractions) for t, p in enumerate(points) for i in range(folds)
    )
    place = "row_number() OVER (ORDER BY cv_rmse, trial)"
    names = union_sql(f"SELECT {t} AS trial, '{json.dumps(p, sort_keys=True)}' AS params" for t, p in enumerate(points))
    return f"""
WITH f AS (SELECT *, {fold_sql(LINE_HASH.format(seed=42), folds)} AS fold, {uniform_sql(LINE_HASH.format(seed='subset42'))} AS u
           FROM {FEATURES_SQL}),
s AS (SELECT rung, trial, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_std FROM ({cells}) GROUP BY rung, trial),
r0 AS (SELECT *, {place} <= 2 AS kept FROM s WHERE rung = 0),
r1 AS (SELECT *, {place} <= 1 AS kept FROM s WHERE rung = 1 AND trial IN (SELECT trial FROM r0 WHERE kept)),
r2 AS (SELECT *, true AS kept FROM s WHERE rung = 2 AND trial IN (SELECT trial FROM r1 WHERE kept))
SELECT 'Ridge' AS model, CAST(rung AS INTEGER) AS rung, pow(2.0, rung - 2)::DOUBLE AS fraction, CAST(trial AS BIGINT) AS trial, params,
       round(cv_rmse, 4) AS cv_rmse, round(cv_std, 4) AS cv_std, kept
FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2) JOIN ({names}) USING (trial)"""


@query("successive_halving", _halving_sql())
def _halving(spark, folder):
    found = tuning.halve(
        line_features(spark, folder), "Ridge", ["l_quantity"], LINE_KEY, trials=4, k=3, space=RIDGE_SPACE
    )
    return rounded(found.table(spark), {"cv_rmse": 4, "cv_std": 4})


@query("trial_history", "SELECT *, min(cv_rmse) OVER (ORDER BY trial) AS best_so_far FROM (" + _tuning_sql() + ")")
def _history(spark, folder):
    return tuning.trial_history(_tuning(spark, folder).select("model", "trial", "cv_rmse"))


@query("trial_slices", "SELECT model, trial, 'alpha' AS parameter, round(CASE trial "
       + " ".join(f"WHEN {i} THEN {p['alpha']!r}::DOUBLE" for i, p in enumerate(RIDGE_POINTS))
       + f" END, 4) AS value, cv_rmse FROM ({_tuning_sql()})")
def _slices(spark, folder):
    study = tuning.tune(
        line_features(spark, folder), "Ridge", ["l_quantity"], LINE_KEY, trials=3, k=3, space=RIDGE_SPACE
    )
    sliced = tuning.trial_slices(study.table(spark))
    return rounded(sliced.withColumn("value", F.col("value").cast("double")), 4)


@query("refit_best", f"""
WITH t AS ({_tuning_sql()}), best AS (SELECT trial FROM t ORDER BY cv_rmse, trial LIMIT 1),
p AS ({union_sql(
    f"SELECT {i} AS trial, label, a + b * l_quantity AS prediction FROM {FEATURES_SQL}, {ridge_sql(FEATURES_SQL, p['alpha'])}"
    for i, p in enumerate(RIDGE_POINTS)
)})
SELECT {METRICS_SQL} FROM p WHERE trial = (SELECT trial FROM best)
""")
def _refit(spark, folder):
    frame = line_features(spark, folder)
    study = tuning.tune(frame, "Ridge", ["l_quantity"], LINE_KEY, trials=3, k=3, space=RIDGE_SPACE)
    best = tuning.refit(frame, study, ["l_quantity"])
    return _metrics(evaluation.regression_metrics(best.transform(frame)))


_CURVE_SQL = f"""
WITH s AS (SELECT *, {fold_sql(LINE_HASH.format(seed=42), 3)} AS fold, CAST(u >= 0.25 AS INTEGER) AS step FROM
  (SELECT *, {uniform_sql(LINE_HASH.format(seed='subset42'))} AS u FROM {FEATURES_SQL})),
cells AS (""" + union_sql(
    f"""SELECT {step} AS step, {fraction} AS fraction,
    avg(pow(label - a - b * l_quantity, 2)) FILTER (fold <> {i} AND step <= {step}) AS train_mse,
    avg(pow(label - a - b * l_quantity, 2)) FILTER (fold = {i}) AS validation_mse,
    count(*) FILTER (fold <> {i} AND step <= {step}) AS n
    FROM s, {ridge_sql('s', 0.3, f'fold <> {i} AND step <= {step}')}"""
    for step, fraction in ((0, 0.25), (1, 1.0)) for i in range(3)
) + """)
SELECT CAST(step AS INTEGER) AS step, CAST(fraction AS DOUBLE) AS fraction, round(sqrt(avg(train_mse)), 4) AS train_rmse,
       round(sqrt(avg(validation_mse)), 4) AS validation_rmse, round(avg(n), 4) AS train_rows FROM cells GROUP BY step, fraction
"""


@query("learning_curve", _CURVE_SQL)
def _learning(spark, folder):
    pipeline = Pipeline(stages=[training.assembler(["l_quantity"]), training.make_estimator("Ridge")])
    curve = evaluation.learning_curve(
        line_features(spark, folder), pipeline, LINE_KEY, k=3, fractions=(0.25, 1.0)
    )
    return rounded(curve, {"train_rmse": 4, "validation_rmse": 4, "train_rows": 4})


@query("learning_curve_ridge", _CURVE_SQL)
def _learning_ridge(spark, folder):
    curve = crossproducts.learning_curve(
        line_features(spark, folder), ["l_quantity"], LINE_KEY, alpha=0.3, k=3, fractions=(0.25, 1.0))
    return rounded(curve, {"train_rmse": 4, "validation_rmse": 4, "train_rows": 4})


# --- importance and noise, with a fixed formula as the model ---------------------------


def _formula(df):
    return df.withColumn("prediction", F.lit(1000) * F.col("l_quantity") * (F.lit(1) - F.col("l_discount")))


IMPORTANCE_REPEATS = 3


def second_uniform_sql(hashed: str) -> str:
    return f"(CAST(CAST(('0x' || substr({hashed}, 14, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496.0)"


def neighbour_sql(seed: str) -> str:
    """Window in which the next row is the donor of shuffled values."""
    digest = LINE_HASH.format(seed=seed)
    return f"""PARTITION BY floor({second_uniform_sql(digest)} * ceil((SELECT count(*) FROM lineitem) / 100000.0))
          ORDER BY {digest}, l_quantity, l_discount, label"""


def _drops_sql():
    """Errors after each repeat's shuffle of each feature, and without one."""
    parts = []
    for r in range(IMPORTANCE_REPEATS):
        order = f"OVER ({neighbour_sql(f'42.{r}')})"
        pairs = f"""(SELECT label, l_quantity, l_discount,
          coalesce(lead(l_quantity) {order}, first_value(l_quantity) {order}) AS dq,
          coalesce(lead(l_discount) {order}, first_value(l_discount) {order}) AS dd FROM {FEATURES_SQL})"""
        parts.append(f"SELECT {r} AS repeat, 'l_quantity' AS feature, avg(pow(label - 1000 * dq * (1 - l_discount), 2)) AS m FROM {pairs}")
        parts.append(f"SELECT {r} AS repeat, 'l_discount' AS feature, avg(pow(label - 1000 * l_quantity * (1 - dd), 2)) AS m FROM {pairs}")
    return f"""
WITH m AS ({union_sql(parts)}),
b AS (SELECT avg(pow(label - 1000 * l_quantity * (1 - l_discount), 2)) AS mse, var_pop(label) AS spread FROM {FEATURES_SQL})"""


@query("importance_repeats", _drops_sql() + "SELECT feature, repeat, round((m - mse) / spread, 6) AS drop FROM m, b")
def _importance_repeats(spark, folder):
    found = evaluation.permutation_drops(
        line_features(spark, folder), _formula, ["l_quantity", "l_discount"], LINE_KEY, repeats=IMPORTANCE_REPEATS
    )
    return rounded(found, 6)


def _importance_sql():
    return _drops_sql() + f""",
s AS (SELECT feature, avg((m - mse) / spread) AS mean, stddev_pop((m - mse) / spread) AS std FROM m, b GROUP BY feature)
SELECT feature, round(mean, 6) AS importance_mean, round(std, 6) AS importance_std,
       CAST(row_number() OVER (ORDER BY mean DESC, feature) AS INTEGER) AS place FROM s"""


@query("permutation_importance", _importance_sql())
def _importance(spark, folder):
    found = evaluation.permutation_importance(
        line_features(spark, folder), _formula, ["l_quantity", "l_discount"], LINE_KEY, repeats=IMPORTANCE_REPEATS
    )
    return rounded(found, 6)


def _normal_sql(seed):
    hashed = LINE_HASH.format(seed=seed)
    return f"(sqrt(-2.0 * ln(1.0 - {uniform_sql(hashed)})) * cos(2.0 * pi() * {second_uniform_sql(hashed)}))"


@query("noise_robustness", f"""
SELECT data, {METRICS_SQL} FROM (
  SELECT 'clean' AS data, label, 1000 * l_quantity * (1 - l_discount) AS prediction FROM {FEATURES_SQL}
  UNION ALL
  SELECT 'noisy', label, 1000 * (l_quantity + 0.1 * {_normal_sql('42.0')}) * (1 - (l_discount + 0.1 * {_normal_sql('42.1')}))
  FROM {FEATURES_SQL}) GROUP BY data
""")
def _noise(spark, folder):
    found = evaluation.noise_robustness(
        line_features(spark, folder), _formula, ["l_quantity", "l_discount"], LINE_KEY
    )
    return _metrics(found)


# --- trees ------------------------------------------------------------------------------

# On one 0/1 feature a tree of depth 1 predicts the mean label of each group, and boosting that takes
# the whole first step has nothing left to add.
GROUP_MEANS_SQL = f"""(SELECT {KEY_SQL}, label, l_returnflag, avg(label) OVER (PARTITION BY l_returnflag = 'A') AS prediction
    FROM (SELECT *, 1000 * l_quantity * (1 - l_discount) + 0.01 * l_extendedprice AS label FROM lineitem))"""
STUMPS = {
    "RandomForest": {"n_estimators": 2, "max_depth": 1, "bootstrap": False},
    "XGBoost": {"n_estimators": 2, "max_depth": 1, "learning_rate": 1.0},
    "LightGBM": {"n_estimators": 2, "max_depth": 1, "learning_rate": 1.0, "num_leaves": 2},
}


def _two_groups(spark, folder):
    """Label and a flag for one of the return flags."""
    return table(spark, folder, "lineitem").select(
        *LINE_KEY, (F.col("l_returnflag") == "A").cast("double").alias("flag"),
        (F.lit(1000) * F.col("l_quantity") * (F.lit(1) - F.col("l_discount")) + F.lit(0.01) * F.col("l_extendedprice")).alias("label"))


def _stump(name):
    def scored(spark, folder):
        frame = _two_groups(spark, folder)
        fitted = training.train(name, frame, ["flag"], params=STUMPS[name])
        return rounded(fitted.transform(frame).select(*LINE_KEY, "prediction"), 3)

    return scored


# XGBoost divides by one row more (its penalty of 1), so each of the two trees adds a part of what is left of
# the group's sum s of n rows: s / (n + 1), and of the rest as much again.
SHRUNK_MEANS_SQL = f"""(SELECT {KEY_SQL}, label, base + s / (n + 1) + (s - n * s / (n + 1)) / (n + 1) AS prediction FROM (
    SELECT *, sum(label - base) OVER (PARTITION BY l_returnflag = 'A') AS s, count(*) OVER (PARTITION BY l_returnflag = 'A') AS n
    FROM (SELECT *, avg(label) OVER () AS base FROM {GROUP_MEANS_SQL})))"""
GROUP_SQL = {"RandomForest": GROUP_MEANS_SQL, "XGBoost": SHRUNK_MEANS_SQL, "LightGBM": GROUP_MEANS_SQL}

for _model, _name in (("RandomForest", "forest_two_groups"), ("XGBoost", "boosting_two_groups"), ("LightGBM", "light_boosting_two_groups")):
    query(_name, f"SELECT {KEY_SQL}, round(prediction, 3) AS prediction FROM {GROUP_SQL[_model]}")(_stump(_model))


# One tree on two flags, worked out: gains of both first splits, then of the two splits below the better one, of
# which three leaves leave room for one.
_SIDES = "sum(s) FILTER ({0} = 1) AS s1, sum(n) FILTER ({0} = 1) AS n1, sum(s) FILTER ({0} = 0) AS s0, sum(n) FILTER ({0} = 0) AS n0"
_GAIN = "0.5 * (s1 * s1 / (n1 + 0.05) + s0 * s0 / (n0 + 0.05) - (s1 + s0) * (s1 + s0) / (n1 + n0 + 0.05)) - 10"


@query("boosting_best_first", f"""
WITH r AS (
    SELECT {KEY_SQL}, CAST(l_returnflag = 'A' AS INTEGER) AS a, CAST(l_quantity > 25 AS INTEGER) AS b, label
    FROM (SELECT *, 1000 * l_quantity * (1 - l_discount) + 0.01 * l_extendedprice AS label FROM lineitem)),
base AS (SELECT avg(label) AS base FROM r),
cells AS (SELECT a, b, sum(label - base) AS s, count(*) AS n FROM r, base GROUP BY a, b),
roots AS (SELECT 'a' AS f, {_SIDES.format('a')} FROM cells UNION ALL SELECT 'b', {_SIDES.format('b')} FROM cells),
root AS (SELECT f FROM roots ORDER BY {_GAIN} DESC, f LIMIT 1),
placed AS (SELECT a, b, s, n, CASE f WHEN 'a' THEN a ELSE b END AS up, CASE f WHEN 'a' THEN b ELSE a END AS down FROM cells, root),
opened AS (SELECT (
    SELECT up FROM (SELECT up, {_GAIN} AS gain FROM (SELECT up, {_SIDES.format('down')} FROM placed GROUP BY up))
    WHERE gain > 0 ORDER BY gain DESC, up LIMIT 1) AS up),
leaves AS (
    SELECT a, b, sum(s) OVER w / (sum(n) OVER w + 0.05) AS weight FROM placed, opened
    WINDOW w AS (PARTITION BY placed.up, CASE WHEN placed.up = opened.up THEN down ELSE 0 END))
SELECT {KEY_SQL}, round(base + 0.5 * weight, 3) AS prediction FROM r JOIN leaves USING (a, b), base""")
def _best_first(spark, folder):
    rows = table(spark, folder, "lineitem")
    label = F.lit(1000) * F.col("l_quantity") * (F.lit(1) - F.col("l_discount")) + F.lit(0.01) * F.col("l_extendedprice")
    frame = rows.select(
        *LINE_KEY, (F.col("l_returnflag") == "A").cast("double").alias("a"), (F.col("l_quantity") > 25).cast("double").alias("b"), label.alias("label"))
    params = {"n_estimators": 1, "max_depth": 2, "num_leaves": 3, "learning_rate": 0.5, "reg_lambda": 0.05, "min_split_gain": 10.0}
    fitted = training.train("LightGBM", frame, ["a", "b"], params=params)
    return rounded(fitted.transform(frame).select(*LINE_KEY, "prediction"), 3)


@query("baseline_errors", union_sql(
    f"SELECT '{m}' AS model, count(*) AS n, round(avg(pow(label - prediction, 2)), 2) AS mse, "
    f"round(avg(abs(label - prediction)), 4) AS mae FROM {GROUP_SQL[m]}" for m in STUMPS
))
def _baseline_errors(spark, folder):
    frame = _two_groups(spark, folder)
    models = training.train_baselines(frame, ["flag"], params=STUMPS)
    errors = training.evaluate_models(frame, models).select("model", "n", "mse", "mae")
    return rounded(errors, {"mse": 2, "mae": 4})


SMALL_TREES = {
    "Ridge": {"alpha": 0.3},
    "XGBoost": {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.6, "colsample_bytree": 0.8},
    "LightGBM": {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "num_leaves": 31},
    "RandomForest": {"n_estimators": 5, "max_depth": 4, "min_samples_split": 4, "min_samples_leaf": 3},
}


@query("forest_scores")
def _forest(spark, folder):
    frame = line_features(spark, folder)
    fitted = training.train("RandomForest", frame, FEATURES, params=SMALL_TREES["RandomForest"])
    return fitted.transform(frame).select(*LINE_KEY, "label", "prediction")


@query("boosting_scores")
def _boosting(spark, folder):
    frame = line_features(spark, folder)
    fitted = training.train("XGBoost", frame, FEATURES, params=SMALL_TREES["XGBoost"])
    return fitted.transform(frame).select(*LINE_KEY, "label", "prediction")


@query("baseline_table")
def _baselines(spark, folder):
    frame = line_features(spark, folder)
    models = training.train_baselines(frame, FEATURES, params=SMALL_TREES)
    errors = training.evaluate_models(frame, models)
    return training.training_table(spark, models).join(F.broadcast(errors), "model")


@query("rfecv_ranking")
def _rfecv(spark, folder):
    frame = line_features(spark, folder)
    chosen = selection.recursive_elimination(
        frame, FEATURES, LINE_KEY, estimator=selection.forest(trees=3, depth=4), k=2
    )
    return chosen.table(spark)


# --- registry ---------------------------------------------------------------------------


@query("promotion_gate", f"""
WITH e AS (SELECT model, sqrt(avg(pow(label - prediction, 2))) AS rmse FROM {MODEL_PREDICTIONS_SQL} GROUP BY model),
w AS (SELECT max(rmse) FILTER (model = 'base') AS champion_rmse, max(rmse) FILTER (model = 'plain') AS challenger_rmse FROM e)
SELECT round(champion_rmse, 5) AS champion_rmse, round(challenger_rmse, 5) AS challenger_rmse,
       round((champion_rmse - challenger_rmse) * 100 / champion_rmse, 5) AS improvement_percent,
       (champion_rmse - challenger_rmse) * 100 / champion_rmse >= 0.1 AS promote FROM w
""")
def _gate(spark, folder):
    errors = evaluation.regression_metrics(model_predictions(spark, folder), by=["model"])
    return rounded(registry.gate(errors, "base", "plain"), 5)


def _registered(spark, folder):
    """Register the three rival models by falling error; each promotion must pass the gate."""
    errors = evaluation.regression_metrics(model_predictions(spark, folder), by=["model"])
    path = scratch_path(spark, "registry")
    current = None
    for r in errors.orderBy(F.desc("rmse")).collect():
        decision = registry.gate(
            small_table(spark, [("challenger", r["rmse"])] + ([("champion", current)] if current else []),
                        "model string, rmse double"),
            "champion", "challenger",
        ).first()["promote"]
        name = "shared" if r["model"] != "base" else "base"
        registry.register(
            spark, path, name, r["model"], r["rmse"], f"models/{r['model']}", ["l_quantity"], decision
        )
        current = r["rmse"] if decision else current
    return registry.read_registry(spark, path)


REGISTRY_SQL = f"""
WITH e AS (SELECT model, sqrt(avg(pow(label - prediction, 2))) AS rmse FROM {MODEL_PREDICTIONS_SQL} GROUP BY model),
o AS (SELECT *, row_number() OVER (ORDER BY rmse DESC) AS sequence, CASE WHEN model = 'base' THEN 'base' ELSE 'shared' END AS name,
      min(rmse) OVER (ORDER BY rmse DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY sequence) AS version,
      best IS NULL OR (best - rmse) * 100 / best >= 0.1 AS promoted FROM o)"""


@query("registry_append", REGISTRY_SQL + """
SELECT name, version, sequence, promoted, model AS model_type, round(rmse, 5) AS rmse, 'models/' || model AS uri,
       CASE WHEN sequence = max(CASE WHEN promoted THEN sequence END) OVER () THEN 'production' END AS alias FROM r
""")
def _registry(spark, folder):
    found = registry.with_alias(_registered(spark, folder))
    return rounded(found.drop("registered_at", "feature_names"), 5)


@query("model_info", REGISTRY_SQL + """
SELECT name, version, 'production' AS alias, 'models/' || model AS uri, model AS model_type, 'l_quantity' AS feature_names,
       CAST(1 AS INTEGER) AS n_features FROM r WHERE promoted ORDER BY sequence DESC LIMIT 1
""")
def _info(spark, folder):
    found = registry.model_info(_registered(spark, folder))
    return found.withColumn("feature_names", F.array_join("feature_names", ","))


# --- scoring of raw records -----------------------------------------------------------------

# A fixed formula on the engineered features stands for the model, so that SQL can repeat it.
PRICE = """SELECT *, 8 + 0.05 * age + 0.2 * o_totalprice_log + 0.1 * o_custkey_sqrt / 100
 + 0.3 * `o_orderstatus_F` AS prediction FROM __THIS__"""


def _scorer(spark, folder):
    orders = table(spark, folder, "orders")
    year = orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    preparation = Preparation(
        features=("age", "o_totalprice_log", "o_custkey_sqrt", "o_orderstatus_F", "o_orderstatus_O"),
        year_column="year",
        reference_year=year,
        log_columns=("o_totalprice",),
        sqrt_columns=("o_custkey",),
        encoder=Encoder({"o_orderstatus": ["F", "O"]}),
    )
    rules = (between("o_totalprice", 1000, 400000), one_of("o_orderstatus", ["F", "O"]))
    return Scorer(preparation, SQLTransformer(statement=PRICE), "formula:1", rules)


SCORE_SQL = """
WITH y AS (SELECT max(year(o_orderdate)) AS top FROM orders),
r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
             CASE WHEN o_orderkey % 50 = 0 THEN 'nan'::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice BETWEEN 1000 AND 400000 AND o_orderstatus IN ('F', 'O') THEN
         round(exp(8 + 0.05 * (top - year(o_orderdate)) + 0.2 * ln(1 + o_totalprice) + 0.1 * sqrt(o_custkey) / 100
         + 0.3 * CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) - 1, 4) END AS predicted_price,
       'INR' AS currency, 'formula:1' AS model_version,
       o_totalprice BETWEEN 1000 AND 400000 AND o_orderstatus IN ('F', 'O') AS valid,
       concat_ws(',', CASE WHEN NOT o_totalprice BETWEEN 1000 AND 400000 THEN 'o_totalprice_range' END,
                 CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus_allowed' END,
                 CASE WHEN isnan(o_totalprice) THEN 'incomplete' END) AS violations
FROM r, y"""


def _response(df):
    flat = df.withColumn("violations", F.concat_ws(",", "violations"))
    return rounded(flat.drop("prediction_timestamp", "confidence_interval"), 4)


def _records(df):
    """Orders as scoring records; every fiftieth has a NaN for its price."""
    price = F.when(F.col("o_orderkey") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return df.select(
        "o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"), F.year("o_orderdate").alias("year"))


@query("batch_score", SCORE_SQL)
def _batch(spark, folder):
    scores = _scorer(spark, folder).score(_records(table(spark, folder, "orders")), ["o_orderkey"])
    return _response(scores)


LABEL_PRICE = "SELECT *, 8 + 0.05 * age + 0.2 * o_totalprice_log + 0.3 * o_orderstatus_index AS prediction FROM __THIS__"


@query("batch_score_label_encoded", """
WITH y AS (SELECT max(year(o_orderdate)) AS top, avg(o_totalprice) FILTER (o_orderkey % 50 <> 0) AS mean FROM orders),
r AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN mean ELSE o_totalprice END AS price FROM orders, y)
SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN
         round(exp(8 + 0.05 * (top - year(o_orderdate)) + 0.2 * ln(1 + price)
         + 0.3 * CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) - 1, 4) END AS predicted_price,
       'INR' AS currency, 'formula:2' AS model_version, o_orderstatus IN ('F', 'O') AS valid,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN '' ELSE 'incomplete' END AS violations
FROM r
""")
def _batch_label(spark, folder):
    """Records filled with a mean fitted beforehand, words as positions; unseen words are incomplete."""
    records = _records(table(spark, folder, "orders"))
    plan = CleaningPlan(missing="mean", missing_columns=("o_totalprice",))
    preparation = Preparation(
        features=("age", "o_totalprice_log", "o_orderstatus_index"), year_column="year",
        reference_year=records.agg(F.max("year")).first()[0], log_columns=("o_totalprice",),
        encoder=Encoder({"o_orderstatus": ["F", "O"]}), encoding="label_encoding", fills=fit_fills(records, plan))
    scorer = Scorer(preparation, SQLTransformer(statement=LABEL_PRICE), "formula:2")
    return _response(scorer.score(records, ["o_orderkey"]))


@query("batch_totals", f"""
SELECT count(*) AS total_predictions, count(predicted_price) AS priced, count(*) FILTER (NOT valid) AS rejected
FROM ({SCORE_SQL})
""")
def _totals(spark, folder):
    scores = _scorer(spark, folder).score(_records(table(spark, folder, "orders")), ["o_orderkey"])
    return batch_summary(scores).drop("batch_timestamp")


@query("stream_score", SCORE_SQL)
def _stream(spark, folder):
    schema = table(spark, folder, "orders").schema
    # The table may be one file or a folder of part files.
    stream = streaming.read_records(spark, f"{folder}/orders.parquet*", schema)
    scores = streaming.score_stream(_records(stream), _scorer(spark, folder), ["o_orderkey"])
    path = scratch_path(spark, "scores")
    streaming.write_scores(scores, path, scratch_path(spark, "scores-checkpoint")).awaitTermination()
    return _response(spark.read.parquet(path))


@query("stream_quarantine", f"""
SELECT o_orderkey, CASE WHEN valid THEN 'scores' ELSE 'rejected' END AS kept_in, predicted_price, CASE WHEN valid THEN '' ELSE violations END
AS violations FROM ({SCORE_SQL})
""")
def _quarantine(spark, folder):
    """Arriving orders end in one of two tables."""
    stream = streaming.read_records(spark, f"{folder}/orders.parquet*", table(spark, folder, "orders").schema)
    scores, rejected, mark = (scratch_path(spark, n) for n in ("scores", "rejected", "quarantine-checkpoint"))
    streaming.write_checked(
        _records(stream), _scorer(spark, folder), ["o_orderkey"], scores, rejected, mark
    ).awaitTermination()
    good = spark.read.parquet(scores).select(
        "o_orderkey", F.lit("scores").alias("kept_in"), "predicted_price", F.lit("").alias("violations"))
    bad = spark.read.parquet(rejected).select(
        "o_orderkey", F.lit("rejected").alias("kept_in"), F.lit(None).cast("double").alias("predicted_price"),
        F.concat_ws(",", "violations").alias("violations"))
    return rounded(good.unionByName(bad), 4)


@query("parameter_importance")
def _parameter_importance(spark, folder):
    """Which drawn parameter the error of a trial follows: the penalty, and not the steps that Ridge hardly uses."""
    space = {**RIDGE_SPACE, "max_iter": ["int", 500, 3000]}
    study = tuning.tune(line_features(spark, folder), "Ridge", ["l_quantity"], LINE_KEY, trials=24, k=3, space=space)
    return rounded(tuning.parameter_importance(study.table(spark)), 6)


@query("model_save_load", f"""
SELECT {KEY_SQL}, round(a + b * l_quantity, 4) AS prediction FROM {FEATURES_SQL}, {ridge_sql(FEATURES_SQL, 0.3)}
""")
def _save_load(spark, folder):
    frame = line_features(spark, folder)
    fitted = training.train("Ridge", frame, ["l_quantity"])
    paths = training.save_models([fitted], scratch_path(spark, "models"))
    scored = training.load_model(paths["Ridge"]).transform(frame)
    return rounded(scored.select(*LINE_KEY, "prediction"), 4)
