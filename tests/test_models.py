"""Models, selection, evaluation, registry and scoring."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators import evaluation, registry, selection, training, tuning
from plumbline.operators.features import Encoder, Scaler
from plumbline.operators.quality import between
from plumbline.operators.scoring import Preparation, Scorer, batch_summary, predict
from plumbline.streaming import scoring as streaming

SMALL = {
    "Ridge": {"alpha": 0.3},
    "XGBoost": {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5, "subsample": 0.9, "colsample_bytree": 1.0},
    "LightGBM": {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5, "num_leaves": 31},
    "RandomForest": {"n_estimators": 6, "max_depth": 5, "min_samples_split": 4, "min_samples_leaf": 3},
}
NAMES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def planted(spark):
    """label = 3 * x1 + 0.5 * x2 + noise; x3 is noise."""
    rng = random.Random(0)
    rows = []
    for i in range(600):
        x = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, *x, 3 * x[0] + 0.5 * x[1] + rng.gauss(0, 0.1)))
    return small_table(spark, rows, "id bigint, x1 double, x2 double, x3 double, label double").repartition(4).cache()


def test_ridge_matches_closed_form(planted):
    data = planted.toPandas()
    x, y = data[NAMES].to_numpy(), data["label"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.3, 500.0):
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        fitted = training.train("Ridge", planted, NAMES, params={"alpha": alpha})
        model = fitted.model.stages[-1]
        assert model.coefficients.toArray() == pytest.approx(w)
        assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w)


def test_parameter_names():
    assert training.spark_params("RandomForest", {"max_depth": 30, "max_features": "sqrt", "min_samples_split": 4, "min_samples_leaf": 2}) == {
        "maxDepth": 30, "featureSubsetStrategy": "sqrt", "minInstancesPerNode": 2,
    }
    # What Spark's trees do not have is refused where it would change them.
    for model, params in (("RandomForest", {"max_depth": 31}), ("RandomForest", {"min_samples_split": 3}), ("XGBoost", {"num_leaves": 3})):
        with pytest.raises(ValueError):
            training.spark_params(model, params)
    assert training.spark_params("XGBoost", {"colsample_bytree": 0.8, "gamma": 1, "min_child_weight": 2}) == {
        "colsample_bytree": 0.8, "gamma": 1, "min_child_weight": 2,
    }
    light = training.make_estimator("LightGBM", {"min_split_gain": 2, "num_leaves": 7})
    assert [light.getOrDefault(p) for p in ("gamma", "num_leaves", "max_depth", "reg_lambda", "min_child_samples")] == [2, 7, -1, 0, 20]
    for name, params in training.BASELINES.items():
        training.make_estimator(name, params)
    with pytest.raises(ValueError):
        training.spark_params("Ridge", {"depth": 3})
    with pytest.raises(ValueError):
        training.make_estimator("Other")


def test_baselines_ranking_and_storage(spark, planted, tmp_path):
    models = training.train_baselines(planted, NAMES, params=SMALL)
    table = training.training_table(spark, models).collect()
    assert [r["model"] for r in table] == list(SMALL) and all(r["training_seconds"] > 0 for r in table)
    errors = {r["model"]: r for r in training.evaluate_models(planted, models).collect()}
    assert all(r["mse"] == pytest.approx(r["rmse"] ** 2) and r["n"] == 600 for r in errors.values())
    assert errors["Ridge"]["rmse"] < 0.15 and all(r["r2"] > 0.5 for r in errors.values())
    ranked = training.select_and_save(planted, models, str(tmp_path), k=2).collect()
    assert ranked[0]["model"] == "Ridge" and ranked[0]["rmse"] <= ranked[1]["rmse"]
    again = training.load_model(ranked[0]["path"]).transform(planted)
    assert evaluation.regression_metrics(again).first()["rmse"] == pytest.approx(ranked[0]["rmse"])


def test_top_models_on_recorded_errors(spark):
    rows = [("Ridge", 0.3971689920438459), ("XGBoost", 0.23279794013745525), ("LightGBM", 0.30602506245900035),
            ("RandomForest", 0.30092294605347764)]
    metrics = small_table(spark, rows, "model string, rmse double")
    assert [r["model"] for r in training.top_models(metrics, 2).collect()] == ["XGBoost", "RandomForest"]
    with pytest.raises(ValueError):
        training.top_models(metrics, 0)


def test_odd_feature_names(spark):
    df = small_table(spark, [(float(i), float(i % 3), 2.0 * i) for i in range(20)], "a double, b double, label double")
    df = df.withColumnsRenamed({"a": "owner_First Owner", "b": "owner_Fourth & Above Owner"})
    fitted = training.train("Ridge", df, df.columns[:2])
    assert fitted.transform(df).count() == 20
    dotted = df.withColumnRenamed("owner_First Owner", "size_1.5")
    models = [training.train("Ridge", dotted, ["size_1.5"], params={"alpha": a}) for a in (0.0, 1.0)]
    assert set(models[0].transform(dotted).columns) == {*dotted.columns, "prediction"}
    errors = {r["n"]: r for r in training.evaluate_models(dotted, models[:1]).collect()}
    assert errors[20]["rmse"] < 1e-6


def test_ridge_solvers_agree(spark, planted, monkeypatch):
    frame = training.assembled(planted, NAMES, ["label"])
    exact = training.Ridge(alpha=0.5).fit(frame).coefficients.toArray()
    monkeypatch.setattr(training, "NORMAL_FEATURES", 1)
    assert training.Ridge(alpha=0.5).fit(frame).coefficients.toArray() == pytest.approx(exact, abs=1e-4)


# --- metrics -----------------------------------------------------------------------


def test_metric_corner_cases(spark):
    rows = [("good", 2.0, 2.0), ("good", 2.0, 2.0), ("bad", 2.0, 3.0), ("bad", 2.0, 2.0), ("zero", 0.0, 1.0),
            ("zero", 1.0, None), ("far", 1e9 + 1, 1e9 + 1.5), ("far", 1e9 + 3, 1e9 + 2.5)]
    df = small_table(spark, rows, "g string, label double, prediction double")
    found = {r["g"]: r for r in evaluation.regression_metrics(df, by=["g"]).collect()}
    assert found["good"]["r2"] == 1.0 and found["bad"]["r2"] == 0.0
    assert found["bad"]["mape"] == 0.25 and found["zero"]["n"] == 1
    assert found["zero"]["mape"] == pytest.approx(1 / 2.220446049250313e-16)
    assert found["far"]["r2"] == pytest.approx(0.75)
    assert evaluation.regression_metrics(df.where("g = 'none'")).first()["r2"] is None


def test_residuals_and_original_scale(spark):
    df = small_table(spark, [(math.log(11), math.log(9)), (math.log(101), math.log(101))], "label double, prediction double")
    assert evaluation.residuals(df).collect()[1]["residual"] == 0.0
    assert evaluation.original_scale_metrics(df).first()["mae"] == pytest.approx(1.0)


# --- validation and search ------------------------------------------------------------


def test_cross_validation(spark, planted):
    folds = tuning.cross_validate(planted, "Ridge", NAMES, ["id"], k=4)
    rows = folds.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2, 3] and sum(r["n"] for r in rows) == 600
    summary = tuning.fold_summary(folds).first()
    assert summary["mean_rmse"] == pytest.approx(np.mean([r["rmse"] for r in rows]))
    assert summary["std_rmse"] == pytest.approx(np.std([r["rmse"] for r in rows]))
    # The search scores the same folds by the same mean.
    study = tuning.tune(planted, "Ridge", NAMES, ["id"], trials=2, k=4, space={"alpha": ["uniform", 0.3, 0.3]})
    base = tuning.cross_validate(planted, "Ridge", NAMES, ["id"], params={"alpha": 0.3}, k=4)
    assert study.scores[0] == pytest.approx(tuning.fold_summary(base).first()["mean_rmse"])


def test_search_space_draws():
    space = tuning.SEARCH_SPACES["RandomForest"]
    points = tuning.draws(space, 30, seed=1)
    assert points == tuning.draws(space, 30, seed=1) != tuning.draws(space, 30, seed=2)
    assert all(50 <= p["n_estimators"] <= 500 and p["max_features"] in ("sqrt", "log2") for p in points)
    ridge = tuning.draws(tuning.SEARCH_SPACES["Ridge"], 200)
    assert all(0.001 <= p["alpha"] <= 3 for p in ridge)
    assert sum(p["alpha"] < 0.1 for p in ridge) > 60  # log-uniform
    for model, named in tuning.SEARCH_SPACES.items():
        training.make_estimator(model, tuning.draws(named, 1)[0])
    with pytest.raises(ValueError):
        tuning.draws({"a": ["other", 1]}, 1)


def test_tune_several(spark, planted):
    spaces = {
        "Ridge": {"alpha": ["log_uniform", 0.01, 1000.0]},
        "RandomForest": {"n_estimators": ["int", 2, 4], "max_depth": ["int", 2, 4], "max_features": ["categorical", ["sqrt"]]},
    }
    best, results = tuning.tune_and_choose(planted, list(spaces), NAMES, ["id"], trials=3, k=2, spaces=spaces)
    assert best.name == "Ridge" and results.count() == 2
    errors = {r["model"]: r for r in results.collect()}
    assert errors["Ridge"]["cv_rmse"] < errors["RandomForest"]["cv_rmse"]
    assert json.loads(errors["Ridge"]["params"])["alpha"] == best.params["alpha"]


def test_trial_tables(spark):
    rows = [("m", i, json.dumps({"a": i, "b": "xy"[i % 2]}), float(10 - i) if i != 2 else 20.0, 0.0) for i in range(8)]
    trials = small_table(spark, rows, "model string, trial bigint, params string, cv_rmse double, cv_std double")
    history = [r["best_so_far"] for r in tuning.trial_history(trials).orderBy("trial").collect()]
    assert history == [10.0, 9.0, 9.0, 7.0, 6.0, 5.0, 4.0, 3.0]
    assert tuning.trial_slices(trials).count() == 16
    weights = {r["parameter"]: r["importance"] for r in tuning.parameter_importance(trials).collect()}
    assert set(weights) == {"a", "b"} and sum(weights.values()) == pytest.approx(1.0)


def test_choose_best_by_either_error(spark):
    rows = [("a", 1.0, 0.5), ("b", 0.9, 0.7)]
    table = small_table(spark, rows, "model string, cv_rmse double, train_rmse double")
    assert tuning.choose_best(table).first()["model"] == "b"
    assert tuning.choose_best(table, "train_rmse").first()["model"] == "a"


# --- selection and importance ---------------------------------------------------------


def test_elimination_keeps_the_planted_features(spark, planted):
    chosen = selection.recursive_elimination(
        planted, NAMES, ["id"], estimator=training.make_estimator("Ridge", {"alpha": 0.3}), k=3
    )
    assert {"x1", "x2"} <= set(chosen.selected)
    assert len(chosen.scores) == 9
    by_size = {n: np.mean([m for s, _, m in chosen.scores if s == n]) for n in (1, 2, 3)}
    assert len(chosen.selected) == min(by_size, key=lambda n: (by_size[n], n))
    table = chosen.table(spark)
    assert selection.Selection.from_table(table).ranking == chosen.ranking
    assert min(chosen.ranking.values()) == 1


def test_elimination_ranks_by_round(planted):
    kept, dropped = selection._eliminate(planted, NAMES, "label", selection.forest(trees=5), 1)
    assert kept == ["x1"] and dropped == ["x3", "x2"]


@pytest.mark.parametrize("bucket_rows", [50, 10**5])
def test_permutation_importance(spark, planted, bucket_rows):
    fitted = training.train("Ridge", planted, NAMES)
    found = evaluation.permutation_importance(
        planted, fitted.transform, NAMES, ["id"], repeats=4, bucket_rows=bucket_rows
    ).orderBy("place").collect()
    assert [r["feature"] for r in found] == NAMES
    # Shuffling a feature of an additive model costs twice its share of the variance.
    assert found[0]["importance_mean"] == pytest.approx(2 * 9 / 9.26, rel=0.15)
    assert abs(found[2]["importance_mean"]) < 0.01


@pytest.mark.parametrize("bucket_rows", [7, 10**5])
def test_shuffled_neighbours_is_a_permutation(spark, planted, bucket_rows):
    rows = evaluation.shuffled_neighbours(planted, ["id"], ["id", "x1"], 5, 600, bucket_rows).collect()
    assert sorted(r["__d0"] for r in rows) == list(range(600))
    value = {r["id"]: r["x1"] for r in rows}
    assert all(r["__d1"] == value[r["__d0"]] for r in rows)
    if bucket_rows > 600:
        assert all(r["id"] != r["__d0"] for r in rows)


def test_importance_rejects_repeated_keys(planted):
    with pytest.raises(ValueError, match="repeats"):
        evaluation.permutation_importance(
            planted.withColumn("id", F.lit(1)), lambda d: d.withColumn("prediction", F.lit(0.0)), NAMES, ["id"]
        )
    with pytest.raises(ValueError, match="empty"):
        evaluation.permutation_importance(
            planted.where("id < 0"), lambda d: d.withColumn("prediction", F.lit(0.0)), NAMES, ["id"]
        )


def test_noise(planted):
    fitted = training.train("Ridge", planted, NAMES)
    found = {r["data"]: r["mse"] for r in evaluation.noise_robustness(planted, fitted.transform, NAMES, ["id"], scale=0.5).collect()}
    assert found["noisy"] == pytest.approx(0.01 + 0.25 * 9.25, rel=0.25) and found["clean"] < 0.02


# --- registry ----------------------------------------------------------------------------


@pytest.mark.parametrize("old, new, promote", [(1.0, 0.9989, True), (1.0, 0.9995, False), (1.0, 1.2, False), (None, 5.0, True), (0.0, 1.0, False)])
def test_gate(spark, old, new, promote):
    rows = [("new", new)] + ([("old", old)] if old is not None else [])
    decision = registry.gate(small_table(spark, rows, "model string, rmse double"), "old", "new").first()
    assert decision["promote"] is promote


def test_registry(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.champion(registry.read_registry(spark, path)).count() == 0
    with pytest.raises(LookupError):
        registry.load_champion(spark, path)
    assert registry.register(spark, path, "a_model", "a", 1.0, "u1", ["x"]) == 1
    assert registry.register(spark, path, "b_model", "b", 0.9, "u2", ["x", "y"]) == 1
    assert registry.register(spark, path, "a_model", "a", 0.95, "u3", ["x"], promoted=False) == 2
    info = registry.model_info(registry.read_registry(spark, path)).collect()
    assert len(info) == 1 and (info[0]["name"], info[0]["version"], info[0]["n_features"]) == ("b_model", 1, 2)
    aliases = registry.with_alias(registry.read_registry(spark, path)).where("alias = 'production'")
    assert aliases.first()["uri"] == "u2"


# --- scoring --------------------------------------------------------------------------------


def scorer(spark):
    train = small_table(
        spark, [(float(y), float(10 - (2020 - y)) / 10) for y in range(2000, 2020)], "year double, label double"
    )
    frame = train.selectExpr("2020 - year AS age", "if(year % 2 = 0, 1D, 0D) AS fuel_Diesel", "label")
    fitted = training.train("Ridge", frame, ["age", "fuel_Diesel"], params={"alpha": 1e-9})
    preparation = Preparation(
        features=("age", "fuel_Diesel"), year_column="year", reference_year=2020, encoder=Encoder({"fuel": ["Diesel"]})
    )
    return Scorer(
        preparation, fitted.model, "Ridge_model:1", (between("year", 1900, 2030),),
        target_scaler=Scaler({"price": 2.0}, {"price": 0.5}), target="price",
    )


RECORDS = [("a", 2015.0, "Diesel"), ("b", 1800.0, "Petrol"), ("c", None, "Petrol"), ("d", 2010.0, None)]


def test_batch_scoring(spark):
    records = small_table(spark, RECORDS, "id string, year double, fuel string")
    scores = {r["id"]: r for r in scorer(spark).score(records, ["id"]).collect()}
    assert scores["a"]["predicted_price"] == pytest.approx(math.expm1(0.5 * 0.5 + 2.0), rel=1e-4)
    assert scores["a"]["currency"] == "INR" and scores["a"]["model_version"] == "Ridge_model:1"
    assert scores["b"]["predicted_price"] is None and scores["b"]["violations"] == ["year_range"]
    assert scores["c"]["violations"] == ["year_range", "incomplete"]
    assert scores["d"]["valid"] and scores["d"]["confidence_interval"] is None
    totals = batch_summary(scorer(spark).score(records, ["id"])).first()
    assert (totals["total_predictions"], totals["priced"], totals["rejected"]) == (4, 2, 2)


def test_empty_batch(spark):
    records = small_table(spark, [], "id string, year double, fuel string")
    assert scorer(spark).score(records, ["id"]).count() == 0
    fitted = scorer(spark).model
    with pytest.raises(ValueError):
        predict(fitted, small_table(spark, [(1.0, 1.0, 1.0)], "age double, fuel_Diesel double, label double"), "label")


def test_stream_scores_each_record_once(spark, tmp_path):
    records = small_table(spark, RECORDS, "id string, year double, fuel string")
    inbox, out, mark = (str(tmp_path / n) for n in ("inbox", "out", "mark"))
    records.where("id < 'c'").write.parquet(inbox)

    def run():
        stream = streaming.read_records(spark, inbox, records.schema)
        streaming.write_scores(streaming.score_stream(stream, scorer(spark), ["id"]), out, mark).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    assert run() == ["a", "b"]
    records.where("id >= 'c'").write.mode("append").parquet(inbox)
    assert run() == ["a", "b", "c", "d"]
    assert run() == ["a", "b", "c", "d"]
