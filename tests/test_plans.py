"""The four plans on a table shaped like the vehicle data."""

import random

import pytest

from plumbline.functions.columns import small_table
from plumbline.operators import clean, registry
from plumbline.operators.quality import vehicle_rules
from plumbline.operators.scoring import Scorer
from plumbline.operators.selection import forest
from plumbline.plans import evaluate, prepare, profile, train

SCHEMA = (
    "id bigint, name string, year int, selling_price bigint, km_driven bigint, fuel string, seller_type string, "
    "transmission string, owner string, mileage double, engine double, max_power double, torque string, seats double"
)
OWNERS = ["First Owner", "Second Owner", "Third Owner", "Fourth & Above Owner"]


@pytest.fixture(scope="module")
def vehicles(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        year, engine, power = rng.randint(1995, 2020), rng.choice([796.0, 1197.0, 1498.0]), rng.uniform(35, 150)
        price = int(50000 * 1.08 ** (year - 1995) * (power / 50))
        rows.append((
            i, f"car {i % 40}", year, price, rng.randint(1, 200000), rng.choice(["Petrol", "Diesel"]),
            rng.choice(["Individual", "Dealer"]), rng.choice(["Manual", "Automatic"]), rng.choice(OWNERS),
            rng.uniform(10, 25), engine, power, "190Nm", 5.0 if i % 30 else None,
        ))
    rows += [(1000 + i, *rows[i][1:]) for i in range(25)]
    return small_table(spark, rows, SCHEMA).repartition(4).cache()


OPTIONS = prepare.PrepareOptions(
    keys=("id",),
    target="selling_price_log",
    test_size=200,
    cleaning=clean.CleaningPlan(year_column="year", drop=("name", "torque", "year")),
    log_columns=("selling_price", "km_driven", "max_power"),
    sqrt_columns=("engine",),
    encode=("fuel", "seller_type", "transmission", "owner"),
)


@pytest.fixture(scope="module")
def prepared(vehicles):
    return prepare.prepare(vehicles, OPTIONS)


def test_prepared_columns(prepared):
    expected = {
        "mileage", "seats", "age", "km_driven_log", "max_power_log", "engine_sqrt", "fuel_Diesel", "fuel_Petrol",
        "seller_type_Dealer", "seller_type_Individual", "transmission_Automatic", "transmission_Manual",
    } | {f"owner_{o}" for o in OWNERS}
    assert set(prepared.features) == expected
    assert prepared.train.columns == prepared.test.columns
    assert set(prepared.train.columns) == expected | {"id", "selling_price_log"}


def test_prepared_rows(prepared, vehicles):
    train, test = prepared.train.toPandas(), prepared.test.toPandas()
    assert not set(train["id"]) & set(test["id"])
    assert not train.isna().any().any() and len(train) + len(test) < vehicles.count()
    assert train.drop(columns=["id"]).duplicated().sum() == 0
    scaled = train[list(prepared.features)]
    assert abs(scaled.mean()).max() < 1e-9
    varied = scaled.std(ddof=0)[scaled.std(ddof=0) > 1e-12]
    assert abs(varied - 1).max() < 1e-9
    assert abs(train["selling_price_log"].mean()) > 5  # the target keeps its scale
    assert prepared.reference_year == vehicles.where("id >= 0").agg({"year": "max"}).first()[0]


def test_parity_options(vehicles):
    options = prepare.PrepareOptions(**{**OPTIONS.__dict__, "scale_target": True, "year_per_frame": True, "encoding": "label_encoding"})
    done = prepare.prepare(vehicles, options)
    train = done.train.toPandas()
    assert abs(train["selling_price_log"].mean()) < 1e-9
    assert "owner_index" in done.features and done.reference_year is None


def test_feature_selection_in_preparation(vehicles):
    options = prepare.PrepareOptions(**{
        **OPTIONS.__dict__, "encode": (), "select_features": True,
        "cleaning": clean.CleaningPlan(
            year_column="year", drop=("name", "torque", "year", "fuel", "seller_type", "transmission", "owner", "seats")
        ),
        "selection": {"estimator": forest("selling_price_log", trees=4), "k": 2},
    })
    done = prepare.prepare(vehicles, options)
    assert done.selection.ranking["max_power_log"] == 1 and done.selection.ranking["age"] == 1
    assert set(done.features) == set(done.selection.selected)


def test_profile(vehicles, tmp_path):
    options = profile.ProfileOptions(
        expected_columns=("name", "year"), target="selling_price", exclude_from_counts=("name", "torque"),
        correlations=("pearson", "spearman"), bins=5, strict=False,
    )
    parts = profile.profile(vehicles, options)
    assert set(parts) == {
        "quality", "missing", "numeric_summary", "outliers", "histogram", "box_stats", "mean_intervals",
        "correlation_pearson", "correlation_spearman", "categorical_summary", "count_plot",
    }
    assert parts["missing"].collect()[0]["column"] == "seats"
    assert {r["column"] for r in parts["count_plot"].collect()} == {"fuel", "seller_type", "transmission", "owner"}
    small = {n: parts[n] for n in ("quality", "numeric_summary")}
    assert profile.tidy(small).where("metric = 'count'").count() == 8
    paths = profile.write_profile(small, str(tmp_path))
    assert vehicles.sparkSession.read.json(paths["numeric_summary"]).count() == 8
    with pytest.raises(ValueError, match="not_constant"):
        profile.profile(vehicles, profile.ProfileOptions(target="selling_price"))


def test_train_evaluate_and_score(spark, vehicles, prepared, tmp_path):
    paths = prepare.write_prepared(prepared, str(tmp_path / "prepared"), 1)
    assert set(paths) == {"train", "test", "encoder", "scaler", "cleaning_report"}
    table = spark.read.parquet(paths["train"])
    options = train.TrainOptions(
        features=prepared.features, keys=("id",), label="selling_price_log",
        baselines={"Ridge": {"alpha": 0.3}, "RandomForest": {"n_estimators": 4, "max_depth": 3}},
        spaces={"Ridge": {"alpha": ["log_uniform", 0.001, 3]}}, top_k=1, trials=2, folds=2,
    )
    folder, path = str(tmp_path / "models"), str(tmp_path / "registry")
    first = train.train_and_promote(table, options, folder, path)
    assert first.winner.name == "Ridge" and first.version == 1 and first.decision.first()["promote"]
    # The same model again is no improvement.
    second = train.train_and_promote(table, options, folder, path)
    assert second.version is None and second.uri == first.uri and not second.decision.first()["promote"]

    found = evaluate.evaluate_champion(
        spark.read.parquet(paths["test"]), path, ["id"], "selling_price_log", repeats=2
    )
    assert found["metrics"].first()["r2"] > 0.95
    assert found["importance"].orderBy("place").first()["feature"] in ("age", "max_power_log")
    assert found["residuals"].count() == prepared.test.count()

    # Raw records go through the same steps and come back on the price scale.
    model, info = registry.load_champion(spark, path)
    scorer = Scorer(
        prepared.preparation(OPTIONS), model, f"{info['name']}:{info['version']}", tuple(vehicle_rules())
    )
    records = vehicles.where("seats is not null").drop("selling_price")
    scores = scorer.score(records, ["id"]).join(vehicles.select("id", "selling_price"), "id").toPandas()
    assert scores["valid"].all()
    assert ((scores["predicted_price"] / scores["selling_price"]).between(0.7, 1.4)).mean() > 0.95
