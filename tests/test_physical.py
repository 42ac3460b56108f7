"""What the physical plans must and must not hold."""

from plumbline.operators import describe, features, quality, split
from plumbline.plans import prepare
from plumbline.sources.tables import load_table
from plumbline.workload.whole import PREPARE, _orders

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    part = load_table(spark, f"{FOLDER}/part.parquet")
    text = plan(part.where("p_retailprice > 950").select("p_partkey"))
    assert "GreaterThan(p_retailprice,950.0)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in text


def test_scalar_checks_read_only_their_columns(spark):
    text = plan(quality.negative_check(load_table(spark, f"{FOLDER}/customer.parquet")))
    assert "c_name" not in text and text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_moments_are_one_hash_aggregate(spark):
    lines = load_table(spark, f"{FOLDER}/lineitem.parquet")
    text = plan(describe._moments(lines, ["l_quantity", "l_tax"]))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert text.count("Exchange") == 1 and "ReadSchema: struct<l_quantity:double,l_tax:double>" in text


def test_splits_and_folds_do_not_shuffle(spark):
    orders = load_table(spark, f"{FOLDER}/orders.parquet")
    frames = [
        *split.holdout(orders, ["o_orderkey"], 100),
        split.hash_folds(orders, ["o_orderkey"], 5),
        split.contiguous_folds(orders, "o_orderkey", 5),
        split.learning_subsets(orders, ["o_orderkey"]),
    ]
    for df in frames:
        assert "Exchange" not in plan(df) and "Join" not in plan(df)


def test_fitted_features_are_projections(spark):
    orders = load_table(spark, f"{FOLDER}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_totalprice")
    coded = features.fit_encoder(orders).one_hot(orders)
    scaled = features.fit_scaler(coded, ["o_totalprice"]).apply(coded)
    assert "Exchange" not in plan(scaled) and "Join" not in plan(scaled)


def test_preparation_ends_in_a_scan_of_the_stored_split(spark):
    done = prepare.prepare(_orders(spark, FOLDER), PREPARE)
    assert "Exchange" not in plan(done.train)
    # The hold-out pays one shuffle, for its copies.
    assert plan(done.test).count("Exchange") == 1
