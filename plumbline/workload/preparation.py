"""Queries: sources and sinks, cleaning, splits and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.columns import nan_to_null
from plumbline.operators import clean, features, quality, split
from plumbline.operators.features import Encoder, Scaler
from plumbline.session import scratch_path
from plumbline.sources import reports, tables
from plumbline.workload.inputs import COPIES_SQL, DIRTY_SQL, ORDER_42, copied_lineitem, dirty_lineitem, key_sql
from plumbline.workload.profiling import PART_NUMBERS
from plumbline.workload.registry import query, rounded, table, union_sql

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders(spark, folder):
    return table(spark, folder, "orders").select(*ORDER_FIELDS)


# --- sources and sinks -----------------------------------------------------------


@query("csv_roundtrip", ORDERS_SQL)
def _csv(spark, folder):
    orders = _orders(spark, folder)
    path = scratch_path(spark, "orders-csv")
    tables.write_csv(orders, path)
    return tables.read_csv(spark, path, schema=orders.schema)


@query("parquet_scan", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size >= 25")
def _scan(spark, folder):
    part = tables.load_table(spark, f"{folder}/part.parquet")
    return part.where(F.col("p_size") >= 25).select("p_partkey", "p_brand", "p_size")


@query("xy_select", "SELECT l_quantity, l_discount, l_extendedprice AS label FROM lineitem")
def _xy(spark, folder):
    return tables.load_training(spark, f"{folder}/lineitem.parquet", "l_extendedprice", ["l_quantity", "l_discount"])


@query("dataset_metadata", """
SELECT CAST(6 AS INTEGER) AS n_features, 'p_partkey|p_name|p_brand|p_type|p_size|size, in cm' AS feature_names, count(*) AS n_rows
FROM part
""")
def _metadata(spark, folder):
    part = table(spark, folder, "part").withColumn("size, in cm", F.col("p_size"))
    return tables.dataset_metadata(part, "p_retailprice").withColumn("feature_names", F.array_join("feature_names", "|"))


@query("split_sink_roundtrip", f"""
SELECT o_orderkey, o_totalprice, CASE WHEN place > 1500 THEN 'train' ELSE 'test' END AS part FROM
  (SELECT *, row_number() OVER (ORDER BY {ORDER_42}) AS place FROM orders)
""")
def _split_sink(spark, folder):
    labelled = split.label_holdout(_orders(spark, folder), ["o_orderkey"], 1500)
    path = tables.write_splits(labelled, scratch_path(spark, "splits"), version=1)
    halves = [
        tables.read_split(spark, path, part).select("o_orderkey", "o_totalprice", F.lit(part).alias("part"))
        for part in ("train", "test")
    ]
    return halves[0].unionByName(halves[1])


@query("processed_sink_roundtrip", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _processed(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return tables.load_table(spark, tables.write_processed(part, scratch_path(spark, "processed"), "train", 1))


@query("json_report_roundtrip", union_sql(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum FROM part"""
    for c in PART_NUMBERS
))
def _json(spark, folder):
    report = quality.value_ranges(table(spark, folder, "part"))
    path = scratch_path(spark, "report")
    reports.write_report(report, path)
    return reports.read_report(spark, path, report.schema)


# --- cleaning --------------------------------------------------------------------


@query("cast_types", """
SELECT p_partkey, CAST(p_size AS VARCHAR) AS p_size, CAST(floor(p_retailprice) AS BIGINT) AS p_retailprice FROM part
""")
def _cast(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return clean.cast_types(part, {"p_size": "string", "p_retailprice": "bigint", "p_weight": "double"})


@query("drop_missing", f"SELECT * FROM {DIRTY_SQL} WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL")
def _drop_missing(spark, folder):
    return clean.drop_missing(dirty_lineitem(spark, folder))


def _imputed(spark, folder, columns, strategy, constant=None):
    dirty = dirty_lineitem(spark, folder)
    return clean.impute(dirty, clean.fill_values(dirty, columns, strategy, constant))


KEY_SQL = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
IMPUTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_tax"]


@query("impute_mean", f"""
SELECT {KEY_SQL}, round(coalesce(l_discount, (SELECT avg(l_discount) FROM {DIRTY_SQL})), 6) AS l_discount,
       round(coalesce(l_tax, (SELECT avg(l_tax) FROM {DIRTY_SQL})), 6) AS l_tax FROM {DIRTY_SQL}
""")
def _mean(spark, folder):
    return rounded(_imputed(spark, folder, ["l_discount", "l_tax"], "mean").select(*IMPUTED), 6)


@query("impute_median", f"""
SELECT {KEY_SQL}, round(coalesce(l_discount, (SELECT median(l_discount) FROM {DIRTY_SQL})), 6) AS l_discount,
       round(coalesce(l_tax, (SELECT median(l_tax) FROM {DIRTY_SQL})), 6) AS l_tax FROM {DIRTY_SQL}
""")
def _median(spark, folder):
    return rounded(_imputed(spark, folder, ["l_discount", "l_tax"], "median").select(*IMPUTED), 6)


@query("impute_mode", f"""
SELECT {KEY_SQL}, coalesce(l_returnflag, (SELECT arg_min(v, (-n, v)) FROM
  (SELECT l_returnflag AS v, count(*) AS n FROM {DIRTY_SQL} WHERE l_returnflag IS NOT NULL GROUP BY 1))) AS l_returnflag
FROM {DIRTY_SQL}
""")
def _mode(spark, folder):
    return _imputed(spark, folder, ["l_returnflag"], "mode").select(*IMPUTED[:4], "l_returnflag")


@query("impute_constant", f"SELECT {KEY_SQL}, coalesce(l_returnflag, 'none') AS l_returnflag FROM {DIRTY_SQL}")
def _constant(spark, folder):
    return _imputed(spark, folder, ["l_returnflag"], "constant", "none").select(*IMPUTED[:4], "l_returnflag")


@query("dedup", f"SELECT DISTINCT * FROM {COPIES_SQL}")
def _dedup(spark, folder):
    return clean.deduplicate(copied_lineitem(spark, folder))


@query("dedup_wide", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def _dedup_wide(spark, folder):
    return clean.deduplicate(table(spark, folder, "documents").select("text", "lang", "source", "n_chars"), two_phase=True)


@query("dedup_keep", f"SELECT * FROM {COPIES_SQL}")
def _dedup_keep(spark, folder):
    return clean.deduplicate(copied_lineitem(spark, folder), strategy="keep")


@query("age_from_year", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST((SELECT max(year(o_orderdate)) FROM orders) - year(o_orderdate) AS INTEGER) AS age FROM orders
""")
def _age(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return clean.age_from_year(orders)


@query("age_from_today", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(year(current_date) - year(o_orderdate) AS INTEGER) AS age FROM orders
""")
def _age_today(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return clean.age_from_today(orders)


@query("nan_to_null", """
SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_retailprice END AS p_retailprice, p_size FROM part
""")
def _nan(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") >= 10, F.col("p_retailprice")).otherwise(F.lit(float("nan"))).alias("p_retailprice"),
        "p_size",
    )
    return nan_to_null(part)


@query("split_valid", """
SELECT CASE WHEN c_acctbal >= 0 AND c_nationkey BETWEEN 2 AND 20 THEN 'accepted' ELSE 'quarantined' END AS part,
       count(*) AS n, round(avg(c_acctbal), 6) AS balance FROM customer GROUP BY 1
""")
def _split_valid(spark, folder):
    rules = [quality.between("c_acctbal", 0), quality.between("c_nationkey", 2, 20)]
    good, bad = quality.split_valid(table(spark, folder, "customer"), rules)
    both = [
        f.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.avg("c_acctbal").alias("balance")).where("n > 0")
        for name, f in (("accepted", good), ("quarantined", bad))
    ]
    return rounded(both[0].unionByName(both[1]), 6)


@query("drop_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _drop_columns(spark, folder):
    return clean.drop_columns(table(spark, folder, "part"), ["p_name", "p_brand", "p_type", "p_weight"])


CHAIN = clean.CleaningPlan(
    types={"l_linenumber": "string"},
    year_column="year",
    drop=("year", "l_linestatus", "not_there"),
)
CHAIN_INPUT_SQL = """(SELECT l_returnflag, l_linestatus, l_linenumber, l_quantity,
    nullif(l_discount, 0) AS l_discount, year(l_shipdate) AS year FROM lineitem)"""


def _chain_input(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.year("l_shipdate").alias("year"),
    )


@query("clean_chain", f"""
SELECT l_returnflag, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_quantity, l_discount,
       CAST(max(year) OVER () - year AS INTEGER) AS age
FROM (SELECT DISTINCT * FROM {CHAIN_INPUT_SQL} WHERE l_discount IS NOT NULL)
""")
def _chain(spark, folder):
    return clean.clean(_chain_input(spark, folder), CHAIN)


@query("cleaning_report", f"""
WITH i AS (SELECT * FROM {CHAIN_INPUT_SQL}), c AS (SELECT * FROM i WHERE l_discount IS NOT NULL),
     d AS (SELECT DISTINCT * FROM c)
SELECT 'input' AS step, (SELECT count(*) FROM i) AS "rows", CAST(6 AS BIGINT) AS "columns"
UNION ALL SELECT 'missing_values', (SELECT count(*) FROM c), 6
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM d), 6
UNION ALL SELECT 'final', (SELECT count(*) FROM d), 5
""")
def _cleaning_report(spark, folder):
    return clean.cleaning_report(_chain_input(spark, folder), CHAIN)


@query("clean_chain_imputed", f"""
WITH t AS (SELECT l_quantity, l_discount, l_returnflag, l_linestatus FROM {DIRTY_SQL}),
f AS (SELECT median(l_discount) AS d, (SELECT l_returnflag FROM t WHERE l_returnflag IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, l_returnflag LIMIT 1) AS w FROM t)
SELECT DISTINCT l_quantity, round(coalesce(l_discount, d), 6) AS l_discount, coalesce(l_returnflag, w) AS l_returnflag, l_linestatus
FROM t, f
""")
def _chain_imputed(spark, folder):
    dirty = dirty_lineitem(spark, folder).select("l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    return rounded(clean.clean(dirty, clean.CleaningPlan(missing="median")), 6)


@query("narrow_types", """
SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, CAST(p_size AS TINYINT) AS p_size, p_retailprice FROM part
""")
def _narrow(spark, folder):
    return clean.narrow_types(table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice"))


# --- splits ------------------------------------------------------------------------

ORDER_HASH = f"md5({key_sql(['o_orderkey'])})"
WORD_SQL = "CAST(('0x' || substr({hash}, 1, 13)) AS BIGINT)"


def uniform_sql(hashed: str) -> str:
    return f"(CAST({WORD_SQL.format(hash=hashed)} AS DOUBLE) / 4503599627370496.0)"


def fold_sql(hashed: str, k: int) -> str:
    return f"CAST({WORD_SQL.format(hash=hashed)} % {k} AS INTEGER)"


@query("holdout_exact_n", f"""
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {ORDER_42}) <= 1500
                        THEN 'test' ELSE 'train' END AS split FROM orders
""")
def _holdout(spark, folder):
    return split.label_holdout(_orders(spark, folder), ["o_orderkey"], 1500).select("o_orderkey", "split")


@query("holdout_check", """
SELECT count(*) - 1500 AS train_rows, CAST(1500 AS BIGINT) AS test_rows, CAST(0 AS BIGINT) AS overlap,
       count(*) AS source_rows, true AS passed FROM orders
""")
def _holdout_check(spark, folder):
    orders = _orders(spark, folder)
    train, test = split.holdout(orders, ["o_orderkey"], 1500)
    return split.split_check(orders, train, test, ["o_orderkey"])


@query("fraction_split", f"""
SELECT o_orderkey, CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.7 + 0.15 THEN 'dev' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {uniform_sql(ORDER_HASH.format(seed=42))} AS u FROM orders)
""")
def _fraction(spark, folder):
    shares = {"train": 0.7, "dev": 0.15, "test": 0.15}
    return split.fraction_labels(_orders(spark, folder), ["o_orderkey"], shares).select("o_orderkey", "split")


@query("kfold_hash", f"SELECT o_orderkey, {fold_sql(ORDER_HASH.format(seed=42), 5)} AS fold FROM orders")
def _kfold(spark, folder):
    return split.hash_folds(_orders(spark, folder), ["o_orderkey"], 5).select("o_orderkey", "fold")


@query("kfold_contiguous", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders")
def _contiguous(spark, folder):
    return split.contiguous_folds(_orders(spark, folder), "o_orderkey", 7).select("o_orderkey", "fold")


@query("kfold_contiguous_large", """
SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders
""")
def _contiguous_large(spark, folder):
    """Keys beyond the integers that doubles tell apart."""
    orders = _orders(spark, folder).withColumn("key", F.col("o_orderkey") + F.lit(2**60))
    return split.contiguous_folds(orders, "key", 7).select("o_orderkey", "fold")


@query("learning_subsets", f"""
SELECT o_orderkey, {fold_sql(ORDER_HASH.format(seed=42), 5)} AS fold,
       CAST(u >= 0.1 AS INTEGER) + CAST(u >= 0.325 AS INTEGER) + CAST(u >= 0.55 AS INTEGER) + CAST(u >= 0.775 AS INTEGER) AS step
FROM (SELECT *, {uniform_sql(ORDER_HASH.format(seed='subset42'))} AS u FROM orders)
""")
def _subsets(spark, folder):
    return split.learning_subsets(_orders(spark, folder), ["o_orderkey"]).select("o_orderkey", "fold", "step")


# --- features ------------------------------------------------------------------------


@query("log1p", "SELECT p_partkey, round(ln(1 + p_size), 6) AS p_size_log, round(ln(1 + p_retailprice), 6) AS p_retailprice_log FROM part")
def _log1p(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(features.log_transform(part, ["p_size", "p_retailprice"]), 6)


@query("sqrt", "SELECT p_partkey, p_size, round(sqrt(p_size), 6) AS p_size_sqrt FROM part")
def _sqrt(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    return rounded(features.sqrt_transform(part, ["p_size"], drop_original=False), 6)


@query("transform_chain", "SELECT p_partkey, round(ln(1 + p_retailprice), 6) AS p_retailprice_log, round(sqrt(p_size), 6) AS p_size_sqrt FROM part")
def _transform(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(features.transform_features(part, ["p_retailprice"], ["p_size"]), 6)


@query("expm1", "SELECT p_partkey, round(exp(ln(1 + p_size)) - 1, 6) AS p_size_log_expm1 FROM part")
def _expm1(spark, folder):
    logged = features.log_transform(table(spark, folder, "part").select("p_partkey", "p_size"), ["p_size"])
    return rounded(features.inverse_log(logged, ["p_size_log"]).drop("p_size_log"), 6)


CATEGORY_SQL = union_sql(
    f"""SELECT '{c}' AS "column", CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS position, v AS category
    FROM (SELECT DISTINCT {c} AS v FROM orders)""" for c in ("o_orderstatus", "o_orderpriority")
)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("onehot_fit", CATEGORY_SQL)
def _onehot_fit(spark, folder):
    return features.fit_encoder(_orders(spark, folder)).to_table(spark)


@query("onehot_apply", "SELECT o_orderkey, " + ", ".join(
    f"""CASE WHEN o_orderpriority = '{p}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "o_orderpriority_{p}" """
    for p in PRIORITIES
) + " FROM orders")
def _onehot(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey", "o_orderpriority")
    return features.fit_encoder(orders).one_hot(orders)


@query("onehot_unseen", """
SELECT p_partkey, CASE WHEN p_type = t THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_type_first
FROM part, (SELECT min(p_type) AS t FROM part WHERE p_size < 2)
""")
def _unseen(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_size")
    fitted = features.fit_encoder(part.where("p_size < 2"), ["p_type"])
    first = Encoder({"p_type": fitted.categories["p_type"][:1]})
    return first.one_hot(part).select("p_partkey", F.col(f"`{first.flag_names()[0]}`").alias("p_type_first"))


@query("label_encode", """
SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_index
FROM orders
""")
def _label(spark, folder):
    orders = _orders(spark, folder).select("o_orderkey", "o_orderpriority")
    return features.fit_encoder(orders).label(orders)


SCALED = ["p_size", "p_retailprice"]


@query("scale_fit", union_sql(
    f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS centre, round(stddev_pop({c}), 6) AS spread FROM part""" for c in SCALED
))
def _scale_fit(spark, folder):
    return rounded(features.fit_scaler(table(spark, folder, "part"), SCALED).to_table(spark), 6)


@query("scale_apply", "SELECT p_partkey, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0::DOUBLE AS {c}" for c in SCALED
) + " FROM part")
def _scale(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", *SCALED)
    return rounded(features.fit_scaler(part, SCALED).apply(part), 6)


@query("minmax", "SELECT p_partkey, " + ", ".join(
    f"round(({c} - min({c}) OVER ()) / CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE), 6) AS {c}" for c in SCALED
) + " FROM part")
def _minmax(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", *SCALED)
    return rounded(features.fit_scaler(part, SCALED, "normalization").apply(part), 6)


@query("encoder_roundtrip", CATEGORY_SQL)
def _encoder_roundtrip(spark, folder):
    path = scratch_path(spark, "encoder")
    features.fit_encoder(_orders(spark, folder)).to_table(spark).write.parquet(path)
    return Encoder.from_table(spark.read.parquet(path)).to_table(spark)


@query("onehot_wide", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS position, (SELECT count(DISTINCT p_name) FROM part) AS size FROM part
""")
def _onehot_wide(spark, folder):
    """A column of very many categories: one sparse vector per row."""
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    positions = features.fit_positions(part, "p_name")
    coded = features.one_hot_vector(part, "p_name", positions, "v")
    parts = F.unwrap_udt("v")
    return coded.select(
        "p_partkey", parts["indices"][0].cast("bigint").alias("position"), parts["size"].cast("bigint").alias("size"))


@query("scaler_roundtrip", "SELECT p_partkey, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0::DOUBLE AS {c}" for c in SCALED
) + " FROM part")
def _scaler_roundtrip(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", *SCALED)
    path = scratch_path(spark, "scaler")
    features.fit_scaler(part, SCALED).to_table(spark).write.parquet(path)
    return rounded(Scaler.from_table(spark.read.parquet(path)).apply(part), 6)


@query("feature_select", "SELECT p_partkey, p_size, p_retailprice FROM part")
def _select(spark, folder):
    return features.select_features(table(spark, folder, "part"), ["p_size", "p_retailprice"], ["p_partkey"])


@query("dtype_selectors", """
SELECT 'part' AS "table", count(*) FILTER (column_type IN ('BIGINT', 'INTEGER', 'DOUBLE')) AS numeric_columns,
       count(*) FILTER (column_type = 'VARCHAR') AS string_columns, (SELECT count(*) FROM part) AS n_rows
FROM (DESCRIBE part)
""")
def _selectors(spark, folder):
    part = table(spark, folder, "part")
    counted = part.agg(F.count("*").alias("n_rows"))
    return counted.select(
        F.lit("part").alias("table"),
        F.lit(len(features.scaling_columns(part))).cast("bigint").alias("numeric_columns"),
        F.lit(len(features.string_columns(part))).cast("bigint").alias("string_columns"),
        "n_rows",
    )
