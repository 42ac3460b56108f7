"""Derived inputs, as a DataFrame and as the SQL that gives the same rows.

The test tables have no missing cells and no copies, so dirt is made from the
whole tables by the same rule on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.workload.registry import table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def key_sql(columns: list[str], seed: int | str = "{seed}") -> str:
    """The text behind the digest of a row key."""
    parts = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in columns]
    return f"concat_ws('|', {', '.join(parts)}, '{seed}')"


LINE_KEY_SQL = key_sql(LINE_KEY)
ORDER_42, ORDER_7 = (f"md5({key_sql(['o_orderkey'], seed)})" for seed in (42, 7))

DIRTY_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
    nullif(l_returnflag, 'A') AS l_returnflag, l_linestatus FROM lineitem)"""

COPIES_SQL = "(SELECT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem)"

PREDICTIONS_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
    1000 * l_quantity * (1 - l_discount) + 0.01 * l_extendedprice AS label,
    950 * l_quantity AS prediction FROM lineitem)"""

# Three rival models with fixed coefficients.
MODELS = {"base": (900.0, 0.0), "plain": (950.0, 0.0), "shifted": (950.0, 500.0)}
MODEL_PREDICTIONS_SQL = "(" + " UNION ALL ".join(
    f"""SELECT '{m}' AS model, l_orderkey, l_partkey, l_suppkey, l_linenumber,
    1000 * l_quantity * (1 - l_discount) + 0.01 * l_extendedprice AS label,
    {a} * l_quantity + {b} AS prediction FROM lineitem"""
    for m, (a, b) in MODELS.items()
) + ")"


def dirty_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    def unless(column: str, value):
        return F.when(F.col(column) != F.lit(value), F.col(column)).alias(column)

    return table(spark, folder, "lineitem").select(
        *LINE_KEY, "l_quantity", unless("l_discount", 0.0), unless("l_tax", 0.0),
        unless("l_returnflag", "A"), "l_linestatus",
    )


# Events whose values are infinite in one direction or the other, or NaN, by their number.
ODD_SQL = """(SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'inf'::DOUBLE WHEN event_id % 97 = 1 THEN '-inf'::DOUBLE
    WHEN event_id % 97 = 2 THEN 'nan'::DOUBLE ELSE value END AS value FROM events)"""


def odd_events(spark: SparkSession, folder: str) -> DataFrame:
    place = F.col("event_id") % 97
    planted = (
        F.when(place == 0, F.lit(float("inf"))).when(place == 1, F.lit(float("-inf"))).when(place == 2, F.lit(float("nan")))
    )
    return table(spark, folder, "events").select("event_id", planted.otherwise(F.col("value")).alias("value"))


def copied_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")


def label_column():
    return F.lit(1000) * F.col("l_quantity") * (F.lit(1) - F.col("l_discount")) + F.lit(0.01) * F.col(
        "l_extendedprice"
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *LINE_KEY, "l_returnflag", label_column().alias("label"), (F.lit(950) * F.col("l_quantity")).alias("prediction")
    )


def model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """All models over one scan: an array of predictions, exploded."""
    models = F.array(*[
        F.struct(F.lit(m).alias("model"), (F.lit(a) * F.col("l_quantity") + F.lit(b)).alias("prediction"))
        for m, (a, b) in MODELS.items()
    ])
    return (
        table(spark, folder, "lineitem")
        .select(*LINE_KEY, label_column().alias("label"), F.explode(models).alias("m"))
        .select("m.model", *LINE_KEY, "label", "m.prediction")
    )


def line_features(spark: SparkSession, folder: str) -> DataFrame:
    """Model table: key, numeric features and a label with a known signal."""
    return table(spark, folder, "lineitem").select(
        *LINE_KEY, "l_quantity", "l_extendedprice", "l_discount", "l_tax", label_column().alias("label")
    )
