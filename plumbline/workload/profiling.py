"""Queries: quality checks, descriptive statistics and plot data."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from plumbline.functions.columns import small_table
from plumbline.operators import clean, describe, plotdata, quality, ranks
from plumbline.operators.quantiles import quantiles
from plumbline.workload.inputs import (
    ODD_SQL,
    odd_events,
    ORDER_42,
    COPIES_SQL,
    DIRTY_SQL,
    PREDICTIONS_SQL,
    copied_lineitem,
    dirty_lineitem,
    predictions,
)
from plumbline.workload.registry import query, rounded, table, union_sql

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PART_NUMBERS = ["p_partkey", "p_size", "p_retailprice"]


# --- quality -----------------------------------------------------------------


@query("dq_shape", """
SELECT 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS "column", count(*) > 0 AS passed,
       CAST(count(*) AS DOUBLE) AS value FROM part
UNION ALL
SELECT 'many_rows_and_columns', NULL, count(*) > 1, CAST(count(*) AS DOUBLE) FROM part
""")
def _shape(spark, folder):
    return quality.shape_checks(table(spark, folder, "part"))


@query("dq_negative", union_sql(
    f"""SELECT 'no_negative' AS "check", '{c}' AS "column", min({c}) >= 0 AS passed,
    CAST(min({c}) AS DOUBLE) AS value FROM customer""" for c in ("c_custkey", "c_nationkey", "c_acctbal")
))
def _negative(spark, folder):
    return quality.negative_check(table(spark, folder, "customer"))


@query("dq_infinite", union_sql(
    f"""SELECT 'no_infinite' AS "check", '{c}' AS "column", count(*) FILTER (isinf(CAST({c} AS DOUBLE))) = 0 AS passed,
    CAST(count(*) FILTER (isinf(CAST({c} AS DOUBLE))) AS DOUBLE) AS value FROM {ODD_SQL}"""
    for c in ("event_id", "value")
))
def _infinite(spark, folder):
    return quality.infinite_check(odd_events(spark, folder))


@query("dq_expected_columns", """
SELECT 'expected_column' AS "check", 'p_partkey' AS "column", true AS passed, CAST(count(p_partkey) AS DOUBLE) AS value FROM part
UNION ALL SELECT 'expected_column', 'p_size', true, CAST(count(p_size) AS DOUBLE) FROM part
UNION ALL SELECT 'expected_column', 'p_weight', false, 0.0::DOUBLE
""")
def _expected(spark, folder):
    return quality.expected_columns_check(table(spark, folder, "part"), ["p_partkey", "p_size", "p_weight"])


@query("dq_target", """
SELECT 'target_present' AS "check", 'p_retailprice' AS "column", true AS passed, CAST(count(p_retailprice) AS DOUBLE) AS value
FROM part
""")
def _target(spark, folder):
    return quality.target_check(table(spark, folder, "part"), "p_retailprice")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "currency"]


@query("dq_constant", union_sql(
    f"""SELECT 'not_constant' AS "check", '{c}' AS "column", count(DISTINCT {c}) <> 1 AS passed,
    CASE WHEN count(DISTINCT {c}) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
    FROM (SELECT *, 'EUR' AS currency FROM orders)""" for c in ORDER_COLUMNS
))
def _constant(spark, folder):
    return quality.constant_check(table(spark, folder, "orders").withColumn("currency", F.lit("EUR")))


DIRTY_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query("dq_missing", "SELECT * FROM (" + union_sql(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
    round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS percent FROM {DIRTY_SQL}""" for c in DIRTY_COLUMNS
) + ") WHERE missing > 0")
def _missing(spark, folder):
    return rounded(quality.missing_summary(dirty_lineitem(spark, folder)), 6)


@query("dq_missing_severity", "SELECT *, CASE WHEN share >= 0.3 THEN 'critical' WHEN share >= 0.1 THEN 'warning' "
       "ELSE 'ok' END AS severity FROM (" + union_sql(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
    round((count(*) - count({c}))::DOUBLE / count(*), 6) AS share FROM {DIRTY_SQL}""" for c in DIRTY_COLUMNS
) + ")")
def _severity(spark, folder):
    return rounded(quality.missing_severity(dirty_lineitem(spark, folder)), 6)


@query("dq_duplicates", f"""
SELECT CAST(sum(n) AS BIGINT) AS "rows", count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates
FROM (SELECT count(*) AS n FROM {COPIES_SQL} GROUP BY ALL l_returnflag, l_linestatus, l_quantity, l_discount)
""".replace("GROUP BY ALL ", "GROUP BY "))
def _duplicates(spark, folder):
    return quality.duplicate_count(copied_lineitem(spark, folder))


@query("dq_duplicates_wide", """
SELECT count(*) AS "rows", count(DISTINCT (text, lang, source, n_chars)) AS distinct_rows,
       count(*) - count(DISTINCT (text, lang, source, n_chars)) AS duplicates FROM documents""")
def _duplicates_wide(spark, folder):
    """Whole documents without their id, told apart by digests first."""
    return quality.duplicate_count(table(spark, folder, "documents"), ["text", "lang", "source", "n_chars"], two_phase=True)


def _iqr_sql(columns, source):
    return union_sql(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < lo OR {c} > hi) AS outliers,
        round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound
        FROM {source}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
          (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM
            (SELECT CAST({c} AS DOUBLE) AS {c} FROM {source})))"""
        for c in columns
    )


@query("dq_outliers_iqr", _iqr_sql(["value", "user_id"], "events"))
def _outliers(spark, folder):
    return rounded(quality.outlier_summary(table(spark, folder, "events"), ["value", "user_id"]), 6)


@query("dq_outliers_zscore", f"""
SELECT 'value' AS "column", count(*) FILTER (NOT isnan(value) AND (value < m - 3 * s OR value > m + 3 * s)) AS outliers,
       round(any_value(m - 3 * s), 6) AS lower_bound, round(any_value(m + 3 * s), 6) AS upper_bound
FROM {ODD_SQL}, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM {ODD_SQL} WHERE isfinite(value))
""")
def _zscore(spark, folder):
    return rounded(quality.outlier_summary(odd_events(spark, folder), ["value"], method="zscore"), 6)


QUANTILE_PLACES = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)


@query("quantiles_infinite", union_sql(
    f"""SELECT {p}::DOUBLE AS p, round(quantile_cont(value, {p}), 6) AS value FROM {ODD_SQL} WHERE NOT isnan(value)"""
    for p in QUANTILE_PLACES
))
def _quantiles_infinite(spark, folder):
    found = quantiles(odd_events(spark, folder), ["value"], QUANTILE_PLACES)["value"]
    return rounded(small_table(spark, list(zip(QUANTILE_PLACES, found)), "p double, value double"), {"value": 6})


@query("dq_rules_missing", f"""
SELECT event_id, NOT isnan(value) AND value >= 0 AS valid,
       CASE WHEN NOT isnan(value) AND value >= 0 THEN '' ELSE 'value_range' END AS violations FROM {ODD_SQL}
""")
def _rules_missing(spark, folder):
    checked = quality.apply_rules(odd_events(spark, folder), [quality.between("value", 0)])
    return checked.select("event_id", "valid", F.concat_ws(",", "violations").alias("violations"))


@query("dq_cap_outliers", f"""
SELECT event_id, CASE WHEN NOT isnan(value) THEN round(greatest(lo, least(hi, value)), 6) END AS value
FROM {ODD_SQL}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM {ODD_SQL} WHERE NOT isnan(value)))
""")
def _cap(spark, folder):
    events = odd_events(spark, folder)
    return rounded(quality.cap_outliers(events, quality.iqr_bounds(events, ["value"])), 6)


@query("dq_range", union_sql(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum FROM part"""
    for c in PART_NUMBERS
))
def _range(spark, folder):
    return quality.value_ranges(table(spark, folder, "part"))


def _report_sql(outliers=True):
    numeric = ["c_custkey", "c_nationkey", "c_acctbal"]
    columns = [*numeric, "c_name", "c_mktsegment"]
    parts = [
        """SELECT 'not_empty' AS "check", CAST(NULL AS VARCHAR) AS "column", count(*) > 0 AS passed,
        CAST(count(*) AS DOUBLE) AS value FROM customer""",
        "SELECT 'many_rows_and_columns', NULL, count(*) > 1, CAST(count(*) AS DOUBLE) FROM customer",
        """SELECT 'duplicates', NULL, true, CAST(sum(n) - count(*) AS DOUBLE) FROM
        (SELECT count(*) AS n FROM customer GROUP BY c_custkey, c_nationkey, c_acctbal, c_name, c_mktsegment)""",
        "SELECT 'expected_column', 'c_acctbal', true, CAST(count(c_acctbal) AS DOUBLE) FROM customer",
        "SELECT 'target_present', 'c_acctbal', true, CAST(count(c_acctbal) AS DOUBLE) FROM customer",
    ]
    for c in numeric:
        parts += [
            f"SELECT 'no_negative', '{c}', min({c}) >= 0, CAST(min({c}) AS DOUBLE) FROM customer",
            f"SELECT 'no_infinite', '{c}', true, 0.0::DOUBLE",
        ]
    for c in columns:
        parts += [
            f"""SELECT 'not_constant', '{c}', count(DISTINCT {c}) <> 1,
            CASE WHEN count(DISTINCT {c}) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM customer""",
            f"SELECT 'missing', '{c}', true, CAST(count(*) - count({c}) AS DOUBLE) FROM customer",
        ]
    if outliers:
        parts.append(
            f"""SELECT 'outliers', "column", true, CAST(outliers AS DOUBLE) FROM ({_iqr_sql(numeric, 'customer')})"""
        )
    return union_sql(parts)


@query("dq_report", _report_sql())
def _report(spark, folder):
    return quality.quality_report(table(spark, folder, "customer"), ["c_acctbal"], "c_acctbal")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


@query("dq_record_rules", f"""
SELECT c_custkey,
       array_to_string(list_filter([
         CASE WHEN NOT (c_acctbal >= 0) THEN 'c_acctbal_range' END,
         CASE WHEN NOT (c_nationkey >= 2 AND c_nationkey <= 20) THEN 'c_nationkey_range' END,
         CASE WHEN c_mktsegment NOT IN ({", ".join(f"'{s}'" for s in SEGMENTS)}) THEN 'c_mktsegment_allowed' END
       ], lambda x: x IS NOT NULL), ',') AS violations,
       c_acctbal >= 0 AND c_nationkey >= 2 AND c_nationkey <= 20
         AND c_mktsegment IN ({", ".join(f"'{s}'" for s in SEGMENTS)}) AS valid
FROM customer
""")
def _rules(spark, folder):
    rules = [
        quality.between("c_acctbal", 0),
        quality.between("c_nationkey", 2, 20),
        quality.one_of("c_mktsegment", SEGMENTS),
    ]
    checked = quality.apply_rules(table(spark, folder, "customer"), rules)
    return checked.select("c_custkey", F.concat_ws(",", "violations").alias("violations"), "valid")


@query("dq_flag_rules", """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       count(*) FILTER (l_returnflag IN ('A', 'N') AND l_linestatus = 'O') AS broken
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def _flag_rules(spark, folder):
    flagged = table(spark, folder, "lineitem").select(
        "l_returnflag",
        "l_linestatus",
        F.col("l_returnflag").isin("A", "N").cast("int").alias("early"),
        (F.col("l_linestatus") == "O").cast("int").alias("open"),
    )
    checked = quality.apply_rules(flagged, quality.flags(["early", "open"], at_most_one="one_state"))
    return checked.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count_if(~F.col("valid")).alias("broken")
    )


# --- descriptive statistics ------------------------------------------------------


def _summary_sql(columns, source, places):
    def r(expression, name):
        return f"round({expression}, {places.get(name, 4)}) + 0.0::DOUBLE AS {name}"

    return union_sql(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
        {r(f'CAST(min({c}) AS DOUBLE)', 'min')}, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 'p25')},
        {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'p50')}, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 'p75')},
        {r(f'CAST(max({c}) AS DOUBLE)', 'max')}, {r(f'var_samp({c})', 'variance')}, {r(f'skewness({c})', 'skewness')},
        {r(f'kurtosis({c})', 'kurtosis')} FROM {source}"""
        for c in columns
    )


# Prices have a variance near 1e9, of which two engines share about 13 digits.
WIDE_PLACES = {"variance": 2, "skewness": 8, "kurtosis": 8}
SUMMARY_PLACES = {c: 8 for c in ("mean", "std", "p25", "p50", "p75", "variance", "skewness", "kurtosis")}


@query("numeric_summary", union_sql([
    _summary_sql(["l_extendedprice"], "lineitem", WIDE_PLACES),
    _summary_sql(["l_quantity", "l_discount", "l_tax"], "lineitem", SUMMARY_PLACES),
]))
def numeric_summary(spark, folder):
    found = describe.numeric_summary(table(spark, folder, "lineitem"), LINE_NUMBERS)
    wide = F.col("column") == "l_extendedprice"
    digits = {c: (WIDE_PLACES.get(c, 4), SUMMARY_PLACES.get(c, 4)) for c, t in found.dtypes if t == "double"}
    return found.withColumns({
        c: F.when(wide, F.round(F.col(c), w)).otherwise(F.round(F.col(c), n)) + F.lit(0.0) for c, (w, n) in digits.items()
    })


@query("numeric_summary_dirty", _summary_sql(["l_discount", "l_tax"], DIRTY_SQL, SUMMARY_PLACES))
def _dirty_summary(spark, folder):
    found = describe.numeric_summary(dirty_lineitem(spark, folder), ["l_discount", "l_tax"])
    places = {c: SUMMARY_PLACES.get(c, 4) for c, t in found.dtypes if t == "double"}
    return rounded(found, places)


def _categorical_sql(columns, source):
    return union_sql(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
        arg_min(v, (-n, v)) AS top, max(n) AS freq
        FROM (SELECT {c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in columns
    )


@query("categorical_summary", _categorical_sql(["o_orderstatus", "o_orderpriority"], "orders"))
def _categorical(spark, folder):
    return describe.categorical_summary(table(spark, folder, "orders"))


@query("distinct_counts", union_sql(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM part"""
    for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
))
def _distinct(spark, folder):
    return describe.distinct_counts(table(spark, folder, "part"))


@query("value_share", """
SELECT p_type AS value, count(*) AS "count", round(count(*)::DOUBLE / (SELECT count(p_type) FROM part), 6) AS share
FROM part GROUP BY p_type
""")
def _share(spark, folder):
    return rounded(describe.value_share(table(spark, folder, "part"), "p_type"), 6)


@query("missing_total", f"""
SELECT CAST({" + ".join(f"(count(*) - count({c}))" for c in DIRTY_COLUMNS)} AS BIGINT) AS before,
       CAST(count(*) - count(l_returnflag) AS BIGINT) AS after
FROM {DIRTY_SQL}
""")
def _missing_total(spark, folder):
    dirty = dirty_lineitem(spark, folder)
    counted = dirty.withColumn("before", describe.missing_cells(dirty))
    filled = clean.impute(counted, {"l_discount": 0.5, "l_tax": 0.5})
    return filled.agg(F.sum("before").alias("before"), F.sum(describe.missing_cells(filled, dirty.columns)).alias("after"))


# --- plot data -----------------------------------------------------------------


def _histogram_sql(c, source, bins):
    return f"""
WITH e AS (SELECT min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {source})),
     b AS (SELECT least(CAST(floor(({c} - lo) / w) AS INTEGER), {bins - 1}) AS bin, count(*) AS n
           FROM {source}, e GROUP BY 1)
SELECT '{c}' AS "column", CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) + 0.0::DOUBLE AS left_edge,
       round(lo + (g.bin + 1) * w, 6) + 0.0::DOUBLE AS right_edge, coalesce(n, 0) AS "count"
FROM (SELECT unnest(range({bins})) AS bin) g, e LEFT JOIN b ON b.bin = g.bin"""


@query("histogram", _histogram_sql("value", "events", 30))
def _histogram(spark, folder):
    return rounded(plotdata.histogram(table(spark, folder, "events"), ["value"], bins=30), 6)


@query("histogram_auto", """
WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1,
                  quantile_cont(value, 0.75) AS q3 FROM events),
     k AS (SELECT *, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * (q3 - q1) * pow(n, -1.0 / 3))) AS INTEGER)
           AS bins FROM s),
     e AS (SELECT lo, (hi - lo) / bins AS w, bins FROM k),
     b AS (SELECT least(CAST(floor((value - lo) / w) AS INTEGER), bins - 1) AS bin, count(*) AS n
           FROM events, e GROUP BY 1)
SELECT 'value' AS "column", CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) + 0.0::DOUBLE AS left_edge,
       round(lo + (g.bin + 1) * w, 6) + 0.0::DOUBLE AS right_edge, coalesce(n, 0) AS "count"
FROM (SELECT unnest(range(bins)) AS bin FROM k) g, e LEFT JOIN b ON b.bin = g.bin
""")
def _histogram_auto(spark, folder):
    return rounded(plotdata.histogram(table(spark, folder, "events"), ["value"]), 6)


def _kde_sql(points):
    return f"""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h
           FROM events),
     g AS (SELECT lo + i * (hi - lo) / {points - 1} AS x, n, h FROM s, (SELECT unnest(range({points})) AS i))
SELECT round(x, 6) + 0.0::DOUBLE AS x, round(sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8)
       + 0.0::DOUBLE AS density
FROM events, g GROUP BY x"""


@query("kde", _kde_sql(50))
def _kde(spark, folder):
    return rounded(plotdata.density(table(spark, folder, "events"), "value", points=50), {"x": 6, "density": 8})


@query("count_plot", union_sql(
    f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS "count" FROM orders GROUP BY {c}"""
    for c in ("o_orderstatus", "o_orderpriority")
))
def _count_plot(spark, folder):
    return plotdata.count_plot(table(spark, folder, "orders"))


def _pairs_sql(columns, template):
    return union_sql(template.format(a=a, b=b) for a, b in itertools.product(columns, repeat=2))


@query("corr_pearson", _pairs_sql(
    LINE_NUMBERS,
    "SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, round(corr({a}, {b}), 6) + 0.0::DOUBLE AS r FROM lineitem",
))
def _pearson(spark, folder):
    return rounded(ranks.correlation_matrix(table(spark, folder, "lineitem"), LINE_NUMBERS), 6)


def _rank_sql(c, source):
    return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"


@query("corr_spearman", "WITH r AS (SELECT " + ", ".join(
    f"{_rank_sql(c, 'lineitem')} AS {c}" for c in LINE_NUMBERS
) + " FROM lineitem)\n" + _pairs_sql(
    LINE_NUMBERS,
    "SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, round(corr({a}, {b}), 6) + 0.0::DOUBLE AS r FROM r",
))
def _spearman(spark, folder):
    return rounded(ranks.correlation_matrix(table(spark, folder, "lineitem"), LINE_NUMBERS, "spearman"), 6)


@query("corr_spearman_gaps", _pairs_sql(
    ["l_quantity", "l_discount", "l_tax"],
    "SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, round(corr(ra, rb), 6) + 0.0::DOUBLE AS r FROM (SELECT "
    "rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra, "
    "rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb "
    "FROM " + DIRTY_SQL + " WHERE {a} IS NOT NULL AND {b} IS NOT NULL)",
))
def _spearman_gaps(spark, folder):
    dirty = dirty_lineitem(spark, folder)
    return rounded(ranks.correlation_matrix(dirty, ["l_quantity", "l_discount", "l_tax"], "spearman"), 6)


def _box_sql(columns, source):
    return union_sql(
        f"""SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
        round(any_value(q3), 6) AS q3,
        min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS fliers
        FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {source}),
          (SELECT quantile_cont(w, 0.25) AS q1, quantile_cont(w, 0.5) AS q2, quantile_cont(w, 0.75) AS q3
           FROM (SELECT CAST({c} AS DOUBLE) AS w FROM {source}))"""
        for c in columns
    )


@query("box_stats", _box_sql(["value", "user_id"], "events"))
def _box(spark, folder):
    return rounded(plotdata.box_stats(table(spark, folder, "events"), ["value", "user_id"]), 6, ["q1", "median", "q3"])


@query("scatter_bins", """
WITH e AS (SELECT min(l_quantity) AS x0, (max(l_quantity) - min(l_quantity)) / 20 AS xw, min(l_extendedprice) AS y0,
           (max(l_extendedprice) - min(l_extendedprice)) / 20 AS yw FROM lineitem)
SELECT least(CAST(floor((l_quantity - x0) / xw) AS INTEGER), 19) AS x_bin,
       least(CAST(floor((l_extendedprice - y0) / yw) AS INTEGER), 19) AS y_bin, count(*) AS "count"
FROM lineitem, e GROUP BY 1, 2
""")
def _scatter_bins(spark, folder):
    return plotdata.scatter_bins(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", 20)


@query("scatter_points", f"""
SELECT o_custkey, o_totalprice FROM orders ORDER BY {ORDER_42} LIMIT 1000
""")
def _scatter_points(spark, folder):
    return plotdata.scatter_points(table(spark, folder, "orders"), "o_custkey", "o_totalprice", ["o_orderkey"])


def interval_sql(columns, source):
    return union_sql(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}) / sqrt(count({c})), 6) AS standard_error FROM {source}"""
        for c in columns
    )


@query("ci_bars", interval_sql(["p_size", "p_retailprice"], "part"))
def _bars(spark, folder):
    bars = plotdata.interval_bars(table(spark, folder, "part"), ["p_size", "p_retailprice"])
    return rounded(bars.drop("ci_low", "ci_high"), 6)


@query("residual_histogram", _histogram_sql("residual", f"(SELECT label - prediction AS residual FROM {PREDICTIONS_SQL})", 30))
def _residual_histogram(spark, folder):
    return rounded(plotdata.residual_histogram(predictions(spark, folder)), 6)
