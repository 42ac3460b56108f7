"""Queries: statistical tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import inference, ranks, split
from plumbline.workload.inputs import ORDER_7
from plumbline.workload.profiling import interval_sql
from plumbline.workload.registry import query, rounded, table

GROUPS_SQL = """(SELECT avg(l_extendedprice) FILTER (l_returnflag = 'A') AS ma, avg(l_extendedprice) FILTER (l_returnflag = 'R') AS mb,
  var_samp(l_extendedprice) FILTER (l_returnflag = 'A') AS va, var_samp(l_extendedprice) FILTER (l_returnflag = 'R') AS vb,
  var_pop(l_extendedprice) FILTER (l_returnflag = 'A') AS pa, var_pop(l_extendedprice) FILTER (l_returnflag = 'R') AS pb,
  count(*) FILTER (l_returnflag = 'A') AS na, count(*) FILTER (l_returnflag = 'R') AS nb FROM lineitem)"""


def _line(spark, folder):
    return table(spark, folder, "lineitem")


@query("ttest", f"""
SELECT round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)), 6) AS statistic,
       CAST(na + nb - 2 AS DOUBLE) AS df FROM {GROUPS_SQL}
""")
def _ttest(spark, folder):
    found = inference.t_test(_line(spark, folder), "l_extendedprice", "l_returnflag", ["A", "R"])
    return rounded(found.drop("p_value"), 6)


@query("ttest_welch", f"""
SELECT round((ma - mb) / sqrt(va / na + vb / nb), 6) AS statistic,
       round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)), 4) AS df FROM {GROUPS_SQL}
""")
def _welch(spark, folder):
    found = inference.t_test(_line(spark, folder), "l_extendedprice", "l_returnflag", ["A", "R"], equal_var=False)
    return rounded(found.drop("p_value"), {"statistic": 6, "df": 4})


@query("cohen_d", f"""
SELECT round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 6) AS effect_size FROM {GROUPS_SQL}
""")
def _cohen(spark, folder):
    return rounded(inference.cohen_d(_line(spark, folder), "l_extendedprice", "l_returnflag", ["A", "R"]), 6)


@query("cohen_d_population", f"""
SELECT round((ma - mb) / sqrt(((na - 1) * pa + (nb - 1) * pb) / (na + nb - 2)), 6) AS effect_size FROM {GROUPS_SQL}
""")
def _cohen_population(spark, folder):
    found = inference.cohen_d(_line(spark, folder), "l_extendedprice", "l_returnflag", ["A", "R"], ddof=0)
    return rounded(found, 6)


@query("chi2", """
WITH cells AS (SELECT l_returnflag AS a, l_shipmode AS b, count(*) AS o FROM
  (SELECT l_returnflag, CAST(l_linenumber AS VARCHAR) AS l_shipmode FROM lineitem) GROUP BY 1, 2),
 full_grid AS (SELECT r.a, c.b, r.n AS rn, c.n AS cn, coalesce(o, 0) AS o FROM
  (SELECT a, sum(o) AS n FROM cells GROUP BY a) r CROSS JOIN (SELECT b, sum(o) AS n FROM cells GROUP BY b) c
  LEFT JOIN cells ON cells.a = r.a AND cells.b = c.b)
SELECT round(x, 5) AS statistic, df, round(exp(-x / 2) * (1 + h + h * h / 2 + pow(h, 3) / 6 + pow(h, 4) / 24 + pow(h, 5) / 120), 8)
       AS p_value
FROM (SELECT *, x / 2 AS h FROM (
  SELECT sum(pow(o - rn::DOUBLE * cn / t, 2) / (rn::DOUBLE * cn / t)) AS x,
       CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS DOUBLE) AS df
  FROM full_grid, (SELECT sum(o) AS t FROM cells)))
""")
def _chi2(spark, folder):
    # With 12 degrees of freedom the tail is a finite sum.
    found = inference.chi_squared(_line(spark, folder), "l_returnflag", "l_linenumber")
    return rounded(found, {"statistic": 5, "p_value": 8})


@query("chi2_yates", """
WITH cells AS (SELECT l_quantity > 25 AS a, l_linestatus AS b, count(*) AS o FROM lineitem GROUP BY 1, 2),
 g AS (SELECT o, sum(o) OVER (PARTITION BY a) AS rn, sum(o) OVER (PARTITION BY b) AS cn, sum(o) OVER () AS t FROM cells)
SELECT round(sum(pow(abs(o - rn::DOUBLE * cn / t) - least(0.5, abs(o - rn::DOUBLE * cn / t)), 2) / (rn::DOUBLE * cn / t)), 6)
       AS statistic, 1.0::DOUBLE AS df FROM g
""")
def _yates(spark, folder):
    halves = _line(spark, folder).select((F.col("l_quantity") > 25).alias("large"), "l_linestatus")
    return rounded(inference.chi_squared(halves, "large", "l_linestatus").drop("p_value"), 6)


@query("anova", """
WITH g AS (SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) AS v FROM lineitem GROUP BY 1)
SELECT round(f, 6) AS statistic, df_between, df_within, round(pow(1 + 2 * f / df_within, -df_within / 2), 8) AS p_value
FROM (SELECT (sum(n * pow(m - (SELECT avg(l_extendedprice) FROM lineitem), 2)) / (count(*) - 1))
             / (sum((n - 1) * v) / (sum(n) - count(*))) AS f,
       CAST(count(*) - 1 AS DOUBLE) AS df_between, CAST(sum(n) - count(*) AS DOUBLE) AS df_within FROM g)
""")
def _anova(spark, folder):
    # Between three groups the tail has a closed form.
    found = inference.anova(_line(spark, folder), "l_extendedprice", "l_returnflag")
    return rounded(found, {"statistic": 6, "df_between": 6, "df_within": 6, "p_value": 8})


@query("corr_test", """
SELECT 'pearson' AS method, count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
UNION ALL
SELECT 'spearman', count(*), round(corr(a, b), 6) FROM (SELECT
  rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
""")
def _corr_test(spark, folder):
    line = _line(spark, folder)
    both = [inference.correlation_test(line, "l_quantity", "l_extendedprice", m) for m in ("pearson", "spearman")]
    return rounded(both[0].unionByName(both[1]).drop("p_value"), 6)


@query("kendall", """
WITH cells AS (SELECT l_quantity AS x, l_discount AS y, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY 1, 2),
 pairs AS (SELECT sum(a.w * b.w) FILTER (b.y > a.y) AS c, sum(a.w * b.w) FILTER (b.y < a.y) AS d FROM cells a JOIN cells b ON b.x > a.x),
 tx AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(w) AS n FROM cells GROUP BY x)),
 ty AS (SELECT sum(n * (n - 1) / 2) AS t FROM (SELECT sum(w) AS n FROM cells GROUP BY y)),
 n AS (SELECT sum(w) AS n FROM cells)
SELECT CAST(n.n AS BIGINT) AS n, c AS concordant, d AS discordant,
       round((c - d) / (sqrt(n.n * (n.n - 1) / 2 - tx.t) * sqrt(n.n * (n.n - 1) / 2 - ty.t)), 8) AS tau
FROM pairs, tx, ty, n
""")
def _kendall(spark, folder):
    found = ranks.kendall(_line(spark, folder), "l_quantity", "l_discount")
    return rounded(found.select("n", "concordant", "discordant", "tau"), {"tau": 8})


@query("mean_ci", interval_sql(["l_quantity", "l_discount"], "lineitem"))
def _mean_ci(spark, folder):
    found = inference.mean_interval(_line(spark, folder), ["l_quantity", "l_discount"])
    return rounded(found.drop("ci_low", "ci_high"), 6)


@query("inference_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {ORDER_7} LIMIT 1000
""")
def _sample(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return split.hash_sample(orders, ["o_orderkey"], 1000, seed=7)
