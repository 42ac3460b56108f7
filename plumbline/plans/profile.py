"""Profile of one table: quality, statistics and plot data."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    known,
    labelled,
    numeric_columns,
    quoted,
    require_columns,
    rows_from,
    small_table,
    string_columns,
    union_all,
)
from plumbline.operators import describe, inference, plotdata, quality, ranks
from plumbline.operators.quantiles import TASK_ROWS, quantiles
from plumbline.session import materialize
from plumbline.sources.reports import write_report


@dataclass(frozen=True)
class ProfileOptions:
    """Options of the profile; ``shares`` names columns whose values are counted with their shares."""

    expected_columns: tuple[str, ...] = ()
    target: str | None = None
    exclude_from_counts: tuple[str, ...] = ()
    correlations: tuple[str, ...] = ("pearson",)
    bins: int | str = "auto"
    shares: tuple[str, ...] = ()
    strict: bool = True
    task_rows: int = TASK_ROWS


def profile(df: DataFrame, options: ProfileOptions = ProfileOptions()) -> dict[str, DataFrame]:
    """All parts of the profile as small tables.

    With ``strict`` a failed check stops the profile before the costly parts. The table is read at most six times: for all
    checks, moments, extremes and Pearson correlations, for copies, up to three times for exact quartiles, and for the counts of
    bins and values. Rank correlations, copies among wide rows, brackets that must be narrowed again and more pairs than
    ``PAIRS_PER_SCAN`` add to that.
    """
    spark = df.sparkSession
    numeric: Sequence[str] = numeric_columns(df)
    words: Sequence[str] = string_columns(df)
    pairs = list(itertools.combinations_with_replacement(numeric, 2))
    shared_pairs = pairs if len(numeric) > 1 and "pearson" in options.correlations and len(pairs) <= ranks.PAIRS_PER_SCAN else []
    row, checks, missing, totals = _first_scan(df, options, numeric, shared_pairs)
    duplicates = [tuple(r[n] for n in ("check", "column", "passed", "value")) for r in quality.duplicate_check(df).collect()]
    report = small_table(spark, checks + duplicates, "check string, column string, passed boolean, value double")
    if options.strict:
        quality.assert_quality(report)
    parts = {
        "quality": report,
        "missing": small_table(spark, [m for m in missing if m[1] > 0], "column string, missing bigint, percent double"),
    }
    quartiles, layout = {}, []
    if numeric:
        counts = {c: row[f"count_{i}"] for i, c in enumerate(numeric)}
        quartiles = quantiles(df, numeric, describe.QUARTILES, counts=counts, task_rows=options.task_rows)
        parts["numeric_summary"] = describe.summary_table(spark, numeric, row, quartiles)
        extents = plotdata.finite_extents({c: (counts[c], row[f"min_{i}"], row[f"max_{i}"]) for i, c in enumerate(numeric)})
        layout = plotdata.bin_layout(extents, options.bins, quartiles)
        parts["mean_intervals"] = inference.interval_table(
            spark, {c: (counts[c], row[f"mean_{i}"], row[f"std_{i}"]) for i, c in enumerate(numeric)}
        )
        for method in options.correlations if len(numeric) > 1 else ():
            if method == "pearson" and shared_pairs:
                parts["correlation_pearson"] = _correlations(spark, row, shared_pairs)
            else:
                parts[f"correlation_{method}"] = ranks.correlation_matrix(df, numeric, method)
    named = list(dict.fromkeys([*words, *options.shares]))
    if layout or named:
        cells = _cells(df, named, layout, quartiles)
    if numeric:
        counted = cells.where("kind = 'bin'").select("column", F.col("item").cast("int").alias("bin"), "count") if layout else small_table(
            spark, [], "column string, bin int, count bigint")
        parts["histogram"] = plotdata.filled_bins(layout, counted)
        parts["box_stats"], parts["outliers"] = _boxes(spark, cells if layout else None, numeric, quartiles)
    if named:
        values = cells.where("kind = 'value'").select("column", F.col("item").alias("value"), "count")
    if words:
        parts["categorical_summary"] = describe.summarise_counts(values.where(F.col("column").isin(list(words))), words)
        plotted = [c for c in words if c not in set(options.exclude_from_counts)]
        parts["count_plot"] = values.where(F.col("column").isin(plotted))
    if options.shares:
        known_cells = small_table(spark, [(c, float(totals[c] or 1)) for c in dict.fromkeys(options.shares)], "column string, total double")
        parts["value_share"] = values.join(F.broadcast(known_cells), "column").select(
            "column", "value", "count", (F.col("count") / F.col("total")).alias("share")
        )
    return parts


def _first_scan(
    df: DataFrame, options: ProfileOptions, numeric: Sequence[str], pairs: Sequence[tuple[str, str]]
) -> tuple[Row, list[tuple], list[tuple], dict[str, int]]:
    """Moments and correlations, rows of the checks, rows of missing cells and known cells of the share columns, from one aggregate."""
    aggregates, checks, missing = quality.scalar_checks(df, options.expected_columns, options.target)
    require_columns(df, options.shares)
    totals = [F.count(known(df, c)).alias(f"total_{i}") for i, c in enumerate(options.shares)]
    kept = describe.moment_parts(df, numeric) + ranks.pair_parts(df, pairs) + totals
    names = df.agg(*kept).columns if kept else []
    # The aggregate has one row, so its checks are made beside it and everything comes in one answer.
    row = df.agg(*aggregates, *kept).select(
        F.array(*checks).alias("checks"), (F.array(*missing) if missing else F.lit(None)).alias("missing"), *names
    ).first()
    found = [tuple(row["checks"][k]) for k in range(len(row["checks"]))]
    return row, found, [tuple(m) for m in row["missing"] or []], {c: row[f"total_{i}"] for i, c in enumerate(options.shares)}


def _correlations(spark: SparkSession, row: Row, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    cells = [
        (left, right, row[f"n{i}"], row[f"r{i}"]) for i, (a, b) in enumerate(pairs) for left, right in sorted({(a, b), (b, a)})
    ]
    return small_table(spark, cells, "column_a string, column_b string, n bigint, r double")


def _cells(
    df: DataFrame, named: Sequence[str], layout: Sequence[tuple[str, float, float, int]], quartiles: quality.Quartiles
) -> DataFrame:
    """Stored counts of (kind, column, item): values of the named columns, and bins with the extremes of their near values."""
    nothing, no = F.lit(None).cast("double"), F.lit(False)
    structs = [
        labelled(kind=F.lit("value"), column=F.lit(c), item=known(df, c).cast("string"), near=nothing, far=no) for c in named
    ]
    for bins in layout:
        c = bins[0]
        q1, _, q3 = quartiles[c]
        value = known(df, c).cast("double")
        near = value.between(F.lit(q1 - 1.5 * (q3 - q1)), F.lit(q3 + 1.5 * (q3 - q1)))
        structs.append(labelled(
            kind=F.lit("bin"), column=F.lit(c), item=plotdata.bin_of(df, bins).cast("string"), near=F.when(near, value), far=~near
        ))
    return materialize(
        rows_from(df, structs)
        .where(F.col("item").isNotNull())
        .groupBy("kind", "column", "item")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("near").alias("near_low"),
            F.max("near").alias("near_high"),
            F.count_if("far").alias("far"),
        )
    )


def _boxes(
    spark: SparkSession, cells: DataFrame | None, numeric: Sequence[str], quartiles: quality.Quartiles
) -> tuple[DataFrame, DataFrame]:
    """Box statistics and outliers: one small row per column, folded from its bins."""
    found = {}
    if cells is not None:
        bins = cells.where("kind = 'bin'").groupBy("column")
        folded = bins.agg(F.min("near_low").alias("low"), F.max("near_high").alias("high"), F.sum("far").alias("far"))
        found = {r["column"]: (r["low"], r["high"], r["far"]) for r in folded.collect()}
    boxes, outside = [], []
    bounds = quality.iqr_bounds(None, numeric, quartiles=quartiles)
    for c in numeric:
        low, high, far = found.get(c, (None, None, 0))
        boxes.append((c, *quartiles[c], low, high, far))
        outside.append((c, far, bounds.low[c], bounds.high[c]))
    schema = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, fliers bigint"
    return (
        small_table(spark, boxes, schema),
        small_table(spark, outside, "column string, outliers bigint, lower_bound double, upper_bound double"),
    )


def tidy(parts: dict[str, DataFrame]) -> DataFrame:
    """The profile as one table of (part, item, metric, value).

    ``item`` joins the text columns of a row, such as column and category.
    """
    rows = []
    for name, part in parts.items():
        kinds = dict(part.dtypes)
        texts = [c for c, t in kinds.items() if t == "string"]
        numbers = [c for c, t in kinds.items() if t in ("double", "bigint", "int", "boolean")]
        item = F.concat_ws("/", *[quoted(c) for c in texts]) if texts else F.lit("")
        cells = F.array(*[
            F.struct(F.lit(c).alias("metric"), quoted(c).cast("double").alias("value")) for c in numbers
        ])
        rows.append(
            part.select(F.lit(name).alias("part"), item.alias("item"), F.explode(cells).alias("m")).select(
                "part", "item", "m.metric", "m.value"
            )
        )
    return union_all(rows)


def write_profile(parts: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One JSON report per part."""
    paths = {name: f"{folder}/{name}" for name in parts}
    for name, part in parts.items():
        write_report(part, paths[name])
    return paths
