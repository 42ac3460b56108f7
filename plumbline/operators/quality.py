"""Data-quality checks as report rows.

Every check except duplicates and quantile bounds is read off one aggregate:
row count and, per column, minimum, maximum and number of known values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import (
    is_floating,
    known,
    labelled,
    numeric_columns,
    quoted,
    require_columns,
    rows_from,
    small_table,
    union_all,
)
from plumbline.operators.quantiles import quantiles
from plumbline.session import materialize


def _extent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*_extent_parts(df, columns))


def _extent_parts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Count of rows and, per column i, known{i}, inf{i} and, where values have an order, lo{i} and hi{i}."""
    parts = [F.count(F.lit(1)).alias("rows")]
    ordered = set(_orderable(df))
    for i, name in enumerate(columns):
        c = known(df, name)
        parts.append(F.count(c).alias(f"known{i}"))
        parts.append(_infinite_cells(df, name).alias(f"inf{i}"))
        if name in ordered:
            parts += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    return parts


def _infinite_cells(df: DataFrame, name: str) -> Column:
    if not is_floating(df, name):
        return F.count_if(F.lit(False))
    return F.count_if(F.abs(known(df, name)).cast("double") == F.lit(float("inf")))


def _orderable(df: DataFrame) -> list[str]:
    """Columns whose values can be compared: neither maps nor variants, nor what holds them."""
    def comparable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return comparable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(comparable(f.dataType) for f in kind)
        return kind.typeName() not in ("map", "variant")

    return [f.name for f in df.schema if comparable(f.dataType)]


def _comparable(df: DataFrame, name: str) -> Column:
    """The column in a form whose equal values group together, also for maps and variants."""
    if name in _orderable(df):
        return known(df, name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.MapType) and not any(word in kind.valueType.simpleString() for word in ("map<", "variant")):
        return F.array_sort(F.map_entries(quoted(name)))
    return F.to_json(F.struct(quoted(name)))


def shape_checks(df: DataFrame) -> DataFrame:
    """Is the table non-empty, and does it have more than one row and column?"""
    wide = df.agg(F.count(F.lit(1)).alias("rows"))
    rows = F.col("rows").cast("double")
    width = len(df.columns)
    return rows_from(wide, [
        _row("not_empty", None, F.col("rows") > 0, rows),
        _row("many_rows_and_columns", None, (F.col("rows") > 1) & F.lit(width > 1), rows),
    ])


def _row(check: str, column: str | None, passed: Column, value: Column) -> Column:
    return labelled(
        check=F.lit(check),
        column=F.lit(column).cast("string"),
        passed=F.coalesce(passed, F.lit(True)),
        value=value.cast("double"),
    )


def negative_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Passes where no value is below zero; value is the minimum."""
    columns = list(columns or numeric_columns(df))
    return rows_from(_extent(df, columns), _negative_rows(columns))


def _negative_rows(columns: Sequence[str]) -> list[Column]:
    return [_row("no_negative", c, F.col(f"lo{i}") >= 0, F.col(f"lo{i}")) for i, c in enumerate(columns)]


def infinite_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Passes where no value is infinite; value counts the infinite cells."""
    columns = list(columns or numeric_columns(df))
    return rows_from(_extent(df, columns), _infinite_rows(columns))


def _infinite_rows(columns: Sequence[str]) -> list[Column]:
    return [_row("no_infinite", c, F.col(f"inf{i}") == 0, F.col(f"inf{i}")) for i, c in enumerate(columns)]


def expected_columns_check(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column, passed when the table has it; value counts its known cells."""
    return _presence(df, [("expected_column", c) for c in expected])


def target_check(df: DataFrame, target: str) -> DataFrame:
    """Passes when the table has the target; value counts its known cells."""
    return _presence(df, [("target_present", target)])


def _presence(df: DataFrame, wanted: Sequence[tuple[str, str]]) -> DataFrame:
    present = list(dict.fromkeys(c for _, c in wanted if c in df.columns))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(known(df, c)).alias(f"known{i}") for i, c in enumerate(present)])
    return rows_from(wide, _presence_rows(wanted, present))


def _presence_rows(wanted: Sequence[tuple[str, str]], present: Sequence[str]) -> list[Column]:
    """Rows of the presence checks; ``present`` gives the numbers of the ``known`` counts."""
    rows = []
    for check, c in wanted:
        cells = F.col(f"known{present.index(c)}") if c in present else F.lit(0)
        rows.append(_row(check, c, F.lit(c in present), cells))
    return rows


def constant_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fails where all known values are equal; value is 1 for a constant column.

    A column without any known value is not constant.
    """
    columns = list(columns or _orderable(df))
    return rows_from(_extent(df, columns), _constant_rows(columns))


def _constant_rows(columns: Sequence[str]) -> list[Column]:
    rows = []
    for i, c in enumerate(columns):
        constant = (F.col(f"known{i}") > 0) & (F.col(f"lo{i}") == F.col(f"hi{i}"))
        constant = F.coalesce(constant, F.lit(False))
        rows.append(_row("not_constant", c, ~constant, constant.cast("int")))
    return rows


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and percentage of missing cells, for columns that have any."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(known(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    rows = [
        labelled(column=F.lit(c), missing=F.col(f"m{i}"), percent=F.try_divide(F.col(f"m{i}") * 100.0, F.col("rows")))
        for i, c in enumerate(columns)
    ]
    return rows_from(wide, rows).where(F.col("missing") > 0)


def missing_severity(
    df: DataFrame, columns: Sequence[str] | None = None, warning: float = 0.1, critical: float = 0.3
) -> DataFrame:
    """Missing share of every column, graded ok, warning or critical."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(known(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    share = F.coalesce(F.try_divide(F.col("missing"), F.col("rows")), F.lit(0.0))
    grade = F.when(share >= critical, "critical").when(share >= warning, "warning").otherwise("ok")
    rows = [
        labelled(column=F.lit(c), missing=F.col(f"m{i}"), rows=F.col("rows")) for i, c in enumerate(columns)
    ]
    return rows_from(wide, rows).select("column", "missing", share.alias("share"), grade.alias("severity"))


#: Rows of more bytes than this, by the usual sizes of their types, are told apart by digests first.
WIDE_ROW = 256


def is_wide(df: DataFrame, columns: Sequence[str]) -> bool:
    return df.select(*[quoted(c) for c in columns])._jdf.schema().defaultSize() > WIDE_ROW


def with_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with ``__d0`` and ``__d1``, a 128-bit digest in which equal rows agree."""
    keys = [F.coalesce(F.when(c == 0, F.lit(0).cast(df.schema[n].dataType)), c) if isinstance(df.schema[n].dataType, (T.DoubleType, T.FloatType)) else c
            for n, c in ((n, _comparable(df, n)) for n in columns)]
    return df.withColumns({f"__d{i}": F.xxhash64(F.lit(i), *keys) for i in (0, 1)})


def repeated_digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(__d0, __d1, copies) of the digests that several rows share: all that is shuffled of a row are 16 bytes and a count."""
    digests = with_digest(df, columns).select("__d0", "__d1")
    return materialize(digests.groupBy("__d0", "__d1").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, two_phase: bool | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies.

    The map side already folds copies together, so a row that fills a third of
    the table reaches its reducer as one count per task. Of wide rows (``two_phase``, by default those over
    ``WIDE_ROW`` bytes) only digests are shuffled; whole rows are compared where a digest repeats.
    """
    columns = list(columns or df.columns)
    keys = [_comparable(df, c).alias(f"k{i}") for i, c in enumerate(columns)]
    if two_phase if two_phase is not None else is_wide(df, columns):
        repeated = repeated_digests(df, columns)
        found = repeated.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count(F.lit(1))).first()
        rows, distinct = df.count(), 0
        if found[1]:
            distinct = with_digest(df, columns).join(repeated, ["__d0", "__d1"], "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).count()
        distinct += rows - found[0]
        return small_table(df.sparkSession, [(rows, distinct, rows - distinct)], "rows bigint, distinct_rows bigint, duplicates bigint")
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return groups.agg(
        total.alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (total - F.count(F.lit(1))).alias("duplicates"),
    )


@dataclass(frozen=True)
class Bounds:
    """Closed range of acceptable values per column; None where there is none."""

    low: dict[str, float | None]
    high: dict[str, float | None]

    def outside(self, df: DataFrame, name: str) -> Column:
        if self.low[name] is None or self.high[name] is None:
            return F.lit(False)
        c = known(df, name).cast("double")
        return (c < F.lit(self.low[name])) | (c > F.lit(self.high[name]))


# Lower quartile, median and upper quartile per column, where they are already known.
Quartiles = dict[str, Sequence[float | None]]


def iqr_bounds(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = 1.5,
    exact: bool = True,
    quartiles: Quartiles | None = None,
) -> Bounds:
    """Quartiles widened by ``threshold`` interquartile ranges."""
    if quartiles is None:
        cuts = quantiles(df, columns, (0.25, 0.75), exact=exact)
    else:
        cuts = {c: (quartiles[c][0], quartiles[c][2]) for c in columns}
    low, high = {}, {}
    for c, (q1, q3) in cuts.items():
        # Two infinite quartiles have no distance and give no bounds.
        width = None if q1 is None or math.isnan(q3 - q1) else q3 - q1
        low[c] = None if width is None else q1 - threshold * width
        high[c] = None if width is None else q3 + threshold * width
    return Bounds(low, high)


def zscore_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> Bounds:
    """Mean plus and minus ``threshold`` sample standard deviations of the finite values."""
    parts = []
    for i, name in enumerate(columns):
        c = known(df, name).cast("double")
        c = F.when(F.abs(c) < F.lit(float("inf")), c)
        parts += [F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}")]
    row = df.agg(*parts).first()
    low, high = {}, {}
    for i, c in enumerate(columns):
        mean, std = row[f"m{i}"], row[f"s{i}"]
        low[c] = None if std is None else mean - threshold * std
        high[c] = None if std is None else mean + threshold * std
    return Bounds(low, high)


def outlier_bounds(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "iqr",
    threshold: float | None = None,
    exact: bool = True,
    quartiles: Quartiles | None = None,
) -> Bounds:
    if method == "iqr":
        return iqr_bounds(df, columns, 1.5 if threshold is None else threshold, exact, quartiles)
    if method == "zscore":
        return zscore_bounds(df, columns, 3.0 if threshold is None else threshold)
    raise ValueError(f"unknown outlier method {method!r}")


def outlier_summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    method: str = "iqr",
    threshold: float | None = None,
    exact: bool = True,
    quartiles: Quartiles | None = None,
) -> DataFrame:
    """Bounds per numeric column and the number of values strictly outside."""
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    bounds = outlier_bounds(df, columns, method, threshold, exact, quartiles)
    wide = df.agg(*[F.count_if(bounds.outside(df, c)).alias(f"o{i}") for i, c in enumerate(columns)])
    return rows_from(wide, [
        labelled(
            column=F.lit(c),
            outliers=F.col(f"o{i}"),
            lower_bound=F.lit(bounds.low[c]).cast("double"),
            upper_bound=F.lit(bounds.high[c]).cast("double"),
        )
        for i, c in enumerate(columns)
    ])


def cap_outliers(df: DataFrame, bounds: Bounds, columns: Sequence[str] | None = None) -> DataFrame:
    """Move values outside the bounds onto the nearest bound; missing values stay missing."""
    capped = {}
    for name in columns or bounds.low:
        if bounds.low[name] is None or bounds.high[name] is None:
            continue
        c = known(df, name).cast("double")
        # greatest and least skip NULL, so missing values are kept apart.
        limited = F.greatest(F.lit(bounds.low[name]), F.least(F.lit(bounds.high[name]), c))
        capped[name] = F.when(c.isNotNull(), limited)
    return df.withColumns(capped)


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Minimum and maximum per numeric column."""
    columns = list(columns or numeric_columns(df))
    return rows_from(_extent(df, columns), [
        labelled(
            column=F.lit(c),
            minimum=F.col(f"lo{i}").cast("double"),
            maximum=F.col(f"hi{i}").cast("double"),
        )
        for i, c in enumerate(columns)
    ])


def scalar_checks(
    df: DataFrame, expected: Sequence[str] = (), target: str | None = None
) -> tuple[list[Column], list[Column], list[Column]]:
    """Aggregates of one scan; rows of the report made from them; rows of :func:`missing_summary`, also of whole columns."""
    numeric = numeric_columns(df)
    # Maps and variants have no order, so they come last and without the check for constants.
    sortable = _orderable(df)
    comparable = numeric + [c for c in df.columns if c not in numeric and c in sortable]
    ordered = comparable + [c for c in df.columns if c not in comparable]
    rows_count = F.col("rows")
    gaps = {c: rows_count - F.col(f"known{i}") for i, c in enumerate(ordered)}
    fused = [
        _row("not_empty", None, rows_count > 0, rows_count),
        _row("many_rows_and_columns", None, (rows_count > 1) & F.lit(len(df.columns) > 1), rows_count),
        *_negative_rows(numeric),
        *_infinite_rows(numeric),
        *_constant_rows(comparable),
        *[_row("missing", c, F.lit(True), gaps[c]) for c in ordered],
    ]
    wanted = [("expected_column", c) for c in expected]
    wanted += [("target_present", target)] if target is not None else []
    missing = [
        labelled(column=F.lit(c), missing=gaps[c], percent=F.try_divide(gaps[c] * 100.0, rows_count)) for c in df.columns
    ]
    return _extent_parts(df, ordered), fused + _presence_rows(wanted, ordered), missing


def duplicate_check(df: DataFrame) -> DataFrame:
    """The row of the report that counts surplus copies; it never fails."""
    return duplicate_count(df, df.columns).select(
        F.lit("duplicates").alias("check"),
        F.lit(None).cast("string").alias("column"),
        F.lit(True).alias("passed"),
        F.col("duplicates").cast("double").alias("value"),
    )


def quality_report(
    df: DataFrame,
    expected: Sequence[str] = (),
    target: str | None = None,
    outliers: bool = True,
) -> DataFrame:
    """All checks in one table of (check, column, passed, value).

    Scalar checks share one scan. Duplicates need a shuffle of the rows and
    outliers need the quartiles, so they are separate branches. Missing values,
    duplicates and outliers are reported without failing.
    """
    numeric = numeric_columns(df)
    aggregates, checks, _ = scalar_checks(df, expected, target)
    parts = [rows_from(df.agg(*aggregates), checks), duplicate_check(df)]
    if outliers and numeric:
        parts.append(
            outlier_summary(df, numeric).select(
                F.lit("outliers").alias("check"),
                "column",
                F.lit(True).alias("passed"),
                F.col("outliers").cast("double").alias("value"),
            )
        )
    return union_all(parts)


def assert_quality(report: DataFrame) -> None:
    """Raise when a report has a failed check. The report is small: one row per check and column."""
    failed: list[Row] = report.where(~F.col("passed")).collect()
    if failed:
        names = sorted(f"{r['check']}({r['column']})" if r["column"] else r["check"] for r in failed)
        raise ValueError("failed checks: " + ", ".join(names))


@dataclass(frozen=True)
class Rule:
    """A named condition that a record must meet; NULL breaks it."""

    name: str
    holds: Column


def between(column: str, low: float | None = None, high: float | None = None) -> Rule:
    c = quoted(column)
    conditions = [c >= F.lit(low)] if low is not None else []
    conditions += [c <= F.lit(high)] if high is not None else []
    # NaN is missing, though Spark orders it above all numbers.
    holds = c.isNotNull() & ~F.isnan(c.cast("double"))
    for condition in conditions:
        holds = holds & condition
    return Rule(f"{column}_range", holds)


def one_of(column: str, allowed: Sequence[str | int]) -> Rule:
    return Rule(f"{column}_allowed", quoted(column).isin(list(allowed)))


def flags(columns: Sequence[str], at_most_one: str | None = None) -> list[Rule]:
    """Every flag is 0 or 1; ``at_most_one`` names an extra rule on their sum."""
    rules = [Rule(f"{c}_flag", quoted(c).isin(0, 1)) for c in columns]
    if at_most_one is not None:
        total = sum((quoted(c) for c in columns[1:]), quoted(columns[0]))
        rules.append(Rule(at_most_one, total <= 1))
    return rules


# Limits and words a scoring record may hold.
VEHICLE_RANGES = {
    "year": (1900, 2030),
    "km_driven": (0, None),
    "mileage": (0, None),
    "engine": (0, None),
    "max_power": (0, None),
    "seats": (2, 10),
}
VEHICLE_WORDS = {
    "fuel": ["Petrol", "Diesel", "LPG", "CNG", "Electric"],
    "transmission": ["Manual", "Automatic"],
    "owner": ["First Owner", "Second Owner", "Third Owner", "Fourth & Above Owner", "Test Drive Car"],
}
# Engineered records carry the age instead of the year.
FEATURE_RANGES = {"mileage": (0, None), "seats": (2, 10), "age": (0, 100), "engine_sqrt": (0, None)}


def vehicle_rules() -> list[Rule]:
    return [between(c, *limits) for c, limits in VEHICLE_RANGES.items()] + [
        one_of(c, words) for c, words in VEHICLE_WORDS.items()
    ]


def feature_rules(flag_columns: Sequence[str] = ()) -> list[Rule]:
    return [between(c, *limits) for c, limits in FEATURE_RANGES.items()] + flags(list(flag_columns))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``violations`` (names of broken rules) and ``valid``; one projection, no shuffle."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(r.holds, F.lit(False)), F.lit(r.name)) for r in rules])
    )
    return df.withColumn("violations", broken).withColumn("valid", F.size("violations") == 0)


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Accepted records and quarantined ones."""
    checked = apply_rules(df, rules)
    good = checked.where("valid").drop("valid", "violations")
    return good, checked.where(~F.col("valid")).drop("valid")
