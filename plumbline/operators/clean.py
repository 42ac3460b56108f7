"""Row and column cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import is_floating, known, nan_to_null, quoted, require_columns
from plumbline.operators import quality
from plumbline.operators.describe import categorical_summary
from plumbline.operators.quantiles import quantiles


def cast_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; columns that are absent are left out (see :func:`absent`)."""
    return df.withColumns({c: quoted(c).cast(t) for c, t in types.items() if c in df.columns})


def absent(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows whose given columns are all known (neither NULL nor NaN)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def mean_values(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(known(df, c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def median_values(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float]:
    return {c: v[0] for c, v in quantiles(df, columns, (0.5,), exact=exact).items()}


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column; among equals the smaller string."""
    return {r["column"]: r["top"] for r in categorical_summary(df, columns).collect()}


def fill_values(df: DataFrame, columns: Sequence[str], strategy: str, constant: Any = None) -> dict[str, Any]:
    """Fit replacement values on ``df``; apply them to any split with :func:`impute`."""
    require_columns(df, columns)
    if strategy == "mean":
        return mean_values(df, columns)
    if strategy == "median":
        return median_values(df, columns)
    if strategy == "mode":
        return mode_values(df, columns)
    if strategy == "constant":
        return {c: constant for c in columns}
    raise ValueError(f"unknown strategy {strategy!r}")


def impute(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Replace missing cells. Means and medians turn integer columns into doubles."""
    filled = {}
    for name, value in values.items():
        if value is None:
            continue
        kind = df.schema[name].dataType
        if isinstance(kind, T.IntegralType) and float(value) != int(float(value)):
            kind = T.DoubleType()
        filled[name] = F.coalesce(known(df, name).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(filled)


def deduplicate(df: DataFrame, strategy: str = "remove", two_phase: bool | None = None) -> DataFrame:
    """Drop surplus copies of equal rows, or keep all of them.

    Of wide rows (``two_phase``, by default as in ``quality.duplicate_count``) digests are grouped first; only
    rows whose digest repeats are then compared, and the others stay where they are.
    """
    if strategy == "keep":
        return df
    if strategy == "remove":
        rows = nan_to_null(df)
        if not (two_phase if two_phase is not None else quality.is_wide(df, df.columns)):
            return rows.dropDuplicates()
        repeated = quality.repeated_digests(rows, df.columns)
        if repeated.isEmpty():
            return rows
        marked, digest = quality.with_digest(rows, df.columns), ["__d0", "__d1"]
        once = marked.join(repeated, digest, "left_anti").select(*[quoted(c) for c in df.columns])
        again = marked.join(repeated, digest, "left_semi").select(*[quoted(c) for c in df.columns])
        return once.unionByName(again.dropDuplicates())
    raise ValueError(f"unknown strategy {strategy!r}")


def latest_year(df: DataFrame, column: str) -> int | None:
    return df.agg(F.max(quoted(column))).first()[0]


def age_from_year(
    df: DataFrame, column: str = "year", reference_year: int | None = None, output: str = "age"
) -> DataFrame:
    """Years between ``column`` and the reference year.

    Fit the reference on the training split with :func:`latest_year` and pass
    it for every split. Without one the latest year of this very frame is used.
    """
    reference = latest_year(df, column) if reference_year is None else reference_year
    return df.withColumn(output, F.lit(reference).cast(df.schema[column].dataType) - quoted(column))


def age_from_today(df: DataFrame, column: str = "year", output: str = "age") -> DataFrame:
    return df.withColumn(output, F.year(F.current_date()) - quoted(column))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; unknown names are ignored."""
    return df.drop(*columns)


_INTEGER_LIMITS: list[tuple[T.DataType, int]] = [
    (T.ByteType(), 2**7),
    (T.ShortType(), 2**15),
    (T.IntegerType(), 2**31),
]


def narrow_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast integers, and doubles that hold only whole numbers, to the smallest fitting integer type.

    One aggregate decides; the cast itself is a projection.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, (T.IntegralType, T.FractionalType))]
    names = [c for c in (columns or numeric) if not isinstance(df.schema[c].dataType, T.DecimalType)]
    if not names:
        return df
    parts = []
    for i, name in enumerate(names):
        c = quoted(name)
        whole = F.bool_and(c == F.floor(c)) if is_floating(df, name) else F.lit(True)
        hidden = F.count_if(F.isnan(c)) if is_floating(df, name) else F.lit(0)
        parts += [
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
            whole.alias(f"whole{i}"),
            hidden.alias(f"nan{i}"),
        ]
    row = df.agg(*parts).first()
    casts = {}
    for i, name in enumerate(names):
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        if low is None or not row[f"whole{i}"] or row[f"nan{i}"]:
            continue
        kind = next((t for t, limit in _INTEGER_LIMITS if -limit <= low and high < limit), None)
        if kind is not None:
            casts[name] = quoted(name).cast(kind)
    return df.withColumns(casts) if casts else df


# Strategies that apply to numbers; other columns take the plan's strategy for words.
_NUMERIC = ("mean", "median")


@dataclass(frozen=True)
class CleaningPlan:
    """Options of the cleaning chain.

    ``missing`` is ``drop``, ``keep`` or a strategy of :func:`fill_values`; ``mean`` and ``median``
    fill numeric columns, and all others then take ``missing_words`` (``mode`` or ``constant``).
    ``constants`` names the values of columns that are filled by ``constant``.
    """

    types: dict[str, str] = field(default_factory=dict)
    missing: str = "drop"
    missing_words: str = "mode"
    constants: dict[str, Any] = field(default_factory=dict)
    missing_columns: tuple[str, ...] | None = None
    duplicates: str = "remove"
    year_column: str | None = None
    drop: tuple[str, ...] = ()


def fit_fills(df: DataFrame, plan: CleaningPlan) -> dict[str, Any]:
    """Replacement values of the plan, fitted on the typed columns of ``df``."""
    if plan.missing in ("drop", "keep"):
        return {}
    df = cast_types(nan_to_null(df), plan.types)
    columns = list(plan.missing_columns or df.columns)
    require_columns(df, columns)
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    by_strategy: dict[str, list[str]] = {}
    for c in columns:
        chosen = plan.missing_words if plan.missing in _NUMERIC and c not in numbers else plan.missing
        by_strategy.setdefault(chosen, []).append(c)
    values: dict[str, Any] = {}
    for strategy, names in by_strategy.items():
        if strategy == "constant":
            without = [c for c in names if c not in plan.constants]
            if without:
                raise ValueError(f"no constant for {without}")
            values.update({c: plan.constants[c] for c in names})
        else:
            values.update(fill_values(df, names, strategy))
    return values


def clean(
    df: DataFrame, plan: CleaningPlan, reference_year: int | None = None, fills: dict[str, Any] | None = None
) -> DataFrame:
    """Types, missing values, duplicates, age and unwanted columns, in this order.

    ``fills`` are the values of :func:`fit_fills` from the training split; without them they
    are fitted on this very frame.
    """
    df = cast_types(nan_to_null(df), plan.types)
    if plan.missing == "drop":
        df = drop_missing(df, plan.missing_columns)
    elif plan.missing != "keep":
        df = impute(df, fit_fills(df, plan) if fills is None else fills)
    df = deduplicate(df, plan.duplicates)
    if plan.year_column:
        df = age_from_year(df, plan.year_column, reference_year)
    return drop_columns(df, plan.drop)


def cleaning_report(df: DataFrame, plan: CleaningPlan) -> DataFrame:
    """Rows and columns after each step of the chain, counted from one grouped pass.

    Rows that are dropped for missing cells and surplus copies both follow from
    the counts of distinct rows, so no step is run on its own.
    """
    typed = cast_types(nan_to_null(df), plan.types)
    if plan.missing not in ("drop", "keep"):
        # Copies are counted among the filled rows, as the chain removes them.
        typed = impute(typed, fit_fills(df, plan))
    checked = list(plan.missing_columns or typed.columns)
    complete = F.lit(True)
    for c in checked:
        complete = complete & quoted(c).isNotNull()
    kept = complete if plan.missing == "drop" else F.lit(True)
    groups = typed.groupBy(*[quoted(c) for c in typed.columns], kept.alias("__kept")).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    wide = groups.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum(F.when(F.col("__kept"), F.col("__copies"))), F.lit(0)).alias("complete_rows"),
        F.count_if(F.col("__kept")).alias("distinct_rows"),
    )
    width = len(df.columns)
    final = width + (1 if plan.year_column else 0) - len([c for c in plan.drop if c in df.columns])
    last = F.col("distinct_rows") if plan.duplicates == "remove" else F.col("complete_rows")
    steps = [
        ("input", F.col("input_rows"), width),
        ("missing_values", F.col("complete_rows"), width),
        ("duplicates", last, width),
        ("final", last, final),
    ]
    return wide.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(s).alias("step"), r.alias("rows"), F.lit(w).cast("bigint").alias("columns"))
                for s, r, w in steps
            ])
        ).alias("r")
    ).select("r.*")
