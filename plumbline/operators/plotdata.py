"""The small tables behind charts: histograms, densities, counts, boxes, points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import (
    known,
    labelled,
    numeric_columns,
    require_columns,
    rows_from,
    small_table,
    string_columns,
)
from plumbline.operators.describe import QUARTILES, value_counts
from plumbline.operators.inference import mean_interval
from plumbline.operators.quality import Quartiles
from plumbline.operators.quantiles import quantiles
from plumbline.operators.split import hash_sample

# Bins that the rules may ask for; more must be asked for by the caller.
MAX_BINS = 100_000


def _extents(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    parts = []
    for i, name in enumerate(columns):
        c = known(df, name).cast("double")
        parts += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    row = df.agg(*parts).first()
    return finite_extents({c: (row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns)})


def finite_extents(found: dict[str, tuple[int, float, float]]) -> dict[str, tuple[int, float, float]]:
    """Count, minimum and maximum per column as they are; infinite ones raise."""
    for c, (n, low, high) in found.items():
        if n and (math.isinf(low) or math.isinf(high)):
            raise ValueError(f"{c} has infinite values")
    return found


def _auto_bins(n: int, low: float, high: float, q1: float, q3: float) -> int:
    """The finer of Sturges' and Freedman and Diaconis' rules."""
    if high == low:
        return 1
    sturges = (high - low) / (math.log2(n) + 1.0)
    spread = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    width = min(sturges, spread) if spread > 0 else sturges
    bins = max(1, math.ceil((high - low) / width))
    if bins > MAX_BINS:
        raise ValueError(f"the rules ask for {bins} bins; give a number of bins")
    return bins


def histogram(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int | str = "auto",
    quartiles: Quartiles | None = None,
) -> DataFrame:
    """Equal-width bins per numeric column, empty ones included.

    The last bin holds its right edge. Ranges come from one aggregate, and
    counts are folded per task before one small shuffle.
    """
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    extents = {c: e for c, e in _extents(df, columns).items() if e[0]}
    if bins == "auto" and quartiles is None:
        counts = {c: e[0] for c, e in extents.items()}
        quartiles = quantiles(df, list(extents), QUARTILES, counts=counts)
    layout = bin_layout(extents, bins, quartiles)
    if not layout:
        counts = small_table(df.sparkSession, [], "column string, bin int, count bigint")
    else:
        counts = (
            rows_from(df, [labelled(column=F.lit(bins[0]), bin=bin_of(df, bins)) for bins in layout])
            .where(F.col("bin").isNotNull())
            .groupBy("column", "bin")
            .agg(F.count(F.lit(1)).alias("count"))
        )
    return filled_bins(layout, counts)


def bin_layout(
    extents: dict[str, tuple[int, float, float]], bins: int | str, quartiles: Quartiles | None
) -> list[tuple[str, float, float, int]]:
    """(column, left edge, width, number of bins) of every column with values."""
    layout = []
    for c, (n, low, high) in extents.items():
        if not n:
            continue
        number = _auto_bins(n, low, high, quartiles[c][0], quartiles[c][2]) if bins == "auto" else int(bins)
        if high == low:
            low, high = low - 0.5, high + 0.5
        layout.append((c, low, (high - low) / number, number))
    return layout


def bin_of(df: DataFrame, bins: tuple[str, float, float, int]) -> Column:
    """Bin of a row; the last one holds its right edge."""
    name, low, width, number = bins
    value = known(df, name).cast("double")
    return F.least(F.floor((value - F.lit(low)) / F.lit(width)).cast("int"), F.lit(number - 1))


def filled_bins(layout: Sequence[tuple[str, float, float, int]], counts: DataFrame) -> DataFrame:
    """All bins with their edges and counts from the (column, bin, count) rows of those that hold values."""
    grid = small_table(counts.sparkSession, layout, "column string, low double, width double, bins int").select(
        "column", "low", "width", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")
    )
    return grid.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


# exp(-r * r / 2) is 0 in double precision beyond this.
KERNEL_REACH = 39.0


def density(df: DataFrame, column: str, points: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum, Scott bandwidth.

    Each row adds its kernel to the grid points within ``KERNEL_REACH`` bandwidths, beyond
    which the kernel is exactly 0 in double precision; sums are kept per task, so
    only the grid is shuffled. ``bins`` first replaces the rows by that many
    bin centres, which is the approximation to take on very large tables.
    """
    require_columns(df, [column])
    value = known(df, column).cast("double")
    row = df.agg(F.count(value), F.min(value), F.max(value), F.stddev_samp(value)).first()
    n, low, high, std = row[0], row[1], row[2], row[3]
    spark = df.sparkSession
    if not n or not std:
        return small_table(spark, [], "x double, density double")
    if math.isinf(low) or math.isinf(high):
        raise ValueError(f"{column} has infinite values")
    bandwidth = std * n ** (-0.2)
    if bins:
        width = (high - low) / bins
        place = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        weighted = (
            df.where(value.isNotNull())
            .groupBy(place.alias("b"))
            .agg(F.count(F.lit(1)).alias("w"))
            .select((F.lit(low) + (F.col("b") + 0.5) * F.lit(width)).alias("v"), "w")
        )
    else:
        weighted = df.select(value.alias("v"), F.lit(1).alias("w")).where(F.col("v").isNotNull())
    step = (high - low) / (points - 1)
    reach = KERNEL_REACH * bandwidth
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - F.lit(low + reach)) / F.lit(step))).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("v") - F.lit(low - reach)) / F.lit(step))).cast("int")
    at = weighted.select("v", "w", F.explode(F.when(first <= last, F.sequence(first, last))).alias("point"))
    x = F.lit(low) + F.col("point") * F.lit(step)
    kernel = F.exp(F.lit(-0.5) * F.pow((x - F.col("v")) / F.lit(bandwidth), F.lit(2.0)))
    scale = 1.0 / (n * bandwidth * math.sqrt(2.0 * math.pi))
    # Points that no kernel reaches have density 0.
    sums = at.groupBy("point").agg(F.sum(F.col("w") * kernel).alias("s")).unionByName(
        spark.range(points).select(F.col("id").cast("int").alias("point"), F.lit(0.0).alias("s")))
    return sums.groupBy("point").agg(F.sum("s").alias("s")).select(
        (F.lit(low) + F.col("point") * F.lit(step)).alias("x"), (F.col("s") * F.lit(scale)).alias("density"))


def count_plot(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Counts per category of each string column that is not excluded."""
    columns = [c for c in (columns or string_columns(df)) if c not in set(exclude)]
    return value_counts(df, columns)


def box_stats(
    df: DataFrame, columns: Sequence[str] | None = None, quartiles: Quartiles | None = None
) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 ranges of the box) and fliers."""
    columns = list(columns or numeric_columns(df))
    require_columns(df, columns)
    cuts = quartiles or quantiles(df, columns, QUARTILES)
    reach = {c: None if q[0] is None else 1.5 * (q[2] - q[0]) for c, q in cuts.items()}
    parts = []
    for i, c in enumerate(columns):
        value = known(df, c).cast("double")
        if reach[c] is None:
            near = F.lit(False)
            far = F.lit(False)
        else:
            near = value.between(F.lit(cuts[c][0] - reach[c]), F.lit(cuts[c][2] + reach[c]))
            far = value.isNotNull() & ~near
        parts += [
            F.min(F.when(near, value)).alias(f"lo{i}"),
            F.max(F.when(near, value)).alias(f"hi{i}"),
            F.count_if(far).alias(f"f{i}"),
        ]
    return rows_from(df.agg(*parts), [
        labelled(
            column=F.lit(c),
            q1=F.lit(cuts[c][0]).cast("double"),
            median=F.lit(cuts[c][1]).cast("double"),
            q3=F.lit(cuts[c][2]).cast("double"),
            whisker_low=F.col(f"lo{i}"),
            whisker_high=F.col(f"hi{i}"),
            fliers=F.col(f"f{i}"),
        )
        for i, c in enumerate(columns)
    ])


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """Counts on a ``bins`` by ``bins`` grid: every row counts, whatever the table size."""
    require_columns(df, [x, y])
    extents = _extents(df.where(known(df, x).isNotNull() & known(df, y).isNotNull()), [x, y])
    places = {}
    for name, c in (("x_bin", x), ("y_bin", y)):
        n, low, high = extents[c]
        if not n:
            return small_table(df.sparkSession, [], "x_bin int, y_bin int, count bigint")
        width = (high - low) / bins or 1.0
        value = known(df, c).cast("double")
        places[name] = F.least(F.floor((value - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (
        df.select(places["x_bin"].alias("x_bin"), places["y_bin"].alias("y_bin"))
        .dropna()
        .groupBy("x_bin", "y_bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def scatter_points(
    df: DataFrame, x: str, y: str, keys: Sequence[str], size: int = 1000, seed: int = 42
) -> DataFrame:
    """A reproducible sample of points for drawing."""
    return hash_sample(df, keys, size, seed).select(known(df, x).alias(x), known(df, y).alias(y))


def interval_bars(df: DataFrame, columns: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Mean with its confidence interval per column."""
    return mean_interval(df, columns, confidence)


def residual_histogram(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", bins: int | str = 30
) -> DataFrame:
    residual = known(predictions, label) - known(predictions, prediction)
    return histogram(predictions.select(residual.alias("residual")), ["residual"], bins)
