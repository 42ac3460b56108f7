"""Exact order statistics and quantiles without a full sort.

Spark's ``percentile`` keeps every distinct value of a column in one task.
Here a sketch brackets each wanted rank, counts check the bracket and only the few
values inside it are shuffled. Sketches of tasks are merged in levels, so that no
task receives those of all others. A bracket that is still too wide is narrowed
again, so the work per task stays bounded while the answer stays exact. What reaches
the driver is one number per wanted rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.columns import known, require_columns

# Values that one task may sort on its own.
TASK_ROWS = 1_000_000
# Size of the sketches; their ranks are off by at most about SKETCH_ERROR of the rows.
SKETCH_SIZE = 4096
SKETCH_ERROR = 0.001
# Sketches that are left after each level of merging, before the last one.
MERGE_LEVELS = (1024, 32)


@dataclass
class _Target:
    """A wanted rank and the open interval known to hold its value."""

    column: str
    rank: int
    inside: int
    low: float | int | None = None
    high: float | int | None = None
    below: int = 0
    value: float | int | None = None

    def too_wide(self, task_rows: int) -> bool:
        return self.value is None and self.inside > task_rows


def _between(column: Column, low: float | None, high: float | None) -> Column:
    inside = column.isNotNull()
    if low is not None:
        inside = inside & (column > F.lit(low))
    if high is not None:
        inside = inside & (column < F.lit(high))
    return inside


def _by_interval(targets: list[_Target]) -> list[list[_Target]]:
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.column, t.low, t.high), []).append(t)
    return list(groups.values())


def _runs(group: list[_Target]) -> list[list[_Target]]:
    """Neighbouring ranks, as a quantile between two values needs them, share an interval."""
    runs: list[list[_Target]] = []
    for t in sorted(group, key=lambda t: t.rank):
        if runs and t.rank - runs[-1][-1].rank <= 1:
            runs[-1].append(t)
        else:
            runs.append([t])
    return runs


def count_known(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.count(known(df, c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def order_statistics(
    df: DataFrame,
    ranks: dict[str, Sequence[int]],
    counts: dict[str, int] | None = None,
    task_rows: int = TASK_ROWS,
    sketch_size: int = SKETCH_SIZE,
) -> dict[tuple[str, int], float | int]:
    """Value at each 0-based rank of the sorted known values of a column.

    Integers are compared as integers, all other numbers as doubles.
    """
    require_columns(df, ranks)
    counts = counts or count_known(df, list(ranks))
    targets = []
    for name, wanted in ranks.items():
        for rank in sorted(set(wanted)):
            if not 0 <= rank < counts[name]:
                raise ValueError(f"rank {rank} outside the {counts[name]} values of {name}")
            targets.append(_Target(name, rank, inside=counts[name]))
    if not targets:
        return {}
    values = {c: _comparable(df, c) for c in ranks}
    while wide := [t for t in targets if t.too_wide(task_rows)]:
        _narrow(df, values, wide, sketch_size)
    _extract(df, values, [t for t in targets if t.value is None])
    return {(t.column, t.rank): t.value for t in targets}


def _is_integer(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def _comparable(df: DataFrame, name: str) -> Column:
    return known(df, name).cast("bigint" if _is_integer(df, name) else "double")


def sketched(df: DataFrame, columns: Sequence[Column], integer: Sequence[bool], fractions: Sequence[Sequence[float]], size: int):
    """Approximate quantiles of each column; tasks are grouped by number and merged level by level."""
    kinds = ["bigint" if i else "double" for i in integer]
    make = {"bigint": F.kll_sketch_agg_bigint, "double": F.kll_sketch_agg_double}
    merge = {"bigint": F.kll_merge_agg_bigint, "double": F.kll_merge_agg_double}
    read = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}
    task = F.spark_partition_id().alias("task")
    held = df.select(task, *[c.alias(f"c{i}") for i, c in enumerate(columns)])
    held = held.groupBy(F.pmod("task", F.lit(MERGE_LEVELS[0])).alias("task")).agg(
        *[make[k](f"c{i}", size).alias(f"s{i}") for i, k in enumerate(kinds)])
    for groups in (*MERGE_LEVELS[1:], 1):
        held = held.groupBy(F.pmod("task", F.lit(groups)).alias("task")).agg(
            *[merge[k](f"s{i}", size).alias(f"s{i}") for i, k in enumerate(kinds)])
    return held.select(*[
        F.array(*[read[k](f"s{i}", F.lit(float(p))) for p in ps]).alias(f"q{i}")
        for i, (k, ps) in enumerate(zip(kinds, fractions))
    ]).first()


def _narrow(df: DataFrame, values: dict[str, Column], targets: list[_Target], sketch_size: int) -> None:
    """Shrink every interval by a factor of some hundreds: two passes, one row each.

    The ends are counted apart from the inside, so a value that fills a third
    of the table settles its ranks instead of widening an interval.
    """
    groups = _by_interval(targets)
    columns, wanted = [], []
    for group in groups:
        column, first = values[group[0].column], group[0]
        slack = 1.5 * SKETCH_ERROR * SKETCH_SIZE / sketch_size + 1.0 / first.inside
        fractions = []
        for run in _runs(group):
            ends = (run[0].rank - first.below) / first.inside - slack, (run[-1].rank - first.below) / first.inside + slack
            fractions += [min(1.0, max(0.0, p)) for p in ends]
        columns.append(F.when(_between(column, first.low, first.high), column))
        wanted.append(fractions)
    bounds = sketched(df, columns, [_is_integer(df, g[0].column) for g in groups], wanted, sketch_size)
    probes = {}
    for i, group in enumerate(groups):
        for j, run in enumerate(_runs(group)):
            probes.setdefault((run[0].column, bounds[i][2 * j], bounds[i][2 * j + 1]), []).extend(run)
    checks = []
    for i, (name, low, high) in enumerate(probes):
        column = values[name]
        checks += [
            F.count_if(column < F.lit(low)).alias(f"below{i}"),
            F.count_if(column == F.lit(low)).alias(f"low{i}"),
            F.count_if(_between(column, low, high)).alias(f"inside{i}"),
            F.count_if(column == F.lit(high)).alias(f"high{i}"),
        ]
    seen = df.agg(*checks).first()
    for i, ((_, low, high), members) in enumerate(probes.items()):
        at_low = seen[f"below{i}"]
        inner = at_low + seen[f"low{i}"]
        at_high = inner + (seen[f"inside{i}"] if low < high else 0)
        beyond = at_high + (seen[f"high{i}"] if low < high else 0)
        for t in members:
            if t.rank < at_low:
                t.high, t.inside = low, at_low - t.below
            elif t.rank < inner:
                t.value = low
            elif t.rank < at_high:
                t.low, t.high, t.below, t.inside = low, high, inner, at_high - inner
            elif t.rank < beyond:
                t.value = high
            else:
                t.low, t.inside, t.below = high, t.below + t.inside - beyond, beyond


def _extract(df: DataFrame, values: dict[str, Column], targets: list[_Target]) -> None:
    """Read the wanted ranks out of intervals that fit one task each."""
    if not targets:
        return
    groups = _by_interval(targets)
    conditions = [_between(values[g[0].column], g[0].low, g[0].high) for g in groups]
    members = F.array_compact(
        F.array(*[
            F.when(c, F.struct(F.lit(k).alias("g"), values[g[0].column].alias("v")))
            for k, (c, g) in enumerate(zip(conditions, groups))
        ])
    )
    # The filter lets few rows through, so the array is built for those only.
    cells = (
        df.where(reduce(or_, conditions))
        .select(F.explode(members).alias("m"))
        .groupBy(F.col("m.g").alias("g"), F.col("m.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    ordered = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = cells.select("g", "v", "n", F.sum("n").over(ordered).alias("end"))
    hit = F.lit(False)
    for k, g in enumerate(groups):
        for t in g:
            place = t.rank - t.below
            hit = hit | ((F.col("g") == k) & (F.col("end") > place) & (F.col("end") - F.col("n") <= place))
    rows = ends.where(hit).collect()
    for k, g in enumerate(groups):
        for t in g:
            place = t.rank - t.below
            t.value = next(
                r["v"] for r in rows if r["g"] == k and r["end"] - r["n"] <= place < r["end"]
            )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    exact: bool = True,
    counts: dict[str, int] | None = None,
    task_rows: int = TASK_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None for an empty column.

    ``exact=False`` takes one pass and returns sketch values.
    """
    require_columns(df, columns)
    if not columns:
        return {}
    if not exact:
        row = sketched(
            df, [_comparable(df, c) for c in columns], [_is_integer(df, c) for c in columns], [probabilities] * len(columns), SKETCH_SIZE)
        return {c: [None if v is None else float(v) for v in row[i]] for i, c in enumerate(columns)}

    counts = counts or count_known(df, columns)
    ranks: dict[str, set[int]] = {}
    for c in columns:
        for p in probabilities:
            if counts[c]:
                place = (counts[c] - 1) * p
                ranks.setdefault(c, set()).update({math.floor(place), math.ceil(place)})
    found = order_statistics(df, {c: sorted(r) for c, r in ranks.items()}, counts, task_rows)
    result: dict[str, list[float | None]] = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            if not counts[c]:
                result[c].append(None)
                continue
            place = (counts[c] - 1) * p
            part = place - math.floor(place)
            low, high = float(found[c, math.floor(place)]), float(found[c, math.ceil(place)])
            # Equal neighbours may be infinite, so they are not mixed.
            result[c].append(low if part == 0 or low == high else (1 - part) * low + part * high)
    return result
