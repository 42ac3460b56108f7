"""Global ranks, rank correlation and Kendall's tau.

No step puts a whole column into one window. Values are counted first, the
counts are cut into ranges of bounded size, and a prefix sum over the range
totals turns positions inside a range into global ones.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import known, labelled, quoted, require_columns, rows_from, small_table, union_all
from plumbline.operators.quantiles import SKETCH_SIZE, TASK_ROWS, sketched
from plumbline.session import materialize

# Rows of a lookup table that every executor may hold (two numbers per row).
# Largest sketch that Spark makes.
MOST_SKETCH = 65535
BROADCAST_ROWS = 1_000_000
# A value is hot when it fills more than this share of the table.
HOT_SHARE = 1 / 2000
SALTS = 1024
# Pairs of columns correlated in one scan.
PAIRS_PER_SCAN = 300
# Least number of x positions per slice when pairs are counted.
SLICE_ROWS = 4096


@dataclass(frozen=True)
class Ranking:
    """Ranks of the distinct values of several columns.

    ``table`` has (code, value, n, before, position): number of the column,
    copies of the value, smaller rows, and smaller distinct values.
    """

    table: DataFrame
    codes: dict[str, int]
    distinct: dict[str, int]
    rows: dict[str, int]

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("code") == self.codes[column]).drop("code")


def rank_values(df: DataFrame, columns: Sequence[str], task_rows: int = TASK_ROWS) -> Ranking:
    require_columns(df, columns)
    codes = {c: i for i, c in enumerate(dict.fromkeys(columns))}
    long = rows_from(
        df, [labelled(code=F.lit(i), value=known(df, c).cast("double") + F.lit(0.0)) for c, i in codes.items()]
    )
    counts = materialize(
        long.where(F.col("value").isNotNull())
        .groupBy("code", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sizes = {
        r["code"]: r for r in counts.groupBy("code").agg(F.count("*").alias("d"), F.sum("n").alias("r")).collect()
    }
    distinct = {c: sizes[i]["d"] if i in sizes else 0 for c, i in codes.items()}
    rows = {c: sizes[i]["r"] if i in sizes else 0 for c, i in codes.items()}
    ranged = _with_ranges(counts, codes, distinct, task_rows)
    inside = Window.partitionBy("code", "range").orderBy("value")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "code",
        "value",
        "n",
        "range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        (F.row_number().over(inside) - 1).cast("bigint").alias("position"),
    )
    if all(d <= task_rows for d in distinct.values()):
        table = local.drop("range")
    else:
        table = _with_offsets(ranged, local)
    return Ranking(materialize(table, partition_by="code"), codes, distinct, rows)


def _with_ranges(
    counts: DataFrame, codes: dict[str, int], distinct: dict[str, int], task_rows: int
) -> DataFrame:
    """Number the ranges of each column; only columns too large for one task get several."""
    large = [c for c, d in distinct.items() if d > task_rows]
    if not large:
        return counts.withColumn("range", F.lit(0))
    cuts = {}
    for c in large:
        ranges = math.ceil(distinct[c] / task_rows)
        cuts[c] = [i / ranges for i in range(1, ranges)]
    # A finer sketch for more ranges, as far as there are finer ones.
    size = min(MOST_SKETCH, max(SKETCH_SIZE, 4 * max(len(c) for c in cuts.values())))
    columns = [F.when(F.col("code") == codes[c], F.col("value")) for c in large]
    row = sketched(counts, columns, [False] * len(large), [cuts[c] for c in large], size)
    splits = [[-math.inf, *sorted(set(row[i])), math.inf] for i in range(len(large))]
    wide = counts.withColumns({
        f"__v{i}": F.when(F.col("code") == codes[c], F.col("value")) for i, c in enumerate(large)
    })
    cutter = Bucketizer(
        splitsArray=splits,
        inputCols=[f"__v{i}" for i in range(len(large))],
        outputCols=[f"__r{i}" for i in range(len(large))],
        handleInvalid="keep",
    )
    number = F.lit(0)
    for i, c in enumerate(large):
        number = F.when(F.col("code") == codes[c], F.col(f"__r{i}").cast("int")).otherwise(number)
    return cutter.transform(wide).select("code", "value", "n", number.alias("range"))


def _with_offsets(ranged: DataFrame, local: DataFrame) -> DataFrame:
    # One row per range of TASK_ROWS values.
    totals = ranged.groupBy("code", "range").agg(F.sum("n").alias("tn"), F.count("*").alias("td"))
    earlier = Window.partitionBy("code").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "code",
        "range",
        F.coalesce(F.sum("tn").over(earlier), F.lit(0)).alias("on"),
        F.coalesce(F.sum("td").over(earlier), F.lit(0)).alias("od"),
    )
    return local.join(F.broadcast(offsets), ["code", "range"]).select(
        "code",
        "value",
        "n",
        (F.col("before") + F.col("on")).alias("before"),
        (F.col("position") + F.col("od")).alias("position"),
    )


def average_rank() -> Column:
    """1-based rank; equal values share the mean of their places."""
    return F.col("before") + (F.col("n") + 1) / F.lit(2.0)


def lookup(
    df: DataFrame,
    ranking: Ranking,
    column: str,
    payload: Column,
    output: str,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add the payload of the column's value to every row.

    Small tables are broadcast. Otherwise the few hot values are broadcast and
    taken out of the shuffled join: their rows get a NULL key and a salt, so
    they spread over all tasks.
    """
    table = ranking.of(column).select(F.col("value").alias("__v"), "n", payload.alias(output))
    value = known(df, column).cast("double") + F.lit(0.0)
    keyed = df.withColumn("__k", value)
    if ranking.distinct[column] <= broadcast_rows:
        small = table.select(F.col("__v").alias("__k"), output)
        return keyed.join(F.broadcast(small), "__k", "left").drop("__k")
    limit = max(1, int(ranking.rows[column] * HOT_SHARE))
    hot = table.where(F.col("n") > limit).select(F.col("__v").alias("__k"), F.col(output).alias("__hot"))
    cold = table.where(F.col("n") <= limit).select(
        F.col("__v").alias("__c"), F.lit(0).alias("__salt"), F.col(output).alias("__cold")
    )
    spread = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(SALTS)).cast("int")
    free = F.col("__hot").isNotNull() | F.col("__k").isNull()
    marked = keyed.join(F.broadcast(hot), "__k", "left")
    marked = marked.withColumn("__salt", F.when(free, spread).otherwise(F.lit(0))).withColumn(
        "__c", F.when(~free, F.col("__k"))
    )
    joined = marked.join(cold, ["__c", "__salt"], "left")
    return joined.withColumn(output, F.coalesce("__hot", "__cold")).drop(
        "__k", "__c", "__salt", "__hot", "__cold"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Every pair (both ways and the diagonal) of (column_a, column_b, n, r).

    Pairs use the rows where both values are known.
    """
    columns = list(columns)
    require_columns(df, columns)
    if method == "spearman":
        return _spearman_matrix(df, columns)
    if method != "pearson":
        raise ValueError(f"unknown method {method!r}")
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    # One scan holds a bounded number of aggregates, so very wide tables take several scans.
    chunks = [pairs[i:i + PAIRS_PER_SCAN] for i in range(0, len(pairs), PAIRS_PER_SCAN)]
    results = []
    for chunk in chunks:
        results.append(_mirrored(df.agg(*pair_parts(df, chunk)), chunk))
    return union_all(results)


def pair_parts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> list[Column]:
    """Pearson's r{i} and the common rows n{i} of each pair."""
    parts = []
    for i, (a, b) in enumerate(pairs):
        x, y = known(df, a).cast("double"), known(df, b).cast("double")
        # The built-in correlation divides by zero where a column is constant.
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        parts += [
            F.try_divide(F.covar_pop(x, y), spread).alias(f"r{i}"),
            F.count_if(x.isNotNull() & y.isNotNull()).alias(f"n{i}"),
        ]
    return parts


def _mirrored(wide: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(
                labelled(column_a=F.lit(left), column_b=F.lit(right), n=F.col(f"n{i}"), r=F.col(f"r{i}"))
            )
    return rows_from(wide, cells)


def _spearman_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    gaps = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(known(df, c)).alias(f"k{i}") for i, c in enumerate(columns)]
    ).first()
    whole = [c for i, c in enumerate(columns) if gaps[f"k{i}"] == gaps["rows"]]
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    shared = [p for p in pairs if p[0] in whole and p[1] in whole]
    found = []
    if shared:
        found.append(_ranked_correlations(df, sorted({c for p in shared for c in p}), shared))
    gapped = [p for p in pairs if p not in shared]
    if gapped:
        found.append(_gapped_correlations(df, gapped, whole))
    return union_all(found)


def _gapped_correlations(
    df: DataFrame, pairs: Sequence[tuple[str, str]], whole: Sequence[str] = (), task_rows: int = TASK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rank correlations of pairs with gaps, all from one ranking and two look-ups.

    Ranks of a pair depend on its common rows. A side of a pair is a column and the columns whose gaps leave rows
    out; pairs with the same side share its ranks. Rows of all pairs form one long table, so joins and stored
    tables don't grow with the pairs.
    """
    sides: dict[tuple, int] = {}
    coded = []
    for a, b in pairs:
        gaps = tuple(sorted({c for c in (a, b) if c not in whole}))
        coded.append(tuple(sides.setdefault((c, gaps), len(sides)) for c in (a, b)))
    wide = df.select(*[_side(df, c, gaps).alias(f"__s{i}") for (c, gaps), i in sides.items()])
    # Columns are numbered in the order given, so the code of a side is its number.
    ranking = rank_values(wide, wide.columns, task_rows)
    counts = [ranking.rows[c] for c in wide.columns]
    middles = small_table(
        df.sparkSession, [(i, (n + 1) / 2.0) for i, n in enumerate(counts)], "code int, middle double"
    )
    table = ranking.table.join(F.broadcast(middles), "code").select(
        "code", F.col("value"), "n", (average_rank() - F.col("middle")).alias("d")
    )
    cells = [
        labelled(pair=F.lit(i), cx=F.lit(cx), x=F.col(f"__s{cx}"), cy=F.lit(cy), y=F.col(f"__s{cy}"))
        for i, (cx, cy) in enumerate(coded)
    ]
    rows = rows_from(wide, cells).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    small = sum(ranking.distinct.values()) <= broadcast_rows
    # Values that fill a share of the long table: never more than 1 / HOT_SHARE of them.
    hot = max(1, int(sum(counts[cx] for cx, _ in coded) * HOT_SHARE))
    for code, value, output in (("cx", "x", "dx"), ("cy", "y", "dy")):
        rows = _side_ranks(rows, table, code, value, output, None if small else hot)
    x, y = F.col("dx"), F.col("dy")
    spread = F.sqrt(F.sum(x * x)) * F.sqrt(F.sum(y * y))
    found = rows.groupBy("pair").agg(
        F.count(F.lit(1)).alias("n"), F.when(spread > 0, F.sum(x * y) / spread).alias("r")
    )
    # Both directions of every pair; pairs without a common row keep a row of their own.
    names = [
        (i, left, right) for i, (a, b) in enumerate(pairs) for left, right in sorted({(a, b), (b, a)})
    ]
    named = small_table(df.sparkSession, names, "pair int, column_a string, column_b string")
    return F.broadcast(named).join(found, "pair", "left").select(
        "column_a", "column_b", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "r"
    )


def _side(df: DataFrame, column: str, gaps: Sequence[str]) -> Column:
    there = F.lit(True)
    for c in gaps:
        there = there & known(df, c).isNotNull()
    return F.when(there, known(df, column).cast("double") + F.lit(0.0))


def _side_ranks(
    rows: DataFrame, table: DataFrame, code: str, value: str, output: str, hot: int | None
) -> DataFrame:
    """Replace a side's code and value by its centred rank: by broadcast, or only hot values so and others by a shuffle."""
    keyed = table.withColumnsRenamed({"code": code, "value": value})
    if hot is None:
        return rows.join(F.broadcast(keyed.select(code, value, F.col("d").alias(output))), [code, value]).drop(code, value)
    common = keyed.where(F.col("n") > hot).select(code, value, F.col("d").alias("__hot"))
    marked = rows.join(F.broadcast(common), [code, value], "left")
    rare = keyed.where(F.col("n") <= hot).select(code, value, F.col("d").alias(output))
    done = marked.where(F.col("__hot").isNotNull()).withColumnRenamed("__hot", output).drop(code, value)
    rest = marked.where(F.col("__hot").isNull()).drop("__hot").join(rare, [code, value]).drop(code, value)
    return done.unionByName(rest)


def _ranked_correlations(
    df: DataFrame, columns: list[str], pairs: list[tuple[str, str]], task_rows: int = TASK_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    ranking = rank_values(df, columns, task_rows)
    frame = df.select(*[quoted(c) for c in columns])
    if sum(ranking.distinct[c] for c in columns) > broadcast_rows:
        # Folding equal rows first makes the salt of the join spread a hot value.
        frame = frame.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("__w"))
    else:
        frame = frame.withColumn("__w", F.lit(1))
    room = broadcast_rows
    for i, c in sorted(enumerate(columns), key=lambda item: ranking.distinct[item[1]]):
        middle = (ranking.rows[c] + 1) / 2.0
        frame = lookup(frame, ranking, c, average_rank() - F.lit(middle), f"__d{i}", room)
        # All broadcast tables share one allowance, smallest tables first.
        room = max(0, room - ranking.distinct[c])
    weight = F.col("__w")
    parts = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(f"__d{columns.index(a)}"), F.col(f"__d{columns.index(b)}")
        spread = F.sqrt(F.sum(weight * x * x)) * F.sqrt(F.sum(weight * y * y))
        parts += [
            F.when(spread > 0, F.sum(weight * x * y) / spread).alias(f"r{i}"),
            F.coalesce(F.sum(F.when(x.isNotNull() & y.isNotNull(), weight)), F.lit(0)).cast("bigint").alias(f"n{i}"),
        ]
    return _mirrored(frame.agg(*parts), pairs)


def spearman(
    df: DataFrame, x: str, y: str, task_rows: int = TASK_ROWS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row (n, r): Spearman correlation over the rows where both are known."""
    both = df.select(quoted(x), quoted(y)).where(known(df, x).isNotNull() & known(df, y).isNotNull())
    found = _ranked_correlations(both, [x, y], [(x, y)], task_rows, broadcast_rows)
    return found.where((F.col("column_a") == x) & (F.col("column_b") == y)).select("n", "r")


def kendall(
    df: DataFrame, x: str, y: str, task_rows: int = TASK_ROWS, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Kendall's tau-b and its pair counts, exactly and without comparing pairs.

    Two rows are ordered by y at the highest bit in which their y positions
    differ. For each bit, rows that agree in all higher bits form a block; in
    it, a row with the bit set is concordant with the rows of smaller x that
    have it clear. So counting pairs takes one prefix sum per bit. Blocks are
    cut into slices of equally many x positions, so no task holds a block.
    """
    both = df.select(known(df, x).alias("x"), known(df, y).alias("y")).dropna()
    ranking = rank_values(both, ["x", "y"], task_rows)
    cells = both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    cells = lookup(cells, ranking, "x", F.col("position"), "px", broadcast_rows)
    room = broadcast_rows - ranking.distinct["x"] if ranking.distinct["x"] <= broadcast_rows else broadcast_rows
    cells = lookup(cells, ranking, "y", F.col("position"), "py", room)
    cells = materialize(cells.select("px", "py", "w"))

    bits = max(1, (max(ranking.distinct["y"], 1) - 1).bit_length())
    slice_width = max(SLICE_ROWS, math.isqrt(max(ranking.distinct["x"], 1)))
    level = F.explode(F.sequence(F.lit(0), F.lit(bits - 1))).alias("bit")
    leveled = cells.select("px", "py", "w", level)
    is_set = F.expr("shiftright(py, bit) & 1") == 1
    per_x = (
        leveled.groupBy("bit", F.expr("shiftright(py, bit + 1)").alias("block"), "px")
        .agg(
            F.sum(F.when(is_set, F.col("w")).otherwise(0)).alias("ones"),
            F.sum(F.when(is_set, 0).otherwise(F.col("w"))).alias("zeros"),
        )
        .withColumn("slice", F.floor(F.col("px") / slice_width))
    )
    exact = "decimal(38,0)"
    inner = Window.partitionBy("bit", "block", "slice").orderBy("px").rowsBetween(Window.unboundedPreceding, -1)
    within = per_x.select(
        "bit", "block", "slice", "ones", "zeros",
        F.coalesce(F.sum("ones").over(inner), F.lit(0)).alias("ones_before"),
        F.coalesce(F.sum("zeros").over(inner), F.lit(0)).alias("zeros_before"),
    )
    # Per slice: pairs inside it, and its totals for the pairs with earlier slices.
    slices = within.groupBy("bit", "block", "slice").agg(
        F.sum("ones").alias("ones"),
        F.sum("zeros").alias("zeros"),
        F.sum(F.col("ones").cast(exact) * F.col("zeros_before")).cast(exact).alias("up"),
        F.sum(F.col("zeros").cast(exact) * F.col("ones_before")).cast(exact).alias("down"),
    )
    outer = Window.partitionBy("bit", "block").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ordered = slices.select(
        "ones", "zeros", "up", "down",
        F.coalesce(F.sum("ones").over(outer), F.lit(0)).alias("ones_before"),
        F.coalesce(F.sum("zeros").over(outer), F.lit(0)).alias("zeros_before"),
    )
    pairs = ordered.agg(
        F.sum((F.col("up") + F.col("ones").cast(exact) * F.col("zeros_before")).cast(exact)).cast("double").alias("c"),
        F.sum((F.col("down") + F.col("zeros").cast(exact) * F.col("ones_before")).cast(exact))
        .cast("double").alias("d"),
    ).first()

    def tied(column: str) -> tuple[float, float, float]:
        n = F.col("n").cast("double")
        r = ranking.of(column).agg(
            F.sum(n * (n - 1) / 2), F.sum(n * (n - 1) * (n - 2)), F.sum(n * (n - 1) * (2 * n + 5))
        ).first()
        return r[0] or 0.0, r[1] or 0.0, r[2] or 0.0

    n = ranking.rows["x"]
    concordant, discordant = pairs["c"] or 0.0, pairs["d"] or 0.0
    (tx, tx2, txv), (ty, ty2, tyv) = tied("x"), tied("y")
    all_pairs = n * (n - 1) / 2.0
    scale = math.sqrt(all_pairs - tx) * math.sqrt(all_pairs - ty)
    tau = (concordant - discordant) / scale if scale > 0 else None
    variance = None
    if n > 2:
        m = n * (n - 1.0)
        variance = (
            (m * (2 * n + 5) - txv - tyv) / 18.0 + 2.0 * tx * ty / m + tx2 * ty2 / (9.0 * m * (n - 2))
        )
    z = (concordant - discordant) / math.sqrt(variance) if variance else None
    schema = "n bigint, concordant double, discordant double, ties_x double, ties_y double, tau double, z double"
    return small_table(df.sparkSession, [(n, concordant, discordant, tx, ty, tau, z)], schema)
