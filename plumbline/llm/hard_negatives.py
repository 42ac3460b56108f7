"""Hard negatives for contrastive training by a secondary-sort shuffle.

Scores are integer inner products. Rows are sorted by label into ranges of bounded size and read in
cells: a group of anchors, which stays, meets a run of candidates, which stream past in batches. The
first cells, of anchors and the ranges that hold their label, give each anchor's positives. The second
cells, of anchors with the scores of their positives and all ranges, keep for each window below a
positive the best negatives of the cell. What is left goes through one shuffle by keys of (anchor,
descending score, positives first, id), sorted inside the partitions; an iterator then opens a window
with each positive and emits negatives as they come, holding no more than the open windows of one anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.stored import Stored
from plumbline.llm.top_k import usable

#: Rows of a range, ranges that a cell streams at most, and anchors that a cell holds.
RANGE_ROWS, CELL_RANGES, GROUP_ROWS = 8192, 128, 4096
#: Rows of vectors that are scored in one go.
BATCH_ROWS = 1024
_EXACT = float(1 << 53)


def integers(cells: pa.Array) -> np.ndarray:
    """floor(256 * x) of each component as exact doubles, one row per vector, short vectors padded with 0."""
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    sizes = cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(256.0 * cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    result = np.zeros((len(sizes), int(sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    result[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return result


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows; an error where one goes beyond 64 bits."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(width, 1) < _EXACT:
        return (left @ right.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in left], object) @ np.array([[int(x) for x in row] for row in right], object).T
    if max(abs(int(x)) for x in exact.ravel()) >= 1 << 63:
        raise ArithmeticError("a score goes beyond 64 bits")
    return exact.astype(np.int64)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """The anchors of each cell and a stream of its candidates, from batches sorted by (cell, side)."""

    def pieces() -> Iterator[tuple[int, int, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, side = batch.column("cell").to_numpy(), batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero((cell[1:] != cell[:-1]) | (side[1:] != side[:-1])) + 1), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                yield int(cell[begin]), int(side[begin]), batch.slice(begin, end - begin)

    stream = pieces()
    ahead = next(stream, None)
    while ahead is not None:
        cell, held = ahead[0], []
        while ahead is not None and ahead[:2] == (cell, 0):
            held.append(ahead[2])
            ahead = next(stream, None)

        def rest(cell: int = cell) -> Iterator[pa.RecordBatch]:
            nonlocal ahead
            while ahead is not None and ahead[0] == cell:
                for begin in range(0, ahead[2].num_rows, BATCH_ROWS):
                    yield ahead[2].slice(begin, BATCH_ROWS)
                ahead = next(stream, None)

        own = rest()
        if held:
            yield pa.Table.from_batches(held).combine_chunks(), own
        for _ in own:
            pass


class _Tops:
    """The ``k`` best (score, id, row) of each of ``n`` lists, fed part by part."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.lists = [(np.zeros(0, np.int64),) * 3 for _ in range(n)]

    def feed(self, i: int, *part: np.ndarray) -> None:
        score, ids, rows = (np.concatenate(x) for x in zip(self.lists[i], part))
        if len(score) > 4 * self.k:
            edge = np.partition(score, len(score) - self.k)[len(score) - self.k]
            near = np.flatnonzero(score >= edge)
            score, ids, rows = score[near], ids[near], rows[near]
        keep = np.lexsort((rows, ids, -score))[: self.k]
        self.lists[i] = score[keep], ids[keep], rows[keep]


_PAIRS = "anchor long, anchor_id long, down long, kind int, id long, row long"


def _pairs(anchors: pa.Table, owner: np.ndarray, tops: _Tops, kind: int) -> pa.RecordBatch:
    """The pairs of all lists, each once, with the anchor of each list."""
    at = np.repeat(owner, [len(x[0]) for x in tops.lists])
    score, ids, rows = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*tops.lists)) if tops.lists else (np.zeros(0, np.int64),) * 3
    _, first = np.unique(np.stack([at, rows]), axis=1, return_index=True)
    at = at[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors.column("row").to_numpy()[at]), pa.array(anchors.column("vec_id").to_numpy()[at]), pa.array(-score[first]),
         pa.array(np.full(len(first), kind, np.int32)), pa.array(ids[first]), pa.array(rows[first])],
        ["anchor", "anchor_id", "down", "kind", "id", "row"])


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, stream in _cells(batches):
            labels, own, vectors = anchors.column("label").to_numpy(), anchors.column("row").to_numpy(), integers(anchors.column("vector"))
            tops = _Tops(len(own), k)
            for part in stream:
                of, ids, rows = (part.column(c).to_numpy() for c in ("label", "vec_id", "row"))
                its = integers(part.column("vector"))
                for label in np.unique(of):
                    asking, there = np.flatnonzero(labels == label), np.flatnonzero(of == label)
                    scores = products(vectors[asking], its[there])
                    for a, s in zip(asking, scores):
                        other = rows[there] != own[a]
                        tops.feed(a, s[other], ids[there][other], rows[there][other])
            yield _pairs(anchors, np.arange(len(own)), tops, 0)

    return run


def _negatives(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, stream in _cells(batches):
            labels, vectors = anchors.column("label").to_numpy(), integers(anchors.column("vector"))
            lists = anchors.column("positives").combine_chunks()
            lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            # A list of the best for each window, from the least score that is hard enough to the positive's.
            owner, most = np.repeat(np.arange(len(labels)), sizes), lists.flatten().to_numpy()
            least = np.array([-(-percent * int(p) // 100) for p in most], np.int64)
            first = np.cumsum(sizes) - sizes
            tops = _Tops(len(owner), k)
            for part in stream:
                of, ids, rows = (part.column(c).to_numpy() for c in ("label", "vec_id", "row"))
                scores = products(vectors, integers(part.column("vector")))
                for a in np.flatnonzero(sizes):
                    windows = range(first[a], first[a] + sizes[a])
                    there = np.flatnonzero((scores[a] >= least[windows].min()) & (scores[a] <= most[windows].max()) & (of != labels[a]))
                    if not len(there):
                        continue
                    s = scores[a][there]
                    for w in windows:
                        fits = (s >= least[w]) & (s <= most[w])
                        if fits.any():
                            tops.feed(w, s[fits], ids[there][fits], rows[there][fits])
            yield _pairs(anchors, owner, tops, 1)

    return run


def _emit(k: int, percent: int):
    """Negatives of each positive's window, from rows sorted by (anchor, descending score, positives first, id)."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            found: list[tuple] = []
            for anchor, anchor_id, down, kind, own_id in zip(*(batch.column(c).to_pylist() for c in ("anchor", "anchor_id", "down", "kind", "id"))):
                if anchor != current:
                    current, windows = anchor, []
                if kind == 0:
                    windows.append([own_id, -down, 0])
                    continue
                # Scores fall: a window that is full, or whose end is passed, stays closed.
                windows = [w for w in windows if w[2] < k and percent * w[1] <= -100 * down]
                for w in windows:
                    w[2] += 1
                    found.append((anchor_id, w[0], w[2], own_id, w[1], -down))
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _ranges(df: DataFrame, n: int, name: str) -> DataFrame:
    """``df`` sorted into about ``n`` ranges of (label, row), with the number of the range."""
    names = df.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(np.full(batch.num_rows, own, np.int32))], [*names, name])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.repartitionByRange(n, "label", "row").sortWithinPartitions("label", "row").mapInArrow(number, f"{kinds}, {name} int")


def mine(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, percent: int = 80, range_rows: int = RANGE_ROWS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors.

    ``anchors`` is a condition on ``id_col``. Components x count as floor(256 * x); a row's score is its
    integer inner product with the anchor, in which a shorter vector's missing components are 0. Higher
    scores come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of the same
    label. For each, the first ``negatives`` rows of another label count whose score is at most the positive's and at least
    ``percent`` hundredths of it; a positive without such rows gives none, and so does a negative positive score.

    Rows with a null id or label, and vectors that are null or hold null, NaN or an infinity, take no part.
    Rows that repeat an id are rows of their own: each is a candidate, also for the
    other, and an anchor where the condition holds. An empty table gives no rows. Scores beyond 64 bits are an
    error. Other columns are not read.
    """
    spark = vectors.sparkSession
    stored = Stored(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    rows = stored.table(rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector")).withColumn(
        "row", F.monotonically_increasing_id()))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anchor").alias("anchors")).first()
    # Ranges of bounded size, smaller where that keeps all cores busy.
    busy = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = stored.table(_ranges(rows, max(-(-sizes.n // range_rows), min(-(-sizes.n // 256), busy), 1), "range"))
    asked = stored.table(_ranges(held.filter("is_anchor").drop("range"), max(-(-sizes.anchors // group_rows), 1), "group"))

    # A row for each range and each group: which labels they hold.
    spans = held.groupBy("range").agg(F.min("label").alias("low"), F.max("label").alias("high")).orderBy("range").collect()
    groups = asked.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high")).orderBy("group").collect()
    if not groups:
        stored.close()
        names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], names)
    per_cell = max(1, min(CELL_RANGES, len(spans) // busy))
    stripe_of = {r["range"]: i // per_cell for i, r in enumerate(spans)}
    stripes = max(stripe_of.values()) + 1
    held = held.join(F.broadcast(spark.createDataFrame(list(stripe_of.items()), "range int, stripe int")), "range")
    low, high = ([f([r[c] for r in spans if stripe_of[r["range"]] == s]) for s in range(stripes)] for c, f in (("low", min), ("high", max)))
    # Stripes and groups are in order of labels, so those that share labels with one are neighbours.
    meet = [[s for s in range(stripes) if low[s] <= g.high and high[s] >= g.low] for g in groups]
    of_group = spark.createDataFrame([(g.group, m[0], m[-1]) for g, m in zip(groups, meet)], "group int, first int, last int")
    of_stripe = [(s, [g.group for g in groups if low[s] <= g.high and high[s] >= g.low]) for s in range(stripes)]
    of_stripe = spark.createDataFrame([(s, m[0], m[-1]) for s, m in of_stripe if m], "stripe int, first int, last int")

    def cells(asking: DataFrame, there: DataFrame) -> DataFrame:
        """Sorted cells of (group, stripe, row ...) anchors and (stripe, group, row ...) candidates."""
        cell = (F.col("group").cast("long") * stripes + F.col("stripe")).alias("cell")
        data = ["row", "vec_id", "label", "vector"]
        more = [c for c in asking.columns if c == "positives"]
        left = asking.select(cell, F.lit(0).alias("side"), *data, *more)
        right = there.select(cell, F.lit(1).alias("side"), *data, *(F.lit(None).cast("array<long>").alias(c) for c in more))
        return left.unionByName(right).repartition("cell").sortWithinPartitions("cell", "side")

    some = F.explode(F.sequence("first", "last"))
    near = cells(asked.join(F.broadcast(of_group), "group").withColumn("stripe", some), held.join(F.broadcast(of_stripe), "stripe").withColumn("group", some))
    order = Window.partitionBy("anchor").orderBy("down", "id", "row")
    found = stored.table(
        near.mapInArrow(_positives(positives), _PAIRS).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives).drop("place"),
        keep=True)

    scores = found.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(-F.col("down")).alias("positives"))
    every = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
    numbers = F.array(*(F.lit(g.group) for g in groups)) if len(groups) < 64 else F.sequence(F.lit(groups[0].group), F.lit(groups[-1].group))
    far = cells(asked.join(scores, "row").withColumn("stripe", every), held.withColumn("group", F.explode(numbers)))
    hard = stored.table(far.mapInArrow(_negatives(negatives, percent), _PAIRS), keep=True)
    stored.close()
    keys = ["anchor", "down", "kind", "id", "row"]
    return found.unionByName(hard).repartition("anchor").sortWithinPartitions(*keys).mapInArrow(
        _emit(negatives, percent), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
