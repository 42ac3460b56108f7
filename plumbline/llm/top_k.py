"""Exact top-k inner products with block-at-a-time pruning.

Vectors in order of their ids are cut into blocks. A block keeps its forward index
(the matrix of its vectors) and for each component the greatest and the least
value. For a query, the sum of each component times the extreme that helps it most
bounds the score of all vectors of a block. Blocks are taken by falling bound and
scored through their forward index, until the bound of the next one is below the
k-th score found so far.

A cell of the computation is some blocks and a group of queries, both of bounded size;
the k best of each cell meet in a window by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.stored import Stored

BLOCK_ROWS = 256
#: Vectors of a cell, and queries that meet them in one task.
SHARD_ROWS, QUERY_ROWS = 8192, 4096
#: Up to this size sums of doubles are exact.
_EXACT = float(1 << 53)


def _integers(cells: pa.Array) -> np.ndarray:
    """floor(256 * x) of each component, one row per vector, short vectors padded with 0."""
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    sizes = cells.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(256.0 * cells.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    result = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0))
    row = np.repeat(np.arange(len(sizes)), sizes)
    result[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return result


def _wider(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] >= width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; values beyond 64 bits stay at the end of the range."""
    top = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(queries.shape[1], 1)
    if top < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = [[sum(int(a) * int(b) for a, b in zip(q, v)) for v in vectors] for q in queries]
    ends = np.iinfo(np.int64)
    return np.array([[min(max(s, ends.min), ends.max) for s in row] for row in whole], np.int64).reshape(len(queries), len(vectors))


class Blocks:
    """Forward indexes of some vectors with the extremes of each block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: int = BLOCK_ROWS, marks: np.ndarray | None = None) -> None:
        order = np.argsort(ids, kind="stable")
        marks = (ids if marks is None else marks)[order]
        ids, vectors = ids[order], vectors[order]
        self.parts = [(ids[i : i + rows], vectors[i : i + rows], marks[i : i + rows]) for i in range(0, len(ids), rows)]
        self.most = np.array([v.max(axis=0) for _, v, _ in self.parts])
        self.least = np.array([v.min(axis=0) for _, v, _ in self.parts])

    def best(self, ids: np.ndarray, queries: np.ndarray, k: int, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query row, vec_id, score) of the k best of each query and the blocks that were scored.

        A candidate with a query's mark is the query itself.
        """
        marks = ids if marks is None else marks
        width = max(queries.shape[1], self.most.shape[1])
        queries = _wider(queries, width)
        most, least = _wider(self.most, width), _wider(self.least, width)
        bound = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
        order = np.argsort(-bound, axis=1, kind="stable")
        tops: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        kth = np.full(len(ids), -np.inf)
        scored = 0
        open_rows = np.arange(len(ids))
        for step in range(order.shape[1]):
            # A bound equal to the k-th score may still hide a tie with a smaller id; rounding
            # of huge bounds is allowed for.
            slack = np.abs(bound[open_rows, order[open_rows, step]]) * 1e-9
            open_rows = open_rows[bound[open_rows, order[open_rows, step]] + slack >= kth[open_rows]]
            if not len(open_rows):
                break
            block = order[open_rows, step]
            for b in np.unique(block):
                rows = open_rows[block == b]
                its, vectors, own = self.parts[b]
                scores = _scores(queries[rows], _wider(vectors, width))
                scored += len(rows)
                good = (scores >= kth[rows][:, None]) & (own[None, :] != marks[rows][:, None])
                for i in np.flatnonzero(good.any(axis=1)):
                    row = rows[i]
                    s = np.concatenate([tops[row][0], scores[i][good[i]]])
                    v = np.concatenate([tops[row][1], its[good[i]]])
                    keep = np.lexsort((v, -s))[:k] if s.min(initial=0) > np.iinfo(np.int64).min else np.array(
                        sorted(range(len(s)), key=lambda j: (-int(s[j]), int(v[j])))[:k], np.int64)
                    tops[row] = (s[keep], v[keep])
                    if len(keep) == k:
                        kth[row] = s[keep[-1]]
        sizes = [len(s) for s, _ in tops]
        rows = np.repeat(np.arange(len(ids)), sizes)
        empty = [np.zeros(0, np.int64)]
        return rows, np.concatenate([v for _, v in tops] or empty), np.concatenate([s for s, _ in tops] or empty), scored


def usable(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))


def search(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors of highest score for each query.

    Both tables have an id and an array of numbers, of which components x count as
    floor(256 * x). The score is the integer inner product; where one vector is
    shorter, its missing components are 0. Equal scores are ranked by smaller id. A row
    equal to the query in id and vector is the query's own and no candidate; of several such rows one is left out. Fewer than ``k`` candidates give fewer rows.

    Rows with a null id or a vector that is null or holds null, NaN or an infinity take no
    part. Query rows that repeat an id are each answered; candidate rows that repeat an id
    are candidates each. Scores beyond 64 bits are given as the largest or smallest
    64-bit number. Empty tables give no rows. Other columns are not read.
    """
    stored = Stored(vectors.sparkSession)

    def ready(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return df.filter(F.col("vec_id").isNotNull() & usable("vector"))

    mark = F.xxhash64("vec_id", "vector")
    held = stored.table(ready(vectors).withColumns({"row": F.monotonically_increasing_id(), "mark": mark}))
    asked = stored.table(ready(queries).withColumns({"row": F.monotonically_increasing_id(), "mark": mark}))
    # Copies of a row but the first get marks of their own, so that they are candidates.
    copies = held.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).filter("n > 1")
    if not copies.isEmpty():
        firsts = copies.select(F.col("first").alias("row"), F.lit(True).alias("is_first"))
        twice = held.join(copies.select("mark"), "mark", "left_semi").join(firsts, "row", "left").withColumn(
            "mark", F.when(F.col("is_first"), F.col("mark")).otherwise(F.xxhash64("mark", "row"))).select(*held.columns)
        held = stored.table(held.join(copies.select("mark"), "mark", "left_anti").select(*held.columns).unionByName(twice))
    shards = -(-held.count() // shard_rows) or 1
    groups = -(-asked.count() // query_rows) or 1
    # Ranges of ids; a repeated id may span several.
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, shard, np.int32)), batch.column("vec_id"), batch.column("vector"), batch.column("mark")],
                ["shard", "vec_id", "vector", "mark"])

    placed = stored.table(
        held.repartitionByRange(shards, "vec_id", "row").mapInArrow(number, "shard int, vec_id long, vector array<double>, mark long"))
    shards = (placed.agg(F.max("shard")).first()[0] or 0) + 1
    left = placed.select("shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), F.lit(0).alias("side"),
                         "vec_id", "vector", F.lit(0).cast("long").alias("row"), "mark")
    right = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                         F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"), F.lit(1).alias("side"),
                         "vec_id", "vector", "row", "mark")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides = None, ([], [])

        def close() -> Iterator[pa.RecordBatch]:
            if current is None or not sides[0] or not sides[1]:
                return
            both = [pa.Table.from_batches(side).combine_chunks() for side in sides]
            vecs, asks = ((t.column("vec_id").to_numpy(), _integers(t.column("vector"))) for t in both)
            row, found, score, _ = Blocks(*vecs, block_rows, both[0].column("mark").to_numpy()).best(*asks, k, both[1].column("mark").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(asks[0][row]), pa.array(both[1].column("row").to_numpy()[row]), pa.array(found), pa.array(score)],
                ["query_id", "row", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("shard", "part", "side")]
            new = np.any([c[1:] != c[:-1] for c in keys], axis=0)
            cuts = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                cell = (int(keys[0][begin]), int(keys[1][begin]))
                if cell != current:
                    yield from close()
                    current, sides = cell, ([], [])
                sides[int(keys[2][begin])].append(batch.slice(begin, end - begin))
        yield from close()

    best = stored.table(
        left.unionByName(right).repartition(F.col("shard"), F.col("part")).sortWithinPartitions("shard", "part", "side")
        .mapInArrow(cells, "query_id long, row long, vec_id long, score long"), keep=True)
    stored.close()
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
