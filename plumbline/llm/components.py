"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.stored import Stored

#: More rounds than any real graph needs: stars halve path lengths.
MAX_ROUNDS = 60
#: Links that a task ties at once.
TIED = 1 << 18


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One round: tie each node's larger (or smaller) neighbours to its least one."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sides = both if large else both.filter("b < a")
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = sides.join(least, "a")
    if large:
        found = tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = tied.select("b", "m", "a")
        found = found.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return found.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _tied(links: DataFrame) -> DataFrame:
    """Links that tie the same nodes: those that a task meets together become ties to the least node."""

    def ties(found: list[tuple[int, int]]) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def least(x: int) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in found:
            a, b = least(a), least(b)
            parent[max(a, b)] = min(a, b)
        rows = [(x, top) for x in parent if (top := least(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(2)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for batch in batches:
            held.extend(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
            if len(held) >= TIED:
                yield ties(held)
                held = []
        if held:
            yield ties(held)

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def _sum(links: DataFrame) -> tuple:
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(links: DataFrame, stored: Stored) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b), a component being its least node.

    Every round is a join and an aggregate whose result is stored. A node with very
    many neighbours only meets its least one, so the join is skewed on one side alone
    and can be split.
    """
    links = stored.table(_tied(links.filter("a <> b")).distinct())
    before = _sum(links)
    for _ in range(MAX_ROUNDS):
        links = stored.table(_star(_star(links, True), False))
        now = _sum(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    # At the end every link ties a node to the least node of its component.
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)
