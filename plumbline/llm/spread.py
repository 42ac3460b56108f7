"""Places, running sums and joins in groups of any size, no group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.stored import Stored, share, shared

#: A key with more than one of so many rows goes by broadcast; there are fewer than so many such keys.
HOT_SHARE = 512


def running(
    df: DataFrame, group: str, order: list[Column | str], stored: Stored, sums: tuple[str, ...] = (), xors: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with ``place``, the place of each row in its group (from 0), and ``<c>_before`` for each c of ``sums`` and ``xors``.

    ``<c>_before`` joins the long column c over the rows of the group that come before, by sum (modulo 2**64) or exclusive or.
    Rows are sorted by group and order over ranges, which cut large groups in pieces. Only the last
    group of each range can go on in the next one, so one row per range tells every piece what
    came before it. ``group`` is a long column without nulls.
    """
    spark, names = df.sparkSession, df.columns
    cols = [f"c{i}" for i in range(len(names))]
    key, summed = cols[names.index(group)], [cols[names.index(c)] for c in (*sums, *xors)]
    joins = [np.add] * (len(sums) + 1) + [np.bitwise_xor] * len(xors)
    kinds = {c: df.schema[n].dataType.simpleString() for c, n in zip(cols, names)}
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    extra = [f"o{i}" for i in range(len(keys))]
    plain = df.select(*names, *(k.alias(o) for k, o in zip(keys, extra))).toDF(*cols, *extra)
    own = ["place", *(f"{c}_before" for c in summed)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, state = None, [np.uint64(0)] * (len(summed) + 1)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            of = batch.column(key).to_numpy()
            first = np.concatenate([[True], of[1:] != of[:-1]])
            begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            goes_on = (begin == 0) & (of[0] == last)
            results, new = [], []
            columns = [np.ones(n, np.uint64), *(batch.column(c).to_numpy().view(np.uint64) for c in summed)]
            for values, carried, join in zip(columns, state, joins):
                whole = np.concatenate([np.zeros(1, np.uint64), join.accumulate(values)])
                undo = np.subtract if join is np.add else join
                before = join(undo(whole[:-1], whole[begin]), np.where(goes_on, carried, np.uint64(0)))
                results.append(before)
                new.append(join(before[-1:], values[-1:])[0])
            last, state = of[-1], new
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in cols), *(pa.array(r.view(np.int64)) for r in results), pa.array(np.full(n, part, np.int32))],
                [*cols, *own, "part"])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in cols), *(f"{c} long" for c in own), "part int"])
    # The size of shuffles that the session is set to; adaptive execution does not join these ranges.
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored.table(
        plain.repartitionByRange(ranges, key, *extra).sortWithinPartitions(key, *extra).mapInArrow(run, schema), keep=True)
    # What the last group of each range adds up to, on to the ranges where it goes on.
    row = F.struct(key, "place")
    ends = placed.groupBy("part").agg(
        F.min(key).alias("first"), F.max(key).alias("last"),
        F.max_by(F.struct(F.lit(1).cast("long"), *summed), row).alias("at"), F.max_by(F.struct(*own), row).alias("before")).orderBy("part").collect()

    def joined(left: list[int], right: list[int]) -> list[int]:
        return [(a + b if join is np.add else a ^ b) % (1 << 64) for a, b, join in zip(left, right, joins)]

    offsets, open_group, held = {}, None, [0] * len(own)
    for r in ends:
        got = joined(r["at"], r["before"])
        if r["first"] == open_group:
            offsets[r["part"]] = (r["first"], held)
        if r["last"] == open_group:
            held = joined(held, got)
        else:
            open_group, held = r["last"], got
    sent = share(spark, offsets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared(sent)
        for batch in batches:
            of, parts = batch.column(key).to_numpy(), batch.column("part").to_numpy()
            results = [batch.column(c).to_numpy().view(np.uint64).copy() for c in own]
            for part in np.unique(parts):
                if int(part) in known:
                    group_id, more = known[int(part)]
                    rows = (parts == part) & (of == group_id)
                    for r, m, join in zip(results, more, joins):
                        r[rows] = join(r[rows], np.uint64(m))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), *(pa.array(r.view(np.int64)) for r in results)], [*cols, *own])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in cols), *(f"{c} long" for c in own)])
    return placed.mapInArrow(add, schema).toDF(*names, "place", *(f"{c}_before" for c in (*sums, *xors)))


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``left.join(right, keys, how)`` (inner or left) where ``right`` has a row for each key at most.

    Keys that many rows of ``left`` share meet their row of ``right`` by broadcast. These are fewer than
    ``HOT_SHARE`` rows, as each has more than one of ``HOT_SHARE`` rows of ``left``.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_of_key"))
    total = left.count()
    hot = counts.filter(F.col("rows_of_key") * HOT_SHARE > total).select(*keys)
    marked = left.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), keys, "left")
    few = right.join(F.broadcast(hot), keys, "left_semi")
    often = marked.filter("is_hot").drop("is_hot").join(F.broadcast(few), keys, how)
    return often.unionByName(marked.filter("is_hot is null").drop("is_hot").join(right, keys, how))
