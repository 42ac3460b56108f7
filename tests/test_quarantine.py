"""A stream that parts good from rejected records and survives being cut off."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml.feature import SQLTransformer

from plumbline.functions.columns import small_table
from plumbline.operators.quality import between, one_of
from plumbline.operators.scoring import Preparation, Scorer
from plumbline.streaming import scoring as streaming

SCHEMA = "id bigint, size double, kind string"


def scorer():
    return Scorer(
        Preparation(features=("size",)), SQLTransformer(statement="SELECT *, size * 0.1 AS prediction FROM __THIS__"), "m:1",
        (between("size", 0, 100), one_of("kind", ["a", "b"])),
    )


def rows(i):
    """Ten records a file: two break a rule, one has no size and one repeats."""
    good = [(10 * i + j, float(j), "a") for j in range(6)]
    return [*good, good[0], (10 * i + 7, -1.0, "a"), (10 * i + 8, 5.0, "x"), (10 * i + 9, None, "b")]


@pytest.fixture()
def inbox(spark, tmp_path):
    path = str(tmp_path / "inbox")
    for i in range(4):
        small_table(spark, rows(i), SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def run(spark, inbox, tmp_path):
    stream = streaming.read_records(spark, inbox, spark.read.parquet(inbox).schema, files_per_trigger=1)
    places = [str(tmp_path / n) for n in ("scores", "rejected", "mark")]
    streaming.write_checked(stream, scorer(), ["id"], *places).awaitTermination()
    return places[:2]


def check(spark, scores, rejected):
    good = sorted(r["id"] for r in spark.read.parquet(scores).collect())
    bad = sorted((r["id"], tuple(r["violations"])) for r in spark.read.parquet(rejected).collect())
    assert good == sorted(k for i in range(4) for k, *_ in rows(i)[:7])
    assert bad == sorted(
        (10 * i + k, v) for i in range(4)
        for k, v in ((7, ("size_range",)), (8, ("kind_allowed",)), (9, ("size_range", "incomplete")))
    )


def test_records_are_in_one_of_two_tables(spark, inbox, tmp_path):
    check(spark, *run(spark, inbox, tmp_path))
    check(spark, *run(spark, inbox, tmp_path))
    kept = spark.read.parquet(str(tmp_path / "rejected"))
    assert set(kept.columns) == {"id", "size", "kind", "violations", "batch"}


@pytest.mark.parametrize("cut", ["before", "between", "after"])
def test_restart_leaves_each_record_once(spark, inbox, tmp_path, monkeypatch, cut):
    whole, seen = streaming.quarantine_batch, []

    def broken(batch, batch_id, scorer, keep, scores, rejected):
        seen.append(batch_id)
        if len(seen) != 2:
            return whole(batch, batch_id, scorer, keep, scores, rejected)
        if cut == "between":
            # The second table can't be written: its place is no folder.
            return whole(batch, batch_id, scorer, keep, scores, "nowhere://x")
        if cut == "after":
            whole(batch, batch_id, scorer, keep, scores, rejected)
        raise RuntimeError("cut off")

    monkeypatch.setattr(streaming, "quarantine_batch", broken)
    with pytest.raises(StreamingQueryException):
        run(spark, inbox, tmp_path)
    check(spark, *run(spark, inbox, tmp_path))
    assert seen[1] == seen[2]  # the batch that was cut off ran again


def test_clashing_columns_raise(spark):
    batch = small_table(spark, [(1, 1.0, "a", "u")], "id bigint, size double, kind string, currency string")
    with pytest.raises(ValueError, match="currency"):
        streaming.quarantine_batch(batch, 0, scorer(), ["id"], "s", "r")
