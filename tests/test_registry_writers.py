"""The registry with several writers at the same time."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from plumbline.operators import registry


def test_two_writers_leave_no_gap_and_no_repeat(spark, tmp_path):
    path = str(tmp_path / "registry")

    def work(writer):
        return [registry.register(spark, path, "shared", "a", 1.0, f"{writer}/{i}") for i in range(10)]

    with ThreadPoolExecutor(2) as pool:
        versions = [v for found in pool.map(work, range(2)) for v in found]
    assert sorted(versions) == list(range(1, 21))
    rows = registry.read_registry(spark, path).collect()
    assert sorted(r["version"] for r in rows) == sorted(r["sequence"] for r in rows) == list(range(1, 21))
    assert len({r["uri"] for r in rows}) == 20
    # The drafts of late writers are gone.
    assert all(n.startswith("entry-") for n in os.listdir(path))


def test_a_file_appears_once_and_whole(spark, tmp_path):
    folder = str(tmp_path / "files")
    assert registry._publish(spark, folder, "a", "first\n")
    assert not registry._publish(spark, folder, "a", "second\n")
    assert open(f"{folder}/a").read() == "first\n" and os.listdir(folder) == ["a"]


def test_other_errors_are_raised(spark, tmp_path):
    (tmp_path / "file").write_text("")
    with pytest.raises(Exception, match="file"):
        registry._publish(spark, str(tmp_path / "file"), "a", "text")


def test_rows_keep_their_types(spark, tmp_path):
    path = str(tmp_path / "registry")
    registry.register(spark, path, "é \"quoted\"\n", "a", float(3), "u", ["x", "y z"], promoted=False)
    row = registry.read_registry(spark, path).first()
    assert row["name"] == "é \"quoted\"\n" and row["feature_names"] == ["x", "y z"] and row["rmse"] == 3.0
    assert row["promoted"] is False and row["registered_at"] is not None
