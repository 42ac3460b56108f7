"""The shared folder follows the session's setting."""

import os
import subprocess
import sys

import pytest

from plumbline import session

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from plumbline import session
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {folder!r}).getOrCreate())
assert session.shared_dir(spark) == {folder!r}
assert {folder!r} in spark.sparkContext.getCheckpointDir()
kept = session.materialize(spark.range(5))
assert kept.count() == 5 and {folder!r} in kept.inputFiles()[0]
assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")
"""


def test_configured_folder(tmp_path):
    repo = session.__file__.rsplit("/", 2)[0]
    script = SCRIPT.format(repo=repo, folder=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr


class _Cluster:
    """What ``shared_dir`` asks of a session on a cluster without the setting."""

    class conf:
        @staticmethod
        def get(key, default):
            return default

    class sparkContext:
        master = "yarn"
        applicationId = "application-without-folder"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None


def test_cluster_needs_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Cluster())


def test_local_session_keeps_its_folder(spark):
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_temporary_tables_are_deleted_at_the_end_of_their_block(spark):
    with session.temporary_tables(spark):
        kept = session.materialize(spark.range(5))
        path = kept.inputFiles()[0]
        assert kept.count() == 5 and os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
    assert session.materialize(spark.range(3)).count() == 3
