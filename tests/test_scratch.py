"""Intermediate tables go to the session's shared folder, and go away when asked to."""

import os
from pathlib import Path

import pytest

import bench
from martloom.sources import scratch as s


class Session:
    """What the module asks of a session, with other settings."""

    def __init__(self, spark, master, folder=None):
        self.settings = {s.SETTING: folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self._jvm, self._jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    def get(self, name, default=None):
        return self.settings.get(name, default)

    def set(self, name, value):
        self.settings[name] = value

    def getConf(self):
        return self


def test_nothing_is_made_up_where_no_folder_is_set(spark):
    for master in ("local[4]", "local-cluster[2,1,1024]", "spark://host:7077", "yarn"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            s.scratch_dir(Session(spark, master), "x")


def test_a_local_trial_may_have_a_temporary_folder(spark):
    session = Session(spark, "local[2]")
    s.use_local_folder(session)
    assert os.path.isdir(session.get(s.SETTING))
    for master in ("local-cluster[2,1,1024]", "spark://host:7077"):
        session = Session(spark, master)
        s.use_local_folder(session)
        assert not session.settings
    session = Session(spark, "local", "/given")
    s.use_local_folder(session)
    assert session.get(s.SETTING) == "/given"


def test_folders_are_removed_at_the_end(spark):
    kept = s.stored(spark.range(3))
    with s.scratch(spark):
        gone = s.stored(spark.range(5))
        assert gone.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        gone.count()
    with pytest.raises(ValueError), s.scratch(spark):
        path = s.scratch_dir(spark, "failed")
        spark.range(1).write.parquet(path)
        raise ValueError
    assert not Path(path.removeprefix("file:")).exists()
    assert kept.count() == 3


def test_bench_leaves_nothing_behind(spark):
    root = Path(s.shared_folder(spark).removeprefix("file:")) / "martloom"
    before = set(root.glob("*"))
    assert bench.run(spark, "append_batches", "/root/testdata/sf0.001") > 0
    assert set(root.glob("*")) == before
