"""Where intermediate tables go: the folder all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Folders handed out and not removed yet, in order.
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared folder, which must be set."""
    base = shared_folder(spark)
    if not base:
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    path = f"{base.rstrip('/')}/martloom/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: what follows does not depend on executors
    that computed it, and does not compute it again."""
    path = scratch_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the folders handed out inside, once what was made from them is no longer read."""
    before = len(_made)
    try:
        yield
    finally:
        paths = _made[before:]
        del _made[before:]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            hadoop(path).getFileSystem(conf).delete(hadoop(path), True)


def use_local_folder(spark: SparkSession) -> None:
    """For a trial in one process where nothing is set: a temporary folder, gone at exit.

    Never on a cluster, nor in its one-machine imitation: there executors and driver would not
    see each other's files.
    """
    if shared_folder(spark) or not spark.sparkContext.master.partition("[")[0] == "local":
        return
    base = tempfile.mkdtemp(prefix="martloom-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.conf.set(SETTING, base)
