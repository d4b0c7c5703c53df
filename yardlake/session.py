"""Spark sessions as the library expects them."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: UTC so that hashes of timestamps and dates do not depend on the machine; AQE sizes and splits shuffles.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
PLAIN_FILES = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    STATE_STORE: ROCKSDB,
    "spark.scheduler.mode": "FAIR",
}


def get_spark(app: str = "yardlake", **more: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | more).getOrCreate()


@lru_cache(1)
def package_zip() -> str:
    """This package's modules as one file."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="yardlake-")), "yardlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    z.write(file, os.path.relpath(file, os.path.dirname(root)))
    return path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once an application, so that they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        spark.sparkContext.addPyFile(package_zip())
        _shipped.add(app)


def sent_whole(module: ModuleType) -> None:
    """What a module defines goes to Python processes as it is, not as a name to import: Spark starts those in which it sets up
    stateful streams and sources on the driver without the files that ship() adds."""
    cloudpickle.register_pickle_by_value(module)


@contextmanager
def set_for_streams(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A stream copies the session's settings as it starts: those that start within the block have this one. The session's is then as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def rocksdb(spark: SparkSession):
    """Streams that start within the block keep their state in RocksDB, as transformWithState needs, whatever the session has. Their checkpoints
    keep this setting."""
    return set_for_streams(spark, STATE_STORE, ROCKSDB)


def lone_checkpoints(spark: SparkSession):
    """Streams that start within the block write their progress by the plain file system, which takes half as long for each trigger on a local one. For checkpoints that no
    second query opens at the same time: Spark's default also refuses the slower of two that write a batch's progress in the same moment."""
    return set_for_streams(spark, CHECKPOINT_FILES, PLAIN_FILES)
