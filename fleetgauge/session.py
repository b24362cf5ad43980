"""Session set-up."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results or survivability, as opposed to sizing.
REQUIRED = {
    # Naive timestamps are UTC and windows are aligned to the UTC epoch.
    "spark.sql.session.timeZone": "UTC",
}

# Stream state on local disk with its changes in the checkpoint, so that its size is not bound by memory.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting rows costs a look-up per write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    **STREAMING,
}


def build_session(app_name: str = "fleetgauge", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above. Sizing (executors, shuffle partitions) is the caller's, through
    ``conf`` or spark-submit; dots in a key are written as double underscores."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **REQUIRED, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make a session made elsewhere safe for the operators."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """Settings for stateful streams in a session made elsewhere."""
    for key, value in STREAMING.items():
        spark.conf.set(key, value)
    return pin_utc(spark)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the streams that are started inside; each keeps the settings that it started with."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the storage every executor can reach, or below the warehouse,
    which a session always has, where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/fleetgauge/{purpose}-{uuid.uuid4().hex}"


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to where nothing is yet, in one step where the file system can. False if ``target`` is there:
    it stays, and ``source`` goes."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    files = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(new):
        files.delete(old, True)
        return False
    if not files.rename(old, new):
        raise OSError(f"could not move {source} to {target}")
    return True


def _hadoop(spark: SparkSession, location: str):
    """The file system of a location, and its path there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def children(spark: SparkSession, location: str) -> list[str]:
    """Names of the folders in a folder; none where it isn't there."""
    files, path = _hadoop(spark, location)
    return [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []


def make_folder(spark: SparkSession, location: str) -> None:
    files, path = _hadoop(spark, location)
    files.mkdirs(path)


def remove(spark: SparkSession, location: str) -> None:
    """Remove a folder and what is in it."""
    files, path = _hadoop(spark, location)
    files.delete(path, True)


def small_text(spark: SparkSession, location: str) -> str:
    """The text of a file of a few lines, read without a job."""
    files, path = _hadoop(spark, location)
    stream = files.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
