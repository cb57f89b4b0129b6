"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# A start for thousands of cores: long scan tasks, and many shuffle partitions of which AQE joins the
# small ones up to a size that one task sorts in memory.
LARGE_CLUSTER = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}

# Streams keep their state in RocksDB, off the JVM heap, and write changelogs instead of full snapshots.
STREAM_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


_local_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str, master: str | None = None, large: bool = False, **settings: str) -> SparkSession:
    """A session with this package's settings, and those for a ``large`` cluster.

    ``settings`` come on top and use ``__`` for the dots of a key.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    basic = {**SETTINGS, **(LARGE_CLUSTER if large else {})}
    for key, value in {**basic, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streams: same application, own settings, caller's settings untouched."""
    sibling = spark.newSession()
    for key, value in STREAM_SETTINGS.items():
        sibling.conf.set(key, value)
    # newSession starts from the application's settings, not the caller's own
    sibling.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return sibling


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which every executor can reach.

    Where the setting is absent a local master gets a folder of its own; a cluster
    gets an error, as a machine-local folder would lose data with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="wayfare-")
    return _local_dirs[application]


class _Scratch(threading.local):
    """Folder below the application's, per thread, that :func:`scratch` has opened."""

    name = ""


_scratch = _Scratch()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application so that it can be cleared later."""
    return f"{shared_dir(spark)}/wayfare/{spark.sparkContext.applicationId}/{_scratch.name}{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end what this thread has put to shared paths inside; for rounds of a service."""
    before, _scratch.name = _scratch.name, f"{_scratch.name}round-{uuid.uuid4().hex[:12]}/"
    try:
        yield
    finally:
        _delete(spark, f"{shared_dir(spark)}/wayfare/{spark.sparkContext.applicationId}/{_scratch.name}")
        _scratch.name = before


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet to the shared folder and read back.

    Cuts the lineage, fixes values that depend on the physical layout and survives
    the loss of executors. Later readers prune columns, which ``checkpoint()`` cannot.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; call it when no result is in use any more."""
    _delete(spark, f"{shared_dir(spark)}/wayfare/{spark.sparkContext.applicationId}")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once, so that they can import it anywhere."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="wayfare-")), "wayfare")
    shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(f"{archive}.zip")
    _shipped.add(application)
