"""Session helpers: shared work folder, checkpointing, GBK-capable session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings for the command line jobs; results are the same without them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Keeps the totals of many merchants outside the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: For jobs that write a large table: sides that are partitioned by a part of their join key need no other exchange, files of an
#: exchange go when its job ends, and columns are packed closer. Results are the same without them.
LARGE_WRITES = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="netledger-"))
    return _LOCAL_FOLDER[0]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/netledger/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder unless the cluster already has."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextmanager
def large_writes(spark: SparkSession) -> Iterator[None]:
    """``LARGE_WRITES`` for the jobs started inside; the session's own settings are put back."""
    before = {key: spark.conf.get(key, None) for key in LARGE_WRITES}
    for key, value in LARGE_WRITES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def gbk_session(spark: SparkSession) -> SparkSession:
    """A sibling session on the same context that accepts Java charsets.

    GBK is outside the charsets Spark 4 allows by default. The two legacy switches
    live in the sibling only, so the caller's session keeps its settings.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if (key.startswith("spark.sql.") and session.conf.get(key, None) != value
                and session.conf.isModifiable(key)):
            session.conf.set(key, value)
    session.conf.set("spark.sql.legacy.javaCharsets", "true")
    session.conf.set("spark.sql.legacy.codingErrorAction", "true")
    return session
