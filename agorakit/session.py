"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Removes the shuffle files of a query when it ends; else they stay until the driver collects its garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _WRITING = threading.Lock(), {}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster the submitted configuration is used instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("agorakit")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names. A local session without one gets a fresh folder; a cluster must name one."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="agorakit-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
        named = context.getCheckpointDir()
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for one written table under the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files. The setting is the session's, so the last of several at once puts it back."""
    with _LOCK:
        if not _WRITING:
            _WRITING["before"] = spark.conf.get(CLEANUP_KEY, None)
            spark.conf.set(CLEANUP_KEY, "true")
        _WRITING["writes"] = _WRITING.get("writes", 0) + 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITING["writes"] -= 1
            if not _WRITING["writes"]:
                before = _WRITING["before"]
                _WRITING.clear()
                if before is None:
                    spark.conf.unset(CLEANUP_KEY)
                else:
                    spark.conf.set(CLEANUP_KEY, before)


def cut(df: DataFrame, label: str = "stored") -> DataFrame:
    """Write a frame as Parquet to the shared scratch folder and return the stored table.

    For frames that a plan reads several times: later scans prune columns and push filters, plans stay small, and a
    lost executor costs a rescan, not a recomputation. What the write shuffled goes when it is done, as only the table is read again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _cleaned_up(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
