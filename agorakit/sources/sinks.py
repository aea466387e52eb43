"""Sinks: full refresh, upsert, run log, CSV exports, checks before a run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorakit.sources.published import BUCKETS, KeyedTable, publish, read_published

RUN_LOG_SCHEMA = (
    "extraction_type string, nodes_extracted bigint, relationships_extracted bigint, started_at timestamp, "
    "completed_at timestamp, status string, error_message string"
)


def write_full(
    df: DataFrame, path: str, *, keep_old_if_empty: bool = True, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> int:
    """Replace the table at ``path`` and return the rows written. Empty input leaves old data unless told otherwise.

    Readers use ``read_full``: the new version is current once its pointer is written, and the one before stays whole until then.
    """
    return publish(df, path, keep_old_if_empty=keep_old_if_empty, partition_by=partition_by, fmt=fmt)


def read_full(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The current version of a table that ``write_full`` or ``refresh`` wrote."""
    return read_published(spark, path, schema)


def latest_per_key(incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """The last row of each key by ``order``, combined on the map side."""
    if order is None:
        return incoming.dropDuplicates(list(keys))
    rest = [c for c in incoming.columns if c not in keys]
    last = incoming.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in incoming.columns])


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """``current`` with every row whose key arrives replaced and new keys added.

    Rows made of keys only change nothing. Rows deleted at the source stay; ``prune`` removes them.
    """
    fresh = latest_per_key(incoming, keys, order)
    return fresh.unionByName(current.join(fresh.select(*keys), list(keys), "left_anti"))


def upsert_table(path: str, current: DataFrame, incoming: DataFrame, keys: Sequence[str], order: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Load ``current`` into a new keyed table, merge ``incoming`` into it, and return the table. Later loads merge into their buckets only."""
    table = KeyedTable(path, keys, current.schema, order, buckets)
    table.merge(current, 0)
    table.merge(incoming, 1)
    return table.read(current.sparkSession)


def prune(current: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key no longer exists at the source."""
    return current.join(source_keys.select(*keys).distinct(), list(keys), "left_semi")


def log_run(
    spark: SparkSession, path: str, *, kind: str, nodes: int, relationships: int, started: datetime, completed: datetime,
    status: str, error: str | None = None,
) -> None:
    """Append one row to the run log."""
    row = (kind, nodes, relationships, started, completed, status, error)
    spark.createDataFrame([row], RUN_LOG_SCHEMA).write.mode("append").parquet(path)


def refresh(build: Callable[[], DataFrame], path: str) -> int:
    """Recompute a derived table, replace the stored copy and return its row count."""
    return write_full(build(), path, keep_old_if_empty=False)


def missing_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Names that are neither tables nor views of the session, in the given order."""
    return [name for name in names if not spark.catalog.tableExists(name)]


def export_csv(frame: DataFrame, folder: str, name: str, as_of) -> str:
    """Write a frame as CSV with a header under a date-stamped name and return the path."""
    stamp = str(as_of)[:10].replace("-", "")
    path = f"{folder.rstrip('/')}/{name}_{stamp}.csv"
    frame.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_activation(training: DataFrame, as_of, folder: str) -> str:
    from agorakit.operators.segments import activation_export_frame

    return export_csv(activation_export_frame(training, as_of), folder, "activation_training_data", as_of)


def export_engagement(training: DataFrame, as_of, folder: str) -> str:
    from agorakit.operators.segments import engagement_export_frame

    return export_csv(engagement_export_frame(training, as_of), folder, "engagement_training_data", as_of)
