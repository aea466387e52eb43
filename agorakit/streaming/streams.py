"""Structured Streaming variants: daily activity counts and streaming upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agorakit.sources.schemas import fixture_schema
from agorakit.sources.published import DayLog, KeyedTable


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """The events table as a stream of files with a declared schema."""
    return (
        spark.readStream.schema(fixture_schema("events"))
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", "events*.parquet")
        .parquet(folder)
    )


def stream_daily_activity(stream: DataFrame) -> DataFrame:
    """Events per day and type. State is one row per day and type, whatever the number of events.

    There is no watermark: files of a history come in the order of their times, not of their events, and no event may be lost for it.
    """
    return stream.groupBy(F.to_date("ts").alias("metric_date"), "event_type").agg(F.count(F.lit(1)).alias("events"))


def stream_daily_users(stream: DataFrame, path: str, *, checkpoint: str) -> DataFrame:
    """Exact distinct users per day over all available input, open days and late rows included.

    One row per (user, day) is kept in the shared folder. A batch reads the stored rows of its own days only, whatever the order of files, and
    a run without new input gives the same result.
    """
    pairs = stream.select("user_id", F.to_date("ts").alias("metric_date"))
    log = DayLog(path, pairs.schema, "metric_date")
    _run(pairs, log.merge, checkpoint, "append")
    return log.read(stream.sparkSession).groupBy("metric_date").agg(F.count("user_id").alias("dau"))


def _run(stream: DataFrame, merge, checkpoint: str, mode: str) -> StreamingQuery:
    """Process what is available now."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()
    )
    query.awaitTermination()
    return query


def run_to_table(
    stream: DataFrame, path: str, keys: Sequence[str], *, checkpoint: str, order: str | None = None, mode: str = "append"
) -> DataFrame:
    """Merge a stream's available input into a keyed table and return its last whole version, also if nothing came in.

    Each batch rewrites the buckets of its own keys.
    """
    table = KeyedTable(path, keys, stream.schema, order)
    _run(stream, table.merge, checkpoint, mode)
    return table.read(stream.sparkSession)
