"""Sharding by jump consistent hashing (Lamping and Veach, 2014): a stable key goes to a shard without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorakit.llm.common import dense_rank_in, fresh, text_of

#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
#: Parts in which the rows of a shard are numbered.
BUCKETS = 1024


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key. A key's jumps are the shard counts at which it would move; the last below `shards` holds."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = keys.astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    goes = np.zeros(len(state), np.int64)
    with np.errstate(over="ignore"):
        while len(live):
            at[live] = goes[live]
            state[live] = state[live] * np.uint64(MULTIPLIER) + np.uint64(1)
            draw = ((state[live] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            goes[live] = ((at[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            live = live[goes[live] < shards]
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a bigint column; null keys count as 0."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return place(F.coalesce(key, F.lit(0).cast("bigint")))


def shard(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Adds shard, grown_shard (with one shard more) and slot (gapless from 0 in each shard).

    The key's value and the shard count alone decide the shard; keys are mixed by XXH64 first. With one shard more a row
    keeps its shard or goes to the new one. Null keys are one key. Rows with equal keys share a shard; their slots are
    dealt by all columns, so that a key with a third of all rows is numbered by many tasks. Equal rows get
    different slots. Columns of these names in df are replaced. An empty table stays empty.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "grown_shard", "slot")]
    (mixed,) = fresh(df, "_mixed")
    hashed = df.withColumn(mixed, F.xxhash64(F.col(key)))
    placed = hashed.select(*kept, shard_of(F.col(mixed), shards).alias("shard"), shard_of(F.col(mixed), shards + 1).alias("grown_shard"))
    bucket = F.pmod(F.xxhash64(*kept), F.lit(BUCKETS)).cast("int")
    return dense_rank_in(placed, ["shard"], bucket, [F.col(c) for c in [key, *[c for c in kept if c != key]]], "slot")


def query(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: size in bytes plus 1, checksum, and place by doc_id under the law `key`."""
    text = text_of()
    narrow = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    return shard(narrow, "doc_id", shards).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
