"""Sharding by jump consistent hash.

A row's shard depends on its key and the number of shards only.  When shards are appended,
a row either stays or moves into one of the new shards, and just the necessary fraction
moves.  No ring table exists; the assignment is one expression per row and needs no shuffle.

Slots number the rows of a shard from 0 without gaps.  Rows are counted per (shard,
bucket) first; the buckets' sums give each its first slot, and only rows of one bucket are
ordered together, so a shard's rows are never in one task.

Null keys hash to a value of their own and share one shard; equal keys share a shard.
Null and empty texts have size 1.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut

#: Rows ordered together when slots are given.
BUCKET_ROWS = 100_000
#: Least buckets of a shard, so small tables are spread too.
MIN_BUCKETS = 32
#: Constants of the published jump consistent hash.
_STEP, _SHIFT, _SPAN = 2862933555777941757, 33, float(1 << 31)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each uint64 key; all keys jump together until each has passed the end."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = keys.astype(np.uint64)
    shard = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = ahead[live]
        key[live] = key[live] * np.uint64(_STEP) + np.uint64(1)
        reach = _SPAN / ((key[live] >> np.uint64(_SHIFT)).astype(np.float64) + 1.0)
        ahead[live] = ((shard[live] + 1) * reach).astype(np.int64)
        live = live[ahead[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard column for a key column of any type that casts to text."""

    @F.pandas_udf("int")
    def assign(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(np.int64).view(np.uint64), shards), dtype="int32")

    return assign(F.xxhash64(F.lit(29), key.cast("string")))


def slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``: gapless from 0 within each shard, in an order fixed by ``order``."""
    rows = cut(rows)
    counts = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-largest // BUCKET_ROWS))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(31), *order), F.lit(buckets)))
    # one row per shard and bucket: as many as the table has blocks of BUCKET_ROWS
    sums = rows.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    base = sums.select(F.col(shard).alias("_shard"), F.col("_bucket").alias("_b"),
                       (F.sum("_n").over(Window.partitionBy(shard).orderBy("_bucket"))
                        - F.col("_n")).alias("_base"))
    place = F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy(*order)) - 1
    return (rows.withColumn("_place", place)
            .join(base, (F.col(shard) == F.col("_shard")) & (F.col("_bucket") == F.col("_b")))
            .withColumn("slot", (F.col("_base") + F.col("_place")).cast("long"))
            .drop("_bucket", "_place", "_shard", "_b", "_base"))
