"""Registered query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import sharding
from tessera.llm.common import documents
from tessera.llm.registry import register

SHARDS = 16


def assigned(docs, extra=()):
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; texts stay put."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.lit("key").alias("law"),
        sharding.shard_of(F.col("doc_id"), SHARDS).alias("shard"),
        sharding.shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"), *extra)
    return sharding.slots(narrow, "shard", ["doc_id", "text_crc32", "size"])


@register("op3_shard")
def op3_shard(spark, sf_dir):
    return assigned(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
