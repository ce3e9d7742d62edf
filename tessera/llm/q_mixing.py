"""Registered query of the mixing operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import mixing
from tessera.llm.common import documents, word_count
from tessera.llm.registry import register
from tessera.session import read_table

#: Sampling weight of documents labelled good, labelled bad, and not labelled.
GOOD, BAD, PLAIN = 2.0, 0.5, 1.0


def with_quality(docs, labels):
    """Adds ``_quality`` from the labels; a document with several keeps the best."""
    best = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max("quality").alias("_label"))
    weight = F.when(F.col("_label") > 0, GOOD).when(F.col("_label") == 0, BAD).otherwise(PLAIN)
    return (docs.join(best, F.col("doc_id") == F.col("_id"), "left")
            .withColumn("_quality", weight).drop("_id", "_label"))


def taken(spark, docs, sf_dir):
    """The narrow mix of ``docs``: sizes are counted before anything is shuffled."""
    sized = docs.select("doc_id", "source", mixing.text_tie().alias("_tie"),
                        word_count(F.col("text")).alias("_size"))
    rated = with_quality(sized, read_table(spark, sf_dir, "labels"))
    return mixing.mix(rated, F.col("_size"), F.col("_quality"), F.col("_tie"))


@register("op2_mix_sources")
def op2_mix_sources(spark, sf_dir):
    mixed = taken(spark, documents(spark, sf_dir), sf_dir)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("times")).alias("taken"))
