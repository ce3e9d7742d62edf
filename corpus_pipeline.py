"""The corpus pipeline: documents in, shard assignments of a cleaned and mixed corpus out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  Its
output is written as Parquet and read again as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``.  A stage on an empty table returns an empty
table; null texts are rejected by the first stage, which finds no language in them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, language, mixing, near_dup, q_mixing, q_sharding
from tessera.llm.common import cut
from tessera.session import read_table, work_path

#: Similarity in percent from which the pipeline takes documents as copies; op7's own is 85.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a clear language; the others keep their columns."""
    learned = language.learn_dictionaries(docs.where(~language.held_out()))
    found = language.identify(docs, learned, prefix="_lid_")
    return found.where(~F.col("_lid_rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one with the smallest id.

    Rows that repeat a kept id are copies of it and go too, unless they have no words.
    """
    found = near_dup.near_duplicates(docs, percent=NEAR_PERCENT)
    own = "_id"
    while own in docs.columns:
        own += "_"
    gone = found.where("id is not null and not kept").select(F.col("id").alias(own)).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col(own), "left_anti")
    repeated = repeated_ids(found.where("id is not null and kept and n_shingles > 0"), own)
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, F.col("doc_id") == F.col(own), "left_semi")
    once = kept.join(repeated, F.col("doc_id") == F.col(own), "left_anti")
    return once.unionByName(again.dropDuplicates(["doc_id"]))


def repeated_ids(rows: DataFrame, name: str) -> DataFrame:
    """Ids that occur more than once."""
    return cut(rows.groupBy(F.col("id").alias(name)).count().where("count > 1").select(name))


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: twice, once or not at all."""
    return mixing.repeat(docs, q_mixing.taken(spark, docs, sf_dir))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mixed corpus, with its source and text's crc32."""
    return q_sharding.assigned(docs, extra=("source", "lang"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", remove_benchmarks),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: SQL has no compression classifier and no seeded sampling; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
