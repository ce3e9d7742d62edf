"""Writing layers and laying tables out (SNK-1..14).

Outputs go under the shared folder named by ``spark.checkpoint.dir`` (see
``tessera.session.work_path``) unless the caller passes a path; nothing is
written to a machine-local temporary folder.  Files are written by the
executors; nothing passes through the driver.
"""

from __future__ import annotations

import re
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.session import work_path


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), codec: str | None = None,
                header: bool = True, options: dict | None = None) -> str:
    """SNK-1/2/4/5/6/7/9/11: one writer for every layer.

    ``mode="errorifexists"`` refuses an existing directory (the MapReduce output rule).
    CSV is written with a header by default.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if codec:
        w = w.option("compression", codec)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_counted(df: DataFrame, path: str, metrics: dict[str, Column] | None = None, **how) -> dict[str, int]:
    """SNK-1: ``write_layer`` that counts while it writes: no second scan of ``df`` or the layer.

    Returns ``records`` and the given aggregates over the written rows.  The counts are
    taken directly below the write, in the tasks whose output is committed, and a task's count
    is added once however often it runs.  An empty layer counts 0.
    """
    seen = Observation()
    write_layer(df.observe(seen, F.count(F.lit(1)).alias("records"),
                           *[c.alias(n) for n, c in (metrics or {}).items()]), path, **how)
    return seen.get


def remove_layers(spark: SparkSession, base_path: str) -> None:
    """Removes the folder of layers that nothing reads any more."""
    base = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    base.getFileSystem(spark._jsc.hadoopConfiguration()).delete(base, True)


def write_reports(reports: dict[str, DataFrame], base_path: str, fmt: str = "parquet",
                  audit_column: str = "_gold_processed_timestamp") -> dict[str, str]:
    """SNK-3: write each named report with an audit timestamp column."""
    out = {}
    for name, df in reports.items():
        path = f"{base_path.rstrip('/')}/{name}"
        write_layer(df.withColumn(audit_column, F.current_timestamp()), path, fmt)
        out[name] = path
    return out


def _table_name(prefix: str) -> str:
    return f"{re.sub(r'[^A-Za-z0-9_]', '_', prefix)}_{uuid.uuid4().hex[:10]}"


def save_table(spark: SparkSession, df: DataFrame, prefix: str, fmt: str = "parquet") -> str:
    """A plain catalog table under a fresh name; returns the name."""
    name = _table_name(prefix)
    df.write.format(fmt).option("path", work_path(spark, name)).saveAsTable(name)
    return name


def save_bucketed(spark: SparkSession, df: DataFrame, prefix: str, keys: Sequence[str],
                  buckets: int, sort: bool = True, partition_by: Sequence[str] = (),
                  fmt: str = "parquet", path: str | None = None) -> str:
    """SNK-8: a bucketed (and sorted) table; returns its catalog name.

    Two tables bucketed the same way on the join key join without an exchange.
    """
    name = _table_name(prefix)
    path = path or work_path(spark, name)
    w = df.write.format(fmt).option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


def save_partitioned_table(spark: SparkSession, df: DataFrame, prefix: str,
                           partition_by: Sequence[str], fmt: str = "parquet",
                           path: str | None = None) -> str:
    """SNK-7: a partitioned catalog table (``SHOW PARTITIONS`` works on it)."""
    name = _table_name(prefix)
    path = path or work_path(spark, name)
    df.write.format(fmt).option("path", path).partitionBy(*partition_by).saveAsTable(name)
    return name


def insert_partitions(df: DataFrame, table: str) -> None:
    """SNK-7 / SNK-12: replace only the partitions present in ``df`` (dynamic overwrite)."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def compact(spark: SparkSession, path: str, target_files: int | None = None, fmt: str = "parquet",
            out_path: str | None = None, partition_by: Sequence[str] = (),
            target_bytes: int = 128 << 20) -> str:
    """SNK-10: rewrite a folder of small files into files of about ``target_bytes``.

    The number of files follows from the folder's size unless ``target_files`` is given.
    Written to a new folder (never over the folder being read); the caller swaps paths.
    With ``partition_by`` the rows are clustered by partition, and REBALANCE splits large
    partitions and joins small ones.
    """
    df = spark.read.format(fmt).load(path)
    out_path = out_path or work_path(spark, "compacted")
    files = target_files or max(1, -(-(file_sizes(spark, path).first()["bytes"] or 0) // target_bytes))
    df = df.hint("rebalance", files, *partition_by) if partition_by else df.coalesce(files)
    write_layer(df, out_path, fmt, partition_by=partition_by)
    return out_path


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """SNK-9: bytes and file count of a folder, computed by a ``binaryFile`` scan
    that reads only file metadata (the content column is not selected)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .filter(~F.col("path").rlike(r"/(_|\.)[^/]*$")))
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def refresh_summary(spark: SparkSession, summary: DataFrame, path: str,
                    partition_by: Sequence[str]) -> str:
    """SNK-14: a summary table in place of a materialised view; re-running it
    replaces only the partitions present in ``summary`` (dynamic overwrite)."""
    (summary.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return path
