"""Row changes on plain (non-transactional) tables, copy-on-write (MUT-1..8).

A change never overwrites the files it reads, and keeps the table's format, bucketing and
codec.  Unpartitioned tables: the new version is written beside the table's folder and the
catalog entry is pointed at it (``ALTER TABLE .. SET LOCATION``), a single metadata swap;
a failed job leaves the table as it was.  Partitioned tables: only the partitions that
rows leave or enter are read and rewritten.  They are staged in a table of the same layout,
then replaced with a dynamic partition overwrite; partitions that a change empties are
cleared one by one.  The stage is dropped when all is in place.

Partitions are told apart null-safely, so rows in the null partition change as well.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dedup import latest_per_key


def _cond(cond) -> Column:
    c = F.expr(cond) if isinstance(cond, str) else cond
    # NULL condition = row not touched (SQL semantics)
    return F.coalesce(c, F.lit(False))


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_layout(spark: SparkSession, table: str) -> dict:
    """Provider, location, codec, bucket count, bucket and sort columns of a table."""
    info = {r["col_name"].strip(): (r["data_type"] or "").strip()
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    columns = lambda text: re.findall(r"`((?:[^`]|``)+)`", text or "")
    codec = re.search(r"compression=([A-Za-z0-9_]+)", info.get("Storage Properties", ""))
    return {"provider": info.get("Provider", "parquet"), "location": info["Location"],
            "buckets": int(info.get("Num Buckets", 0) or 0),
            "bucket_columns": columns(info.get("Bucket Columns")),
            "sort_columns": columns(info.get("Sort Columns")),
            "codec": codec.group(1) if codec else None}


def _write_like(layout: dict, df: DataFrame, name: str, partitions: Sequence[str], path: str | None) -> None:
    """Save ``df`` as a table of the given layout; without a path the catalog owns the files."""
    w = df.write.format(layout["provider"])
    if layout["codec"]:
        w = w.option("compression", layout["codec"])
    if path:
        w = w.option("path", path)
    if partitions:
        w = w.partitionBy(*partitions)
    if layout["buckets"]:
        w = w.bucketBy(layout["buckets"], *layout["bucket_columns"])
        if layout["sort_columns"]:
            w = w.sortBy(*layout["sort_columns"])
    w.saveAsTable(name)


def _in_partitions(partitions: Sequence[str], values: Sequence[tuple]) -> Column:
    """Filter on literal partition values, so the scan reads only these partitions."""
    one = lambda row: reduce(
        Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partitions, row)])
    if len(partitions) == 1:
        known = [v for v, in values if v is not None]
        cond = F.col(partitions[0]).isin(known) if known else F.lit(False)
        if len(known) < len(values):
            cond = cond | F.col(partitions[0]).isNull()
        return F.coalesce(cond, F.lit(False))
    return reduce(Column.__or__, map(one, values), F.lit(False))


def _partition_values(df: DataFrame, partitions: Sequence[str]) -> set[tuple]:
    """Distinct partition values: at most one small row per partition of the table."""
    return {tuple(r) for r in df.select(*partitions).distinct().collect()}


def _swap(spark: SparkSession, table: str, new: DataFrame, touched: set[tuple] | None) -> None:
    """Make ``new`` the content of the table, or of its ``touched`` partitions."""
    names = spark.table(table).columns
    layout = table_layout(spark, table)
    stage = f"stage_{uuid.uuid4().hex[:12]}"
    if touched is None:
        path = f"{layout['location'].rstrip('/')}__{stage}"
        _write_like(layout, new.select(*names), stage, (), path)
        spark.sql(f"DROP TABLE {stage}")  # an external entry: the files stay
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    elif touched:
        partitions = partition_columns(spark, table)
        _write_like(layout, new.select(*names), stage, partitions, None)
        filled = _partition_values(spark.table(stage), partitions)
        if filled:
            _overwrite(spark, spark.table(stage).select(*names), table, "dynamic")
        _drop_partitions(spark, table, partitions, touched - filled)
        spark.sql(f"DROP TABLE {stage}")
    spark.catalog.refreshTable(table)


def _overwrite(spark: SparkSession, df: DataFrame, table: str, mode: str) -> None:
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def _drop_partitions(spark: SparkSession, table: str, partitions: Sequence[str],
                     rows: set[tuple]) -> None:
    """Take partitions out of the catalog in one statement, then remove their folders.

    No job runs, however many they are.  Readers stop seeing all of them with the one change;
    folders that a crash leaves behind belong to no partition.
    """
    if not rows:
        return

    def literal(value) -> str:
        if value is None:
            return "null"
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    def listed() -> set[str]:
        # as folders: names and values are escaped the same way
        return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    specs = ", ".join("PARTITION (" + ", ".join(f"`{c}` = {literal(v)}" for c, v in zip(partitions, row)) + ")"
                      for row in sorted(rows, key=repr))
    before = listed()
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    root = spark._jvm.org.apache.hadoop.fs.Path(table_layout(spark, table)["location"])
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for gone in before - listed():
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(root, gone), True)


def update_where(spark: SparkSession, table: str, cond, assignments: dict[str, Column | str]) -> None:
    """MUT-2: ``UPDATE table SET c = expr WHERE cond``; results are cast back to the column type
    (e.g. ``DECIMAL(12,2) * 1.10`` returns to ``DECIMAL(12,2)``).  Assigning a partition
    column moves the rows."""
    df = spark.table(table)
    c = _cond(cond)

    def changed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({
            name: F.when(c, (F.expr(e) if isinstance(e, str) else e).cast(df.schema[name].dataType))
                   .otherwise(F.col(name))
            for name, e in assignments.items()})

    partitions = partition_columns(spark, table)
    if not partitions:
        return _swap(spark, table, changed(df), None)
    hit = df.filter(c)
    touched = _partition_values(hit, partitions)
    if set(partitions) & set(assignments):
        touched |= _partition_values(changed(hit), partitions)
    _swap(spark, table, changed(df.filter(_in_partitions(partitions, sorted(touched, key=repr)))), touched)


def delete_where(spark: SparkSession, table: str, cond) -> None:
    """MUT-3: ``DELETE FROM table WHERE cond`` (rows where cond is NULL stay)."""
    df = spark.table(table)
    c = _cond(cond)
    partitions = partition_columns(spark, table)
    if not partitions:
        return _swap(spark, table, df.filter(~c), None)
    touched = _partition_values(df.filter(c), partitions)
    rows = df.filter(_in_partitions(partitions, sorted(touched, key=repr)))
    _swap(spark, table, rows.filter(~c), touched)


def upsert(spark: SparkSession, table: str, changes: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = None) -> None:
    """MUT-5: MERGE: rows of ``changes`` replace rows with the same key, new keys are
    inserted.  Keys are compared null-safely.  Several changes for one key: the greatest
    ``order`` wins; without ``order`` they are an error."""
    df = spark.table(table)
    keys = list(keys)
    ch = changes.select(*df.columns)
    if order:
        ch = latest_per_key(ch, keys, list(order))
    elif not ch.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"several changes for one key of {table}; pass an order to choose")
    wanted = ch.select(*[F.col(k).alias(f"_m_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
    partitions = partition_columns(spark, table)
    if not partitions:
        return _swap(spark, table, df.join(wanted, same, "left_anti").unionByName(ch), None)
    touched = (_partition_values(df.join(wanted, same, "left_semi"), partitions)
               | _partition_values(ch, partitions))
    rows = df.filter(_in_partitions(partitions, sorted(touched, key=repr)))
    _swap(spark, table, rows.join(wanted, same, "left_anti").unionByName(ch), touched)


def insert_rows(df: DataFrame, table: str) -> None:
    """MUT-1: ``INSERT INTO`` (append, by position after ordering like the table)."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table)


def truncate(spark: SparkSession, table: str) -> None:
    """MUT-4: ``TRUNCATE TABLE``, also over external folders (refused by the SQL command).
    A partitioned table is emptied by one static overwrite, which drops all partitions."""
    df = spark.createDataFrame([], spark.table(table).schema)
    if partition_columns(spark, table):
        _overwrite(spark, df, table, "static")
        spark.catalog.refreshTable(table)
        return
    _swap(spark, table, df, None)


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> DataFrame:
    """MUT-8: table statistics and, with ``columns``, column statistics; returns one
    row per column with the collected values (min, max, null count, distinct count)."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if not columns:
        return spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    frames = []
    for c in columns:
        d = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {c}")
        pivot = d.groupBy().pivot("info_name", ["min", "max", "num_nulls", "distinct_count"]) \
                 .agg(F.first("info_value"))
        frames.append(pivot.withColumn("column", F.lit(c)))
    return reduce(DataFrame.unionByName, frames).select("column", "min", "max", "num_nulls", "distinct_count")
