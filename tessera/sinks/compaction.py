"""Merging the small files of a folder, in place (SNK-10).

Only files under ``small_bytes`` are read and rewritten; larger ones keep their names and
are not opened.  The small files of each partition folder are packed into bins of about
``target_bytes`` and every bin becomes one file.

A compaction has three steps: the merged files are staged in a hidden folder beside the
data (names that begin with ``_`` are no data for any reader), the list of the files they
replace is written there, and then the staged files move in and the listed ones go.  The
list is the point of no return: ``finish`` removes a stage without one and completes a stage
that has one, and may be run again after a crash at any place.  Between the first move and
the last removal a reader can see rows twice, so run it while nothing reads the folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STAGE = "_compacting-"
#: The mark of a stage whose lists are whole.
REPLACED = "_replaced"
_FOLDER, _BIN, _FILE = "_compact_folder", "_compact_bin", "_compact_file"


def small_file_bins(spark: SparkSession, path: str, small_bytes: int, target_bytes: int) -> DataFrame:
    """(file, folder, bin, bytes) of the files to merge, from a listing without contents.

    Files are packed in order of their names: a bin ends where the running size of its folder
    passes a multiple of ``target_bytes``, so a bin has less than ``target_bytes + small_bytes``.
    A file left over alone takes the last one of the bin before along, if that bin has more than
    two.  A file alone in its bin is left as it is.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_size").alias("bytes")))
    ordered = Window.partitionBy(_FOLDER).orderBy(_FILE)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes)
    follower = F.lead("place", 1).over(ordered)
    lone = (follower != F.col("place")) & F.lead("place", 2).over(ordered).isNull()
    packed = (files.filter(F.col("bytes") < small_bytes)
              .withColumn(_FOLDER, F.regexp_extract(_FILE, "^(.*)/[^/]*$", 1))
              .withColumn("place", place)
              .withColumns({"follower": F.when(lone, follower),
                            "files": F.count(F.lit(1)).over(Window.partitionBy(_FOLDER, "place"))})
              .withColumn("place", F.when(F.col("files") > 2, F.coalesce("follower", "place")).otherwise(F.col("place")))
              .withColumn(_BIN, F.sha1(F.concat(_FOLDER, F.lit(":"), F.col("place").cast("string"))))
              .drop("place", "follower", "files"))
    shared = F.count(F.lit(1)).over(Window.partitionBy(_FOLDER, _BIN)) > 1
    return packed.withColumn("shared", shared).filter("shared").drop("shared")


def merge_small_files(spark: SparkSession, path: str, small_bytes: int = 32 << 20,
                      target_bytes: int = 128 << 20, fmt: str = "parquet") -> int:
    """Merge the small files under ``path`` in place; returns how many were replaced.

    Partition folders stay as they are named (the null partition included), since rows are
    dealt by folder and not by parsed partition values.  Parquet and ORC files of different
    columns are merged to the union of their columns.
    """
    finish(spark, path)
    name = uuid.uuid4().hex[:12]
    stage = f"{path.rstrip('/')}/{STAGE}{name}"
    # written, so that what is merged and what is removed are the same list whatever runs again
    small_file_bins(spark, path, small_bytes, target_bytes).write.parquet(f"{stage}/bins")
    bins = spark.read.parquet(f"{stage}/bins")
    targets = {b: f for b, f in bins.select(_BIN, _FOLDER).distinct().collect()}  # one row a new file
    if not targets:
        return finish(spark, path)
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if fmt in ("parquet", "orc"):
        reader = reader.option("mergeSchema", "true")
    rows = reader.load(path)
    if {_BIN, _FILE} & set(rows.columns):
        raise ValueError(f"the data has a column named {_BIN} or {_FILE}")
    rows = (rows.select("*", F.col("_metadata.file_path").alias(_FILE))
            .filter(F.col("_metadata.file_size") < small_bytes)  # larger files are not opened
            .join(bins.select(_FILE, _BIN), _FILE).drop(_FILE))
    (rows.repartition(len(targets), _BIN).write.format(fmt).partitionBy(_BIN).save(f"{stage}/merged"))
    store, at = _store(spark, path)
    moves = []
    for file in _files(store, at(f"{stage}/merged")):
        folder = targets[file.getParent().getName().split("=", 1)[1]]
        moves.append((file.toUri().toString(), f"{folder}/{name}-{len(moves)}-{file.getName()}"))
    spark.createDataFrame(moves, "source string, target string").coalesce(1).write.parquet(f"{stage}/moves")
    store.create(at(f"{stage}/{REPLACED}"), True).close()
    return finish(spark, path)


def finish(spark: SparkSession, path: str) -> int:
    """Complete or clear what earlier compactions left; returns the number of files replaced."""
    store, at = _store(spark, path)
    if not store.exists(at(path)):
        return 0
    replaced = 0
    for status in store.listStatus(at(path)):
        stage = status.getPath()
        if not stage.getName().startswith(STAGE):
            continue
        if store.exists(at(f"{stage}/{REPLACED}")):
            # names of files only: as many as there were small files
            for source, target in spark.read.parquet(f"{stage}/moves").toLocalIterator():
                if store.exists(at(source, True)) and not store.rename(at(source, True), at(target, True)):
                    raise RuntimeError(f"{source} could not be moved to {target}")
            for file, in spark.read.parquet(f"{stage}/bins").select(_FILE).toLocalIterator():
                replaced += bool(store.delete(at(file, True), False))
        store.delete(stage, True)
    spark.catalog.refreshByPath(path)
    return replaced


def _store(spark: SparkSession, path: str):
    """The file system of a path, and how paths are made from text or from encoded URIs."""
    jvm = spark._jvm

    def at(text: str, uri: bool = False):
        return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(text) if uri else text)

    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def _files(store, folder) -> list:
    found, files = store.listFiles(folder, True), []
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            files.append(file)
    return files
