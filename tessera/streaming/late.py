"""Late rows kept and counted (STM-12).

Spark drops rows that arrive after their window has closed and only counts them in the
progress of the query.  Here a stream is divided before any state is kept: rows of open
windows and rows that are too late (or have no time) are written apart, so ``in = counted +
late`` holds and nothing leaves without a trace.

The watermark of a batch is the greatest event time of all batches before it, less the
delay.  Each batch stores its own greatest time in a folder of its own, so a batch that runs
again after a failure meets the same watermark and divides its rows alike.  A folder that is
whole (``_SUCCESS``) is not written again, as a reader may have taken its files already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from tessera.session import work_path
from tessera.streaming.streams import _trigger

#: Partition column of the divided rows.
LATE = "is_late"
_ROWS, _HIGH = "rows", "high"


def _whole(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def watermark_before(spark: SparkSession, path: str, batch_id: int, delay: str) -> Column | None:
    """The watermark of a batch from the stored times of the batches before it; one small row
    a batch is read.  None before any row with a time has come."""
    if batch_id == 0:
        return None
    highs = spark.read.schema("high timestamp, batch_id long").parquet(f"{path}/{_HIGH}")
    seconds = highs.filter(F.col("batch_id") < batch_id).agg(
        F.unix_micros(F.max("high") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]
    return None if seconds is None else F.timestamp_micros(F.lit(seconds))


def flag_late(batch: DataFrame, ts: str, width: str, mark: Column | None) -> DataFrame:
    """``is_late``: the row has no time, or its window ended at or before the watermark."""
    timed = batch.filter(F.col(ts).isNotNull())
    if mark is None:
        flagged = timed.withColumn(LATE, F.lit(False))
    else:
        flagged = timed.withColumn(LATE, F.window(ts, width)["end"] <= mark)
    # F.window leaves out rows without a time, so they are flagged apart
    return flagged.unionByName(batch.filter(F.col(ts).isNull()).withColumn(LATE, F.lit(True)))


def divide_late(stream: DataFrame, ts: str, width: str, delay: str, path: str,
                trigger: str | None = "available", checkpoint: str | None = None) -> StreamingQuery:
    """Write each batch's rows under ``path``, divided by ``is_late``; read them back with
    ``divided`` (batch) or ``on_time`` (stream)."""
    checkpoint = checkpoint or work_path(stream.sparkSession, "late_ckpt")

    def divide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parts = {_ROWS: lambda: flag_late(batch, ts, width, watermark_before(spark, path, batch_id, delay)),
                 _HIGH: lambda: batch.agg(F.max(ts).alias("high"))}
        for name, rows in parts.items():
            target = f"{path}/{name}/batch_id={batch_id}"
            if not _whole(spark, target):
                w = rows().write.mode("overwrite")
                (w.partitionBy(LATE) if name == _ROWS else w).parquet(target)

    return _trigger(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(divide), trigger).start()


def _schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(LATE, BooleanType())])


def divided(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that came, with ``is_late`` and the batch."""
    rows = spark.read.schema(_schema(schema)).option("basePath", f"{path}/{_ROWS}").parquet(f"{path}/{_ROWS}")
    return rows.select(*[F.col(f"`{c}`") for c in schema.names], LATE, "batch_id")  # however the folders are nested


def on_time(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows in time as a stream; late folders are pruned.  A windowed count over it with
    the same width and delay drops nothing, as its watermark is never ahead of the one that
    divided the rows (as long as it takes whole batches, without ``maxFilesPerTrigger``)."""
    stream = spark.readStream.schema(_schema(schema)).parquet(f"{path}/{_ROWS}")
    return stream.filter(~F.col(LATE)).drop(LATE)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a run dropped behind the watermark."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
