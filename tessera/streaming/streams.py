"""Structured Streaming operators (STM-1..14).

Event-time work uses watermarks; results leave through file sinks written by
the executors (``append``) or through ``foreachBatch`` (``complete`` /
``update``), never through the driver-side memory sink.  Sorted reports whose counts outgrow
the executors' memory go through ``start_report``.  Checkpoints live under
the shared checkpoint folder, so a restarted query skips files it already
processed.  ``trigger="available"`` processes everything present and stops
(tests and batch-like runs); a processing-time trigger such as ``"5 seconds"``
runs continuously.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from tessera.operators.dedup import latest_per_key
from tessera.operators.wordcount import WORD_DELIMITERS, stream_tokens
from tessera.session import tuned, work_path

# The message envelope of the social-post feed.
POST_SCHEMA = StructType([
    StructField("id", StringType()), StructField("text", StringType()),
    StructField("author_id", StringType()), StructField("created_at", StringType()),
    StructField("lang", StringType())])
ENVELOPE_SCHEMA = StructType([StructField("data", POST_SCHEMA)])


def event_time(c) -> Column:
    """Watermarks need TIMESTAMP (with zone); wall-clock TIMESTAMP_NTZ is cast."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp")


def tag_parity(df: DataFrame, c: str = "value", name: str = "event_type") -> DataFrame:
    """STM-1: EVEN / ODD tag of an integer column (stateless)."""
    return df.withColumn(name, F.when(F.col(c) % 2 == 0, F.lit("EVEN")).otherwise(F.lit("ODD")))


def windowed_count(df: DataFrame, ts: str, width: str, keys: Sequence[str] = (),
                   delay: str | None = None, count_name: str = "count") -> DataFrame:
    """STM-6 / STM-7: tumbling event-time window (× keys) count."""
    if delay:
        df = df.withWatermark(ts, delay)
    return df.groupBy(F.window(ts, width), *keys).agg(F.count(F.lit(1)).alias(count_name))


def windowed_tokens(df: DataFrame, text: str, ts: str, width: str = "5 minutes", min_len: int = 4,
                    delay: str | None = "10 minutes") -> DataFrame:
    """STM-4 / 5 / 6: tokens of at least ``min_len`` characters counted per tumbling window.
    Rows without a time cannot belong to a window and are left out."""
    timed = df.filter(F.col(ts).isNotNull()).select(ts, stream_tokens(text).alias("_words"))
    if delay:
        timed = timed.withWatermark(ts, delay)
    # explode_outer: for explode Spark infers a filter on the array, which splits every text twice
    words = timed.select(ts, F.explode_outer("_words").alias("word")).filter(F.length("word") >= min_len)
    return windowed_count(words, ts, width, ["word"])


def flatten_window(df: DataFrame, ntz: bool = True) -> DataFrame:
    """``window`` struct → ``window_start`` / ``window_end`` columns (back to NTZ)."""
    t = TimestampNTZType() if ntz else None
    start, end = F.col("window.start"), F.col("window.end")
    if t is not None:
        start, end = start.cast(t), end.cast(t)
    return df.withColumns({"window_start": start, "window_end": end}).drop("window")


def parse_envelope(df: DataFrame, schema: StructType = ENVELOPE_SCHEMA, inner: str = "data") -> DataFrame:
    """STM-3 / JSN-1: ``value`` bytes or text → JSON struct → flattened fields;
    ``created_at`` parsed tolerantly (null when unparsable, never an error)."""
    parsed = df.select(F.from_json(F.col("value").cast("string"), schema).alias("json"))
    flat = parsed.select(f"json.{inner}.*")
    if "created_at" in flat.columns:
        flat = flat.withColumn("created_at", F.try_to_timestamp("created_at"))
    return flat


def english_posts(posts: DataFrame, lang: str = "en") -> DataFrame:
    """STM-14: one language, with a valid time."""
    return posts.filter((F.col("lang") == lang) & F.col("created_at").isNotNull())


def _trigger(writer, trigger: str | None):
    if trigger in (None, "available"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start(df: DataFrame, sink_path: str, mode: str = "append", trigger: str | None = "available",
          checkpoint: str | None = None, fmt: str = "parquet",
          name: str | None = None) -> StreamingQuery:
    """STM-8 / STM-10 / STM-11: start a query into files.

    ``append``: the file sink (exactly-once through its log).  ``complete``:
    every batch replaces the output with the full result; for small reports.
    ``update``: every batch writes its changed rows to its own ``batch_id=``
    folder, so a batch that is run again after a failure replaces what it wrote;
    read them back with ``latest_updates``.
    """
    spark = df.sparkSession
    checkpoint = checkpoint or work_path(spark, "stream_ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if mode == "append":
        w = w.format(fmt).option("path", sink_path)
    elif mode == "complete":
        def replace(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").format(fmt).save(sink_path)
        w = w.foreachBatch(replace)
    elif mode == "update":
        def add(batch: DataFrame, batch_id: int) -> None:
            write_batch(batch, batch_id, sink_path, fmt)
        w = w.foreachBatch(add)
    else:
        raise ValueError(f"unknown output mode {mode}")
    return _trigger(w, trigger).start()


#: For plans that run once: their shuffle files go when they end, not when the driver collects garbage.
_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def start_report(stream: DataFrame, count: Callable[[DataFrame], DataFrame], sink_path: str,
                 order: Sequence[Column | str], measure: str = "count", trigger: str | None = "available",
                 checkpoint: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """STM-9: complete mode for a sorted report of windowed counts of any size.

    ``count`` gives a ``window``, further keys and the additive ``measure`` of a micro-batch.
    Every batch leaves the full result of all batches so far, in ``order``, in its own
    ``batch_id=`` folder (``last_report`` reads it).  The report of the batch before is the
    state: files, where the engine would hold a row in memory for every key.  As in complete
    mode nothing is evicted and late rows are counted.  Only windows within the batch's span
    are added up again; the others pass on.  A batch that runs again reads the same report
    and replaces what it wrote; a report goes when the one after it is committed.
    """
    spark, sink = tuned(stream.sparkSession, _ONCE), sink_path.rstrip("/")
    checkpoint = checkpoint or work_path(spark, "stream_ckpt")

    def add(batch: DataFrame, batch_id: int) -> None:
        _drop_reports(spark, sink, lambda n: n > batch_id or n < batch_id - 1)
        for k, v in _ONCE.items():
            batch.sparkSession.conf.set(k, v)
        counts = f"{sink}/_counts"
        # written once: the sort below samples its input before it reads it
        count(batch).write.mode("overwrite").parquet(counts)
        result = spark.read.parquet(counts)
        if batch_id:
            keys = [c for c in result.columns if c != measure]
            start = F.unix_micros("window.start")
            span = result.agg(F.min(start).alias("lo"), F.max(start).alias("hi")).first()
            before = spark.read.format(fmt).schema(result.schema).load(f"{sink}/batch_id={batch_id - 1}")
            same = F.lit(False) if span["lo"] is None else start.between(span["lo"], span["hi"])
            added = before.filter(same).unionByName(result).groupBy(*keys).agg(F.sum(measure).alias(measure))
            result = before.filter(~same).unionByName(added)
        write_batch(result.orderBy(*order), batch_id, sink, fmt)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add)
    return _trigger(w, trigger).start()


def _reports(spark: SparkSession, sink_path: str) -> dict[int, object]:
    """The ``batch_id=`` folders of a sink by their number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(sink_path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    paths = [s.getPath() for s in store.listStatus(root)] if store.exists(root) else []
    return {int(p.getName().partition("=")[2]): p for p in paths if p.getName().startswith("batch_id=")}


def _drop_reports(spark: SparkSession, sink_path: str, which: Callable[[int], bool]) -> None:
    for n, path in _reports(spark, sink_path).items():
        if which(n):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def last_report(spark: SparkSession, sink_path: str, fmt: str = "parquet") -> DataFrame:
    """The full result that the last batch of ``start_report`` left."""
    return spark.read.format(fmt).load(_reports(spark, sink_path)[max(_reports(spark, sink_path))].toString())


def write_batch(batch: DataFrame, batch_id: int, sink_path: str, fmt: str = "parquet") -> None:
    """Write a micro-batch to its own folder; running it again gives the same folder."""
    batch.write.mode("overwrite").format(fmt).save(f"{sink_path.rstrip('/')}/batch_id={batch_id}")


def run_to_end(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish and surface its error, if any.  With a
    timeout the query is stopped and an error raised when it takes longer."""
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Final state from an update-mode output: the last batch's row per key."""
    return latest_per_key(spark.read.format(fmt).load(path), list(keys), ["batch_id"]).drop("batch_id")


def per_batch_word_count(stream: DataFrame, text: str, sink_path: str, keys: Sequence[str] = (),
                         lower: bool = True, trigger: str | None = "available",
                         checkpoint: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """STM-13: words counted within each micro-batch only (no state across batches),
    each batch's counts in a folder of its own (``batch_id=``)."""
    spark = stream.sparkSession
    checkpoint = checkpoint or work_path(spark, "batch_wc_ckpt")

    def count_batch(batch: DataFrame, batch_id: int) -> None:
        col = F.lower(F.col(text)) if lower else F.col(text)
        counted = (batch.select(*keys, F.explode(F.split(col, WORD_DELIMITERS)).alias("word"))
                   .filter(F.col("word") != "")
                   .groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("count")))
        write_batch(counted, batch_id, sink_path, fmt)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(count_batch)
    return _trigger(w, trigger).start()
