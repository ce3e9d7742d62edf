"""Streaming queries (STM-1..14) over files that Spark derives from the driver tables.

A table is replayed as a stream in event-time order: slice by slice its rows are written
as new files, in parallel, and the query is started again from its checkpoint, so each
slice is one micro-batch (or more) and earlier files are not read twice.  Each query
returns what its sink holds at the end; the oracle is the batch twin in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.queries.registry import query
from tessera.session import read_table, work_path
from tessera.streaming import late as LT
from tessera.streaming import streams as ST

#: Slices of a replay; how many files each has follows from the table's own partitions.
SLICES = 4


def replay(df: DataFrame, ts: str, transform: Callable[[DataFrame], DataFrame], mode: str,
           schema, fmt: str = "parquet", slices: int = SLICES, order=()) -> str:
    """Stream ``df`` through ``transform`` slice by slice; returns the sink's folder.  Complete
    mode is a report of windowed counts in ``order``."""
    spark = df.sparkSession
    source, out, state = (work_path(spark, f"replay_{part}") for part in ("source", "out", "state"))
    t = F.col(ts).cast("timestamp").cast("double")
    cuts = df.agg(F.percentile_approx(t, [i / slices for i in range(1, slices)], 10000).alias("c")).first()["c"]
    # number of cut points below the time: 0 for the first slice
    place = sum(((t > F.lit(c)).cast("int") for c in cuts or []), F.lit(0))
    for n in range(slices):
        slice_ = df.filter(F.coalesce(place, F.lit(0)) == n).write.mode("append").format(fmt)
        (slice_.option("compression", "lz4") if fmt == "json" else slice_).save(source)
        stream = spark.readStream.schema(schema).format(fmt).load(source)
        ST.run_to_end(ST.start_report(stream, transform, out, order, checkpoint=state) if mode == "complete"
                      else ST.start(transform(stream), out, mode, checkpoint=state))
    return out


def _events(spark, sf, transform, mode):
    e = read_table(spark, sf, "events")
    return replay(e, "ts", lambda s: transform(s.withColumn("event_time", ST.event_time("ts"))), mode, e.schema)


@query("stream_tumbling", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
       time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes' AS window_end,
       event_type, COUNT(*) AS count
FROM events GROUP BY 1, 2, 3""")
def stream_tumbling(spark, sf):
    """STM-2 / 5 / 6 / 8 / 10 / 11: file stream, 10-minute watermark, 5-minute tumbling
    windows per event type, update mode: a batch writes only the windows it changed."""
    out = _events(spark, sf, lambda s: ST.windowed_count(
        s, "event_time", "5 minutes", ["event_type"], delay="10 minutes"), "update")
    return ST.flatten_window(ST.latest_updates(spark, out, ["window", "event_type"])).select(
        "window_start", "window_end", "event_type", "count")


@query("stream_append_windows", """
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, COUNT(*) AS count
FROM events GROUP BY 1
HAVING time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes'
       <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")
def stream_append_windows(spark, sf):
    """STM-8 / STM-12 append mode: a window is written once the watermark passes its
    end, so windows still open when the input ends are not in the output."""
    out = _events(spark, sf, lambda s: ST.windowed_count(s, "event_time", "5 minutes", delay="10 minutes"), "append")
    return ST.flatten_window(spark.read.parquet(out)).select("window_start", "count")


def _posts(spark, sf):
    """Every document as a post; its time and author are derived from its id."""
    return read_table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("post_id"), "text",
        (F.col("doc_id") % 97).cast("string").alias("author_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id * 7)").alias("created_at"),
        "lang")


_POSTS_SQL = """posts AS (SELECT doc_id, text, lang, doc_id % 97 AS author,
  TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 7 SECOND AS created_at FROM documents)"""


@query("stream_word_window", f"""WITH {_POSTS_SQL}, w AS (
  SELECT created_at, unnest(regexp_split_to_array(lower(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')), '\\s+')) AS word
  FROM posts WHERE created_at IS NOT NULL)
SELECT time_bucket(INTERVAL '5 minutes', created_at) AS window_start,
       time_bucket(INTERVAL '5 minutes', created_at) + INTERVAL '5 minutes' AS window_end,
       word, COUNT(*) AS count
FROM w WHERE length(word) >= 4 GROUP BY 1, 2, 3 ORDER BY count DESC, word""")
def stream_word_window(spark, sf):
    """STM-2 / 4 / 6 / 9: JSON post files streamed slice by slice; tokens of ≥ 4
    characters counted per 5-minute window, complete mode (a sorted report needs it): every
    slice leaves the whole sorted report."""
    schema = StructType.fromDDL("post_id STRING, text STRING, author_id STRING, "
                                "created_at TIMESTAMP, lang STRING")
    out = replay(_posts(spark, sf), "created_at", lambda s: ST.windowed_tokens(s, "text", "created_at"),
                 "complete", schema, fmt="json", order=[F.desc("count"), F.col("word")])
    return ST.flatten_window(ST.last_report(spark, out)).select(
        "window_start", "window_end", "word", "count").orderBy(F.desc("count"), "word")


def _envelopes(spark, sf, transform, mode):
    """Posts as JSON messages in a ``value`` column, parsed on the stream."""
    sent = _posts(spark, sf).select("created_at", F.to_json(F.struct(F.struct(
        F.col("post_id").alias("id"), "text", "author_id",
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
        "lang").alias("data"))).alias("value"))
    return replay(sent, "created_at", lambda s: transform(ST.english_posts(ST.parse_envelope(s.select("value")))),
                  mode, "created_at TIMESTAMP_NTZ, value STRING")


@query("stream_envelope_counts", f"""WITH {_POSTS_SQL}
SELECT time_bucket(INTERVAL '5 minutes', created_at) AS window_start, COUNT(*) AS post_count
FROM posts WHERE lang = 'en' AND created_at IS NOT NULL GROUP BY 1""")
def stream_envelope_counts(spark, sf):
    """STM-3 / 7 / 8 / 14, JSN-1: JSON envelopes in a ``value`` column, parsed and
    flattened, English posts counted per 5-minute window in update mode."""
    out = _envelopes(spark, sf, lambda posts: ST.windowed_count(
        posts, "created_at", "5 minutes", delay="10 minutes", count_name="post_count"), "update")
    final = ST.latest_updates(spark, out, ["window"])
    return ST.flatten_window(final).select("window_start", "post_count")


@query("stream_batch_counts", """
SELECT conv_id % 4 AS part, word, COUNT(*) AS count FROM (
  SELECT conv_id, unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f]+')) AS word FROM conversations)
WHERE word <> '' GROUP BY 1, 2""")
def stream_batch_counts(spark, sf):
    """STM-13: words counted within each batch only; a slice (part) is a batch, so each part
    is counted by one batch, which would count it alike if it ran again."""
    c = read_table(spark, sf, "conversations").select((F.col("conv_id") % 4).alias("part"), "text")
    source, out, state = (work_path(spark, f"parts_{p}") for p in ("source", "out", "state"))
    for part in range(4):
        c.filter(F.col("part") == part).write.mode("append").parquet(source)
        s = spark.readStream.schema(c.schema).parquet(source)
        ST.run_to_end(ST.per_batch_word_count(s, "text", out, keys=["part"], checkpoint=state))
    return spark.read.parquet(out).select("part", "word", "count")


@query("stream_parity", """
SELECT CASE WHEN event_id % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS parity, COUNT(*) AS events
FROM events GROUP BY 1""")
def stream_parity(spark, sf):
    """STM-1: stateless EVEN / ODD tagging of a stream, append mode into files."""
    out = _events(spark, sf, lambda s: ST.tag_parity(s.select("event_id"), "event_id", "parity"), "append")
    return spark.read.parquet(out).groupBy("parity").agg(F.count(F.lit(1)).alias("events"))


@query("stream_triggered", """
SELECT CASE WHEN event_id % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS parity, COUNT(*) AS events
FROM events GROUP BY 1""")
def stream_triggered(spark, sf):
    """STM-10: a processing-time trigger; stopped when all files that are there are done."""
    e = read_table(spark, sf, "events")
    source, out = work_path(spark, "triggered_source"), work_path(spark, "triggered_out")
    e.select("event_id").write.parquet(source)
    stream = spark.readStream.schema("event_id BIGINT").parquet(source)
    q = ST.start(ST.tag_parity(stream, "event_id", "parity"), out, "append", trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(out).groupBy("parity").agg(F.count(F.lit(1)).alias("events"))


@query("stream_restarted", "SELECT event_id, 1 AS times FROM events")
def stream_restarted(spark, sf):
    """STM-11: four runs from one checkpoint; every event arrives once."""
    out = _events(spark, sf, lambda s: s.select("event_id"), "append")
    return spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query("stream_kafka_shape", f"""WITH {_POSTS_SQL}
SELECT CAST(doc_id AS VARCHAR) AS id, text, CAST(author AS VARCHAR) AS author_id,
       created_at, lang FROM posts WHERE lang = 'en' AND created_at IS NOT NULL""")
def stream_kafka_shape(spark, sf):
    """STM-3 / STM-14 / JSN-1: message values parsed and flattened on a stream, English
    posts with a valid time appended to files (the envelope transform works on any
    stream with a ``value`` column)."""
    out = _envelopes(spark, sf, lambda posts: posts, "append")
    return spark.read.parquet(out).withColumn(
        "created_at", F.col("created_at").cast("timestamp_ntz"))


@query("stream_late_rows", """
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) + 1 - min(epoch_us(ts)) AS span FROM events),
sent AS (SELECT ts, (4 * (epoch_us(ts) - lo)) // span + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS slice
  FROM events, b WHERE ts IS NOT NULL),
high AS (SELECT slice, max(ts) AS high FROM sent GROUP BY 1),
placed AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
  coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(high) FROM high h
    WHERE h.slice < sent.slice) - INTERVAL '10 minutes', false) AS is_late FROM sent)
SELECT window_start, COUNT(*) FILTER (NOT is_late) AS counted, COUNT(*) FILTER (is_late) AS late,
  CAST(0 AS BIGINT) AS dropped
FROM placed GROUP BY 1""")
def stream_late_rows(spark, sf):
    """STM-12: every 13th event is sent one slice late; rows whose hour has closed by then are
    kept apart, the others are counted by a windowed stream that drops none."""
    e = read_table(spark, sf, "events").filter("ts IS NOT NULL").select("event_id", ST.event_time("ts").alias("t"))
    us = F.unix_micros("t")
    ends = e.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    lo, span = ends["lo"] or 0, (ends["hi"] or 0) + 1 - (ends["lo"] or 0)
    place = F.expr(f"(4 * (unix_micros(t) - {lo})) div {span}") + (F.col("event_id") % 13 == 0).cast("int")
    source, path, out, s1, s2 = (work_path(spark, f"late_{p}") for p in ("source", "rows", "out", "s1", "s2"))
    dropped = 0
    for n in range(SLICES + 1):
        e.filter(place == n).write.mode("append").parquet(source)
        sent = spark.readStream.schema(e.schema).parquet(source)
        ST.run_to_end(LT.divide_late(sent, "t", "1 hour", "10 minutes", path, checkpoint=s1))
        counts = ST.windowed_count(LT.on_time(spark, path, e.schema), "t", "1 hour", delay="10 minutes")
        q = ST.start(counts, out, "update", checkpoint=s2)
        ST.run_to_end(q)
        dropped += LT.dropped_rows(q)
    late = LT.divided(spark, path, e.schema).filter(LT.LATE).groupBy(F.window("t", "1 hour")).agg(
        F.count(F.lit(1)).alias("late"))
    both = ST.latest_updates(spark, out, ["window"]).join(late, "window", "full")
    return ST.flatten_window(both).select(
        "window_start", F.coalesce("count", F.lit(0)).alias("counted"), F.coalesce("late", F.lit(0)).alias("late"),
        F.lit(dropped).cast("long").alias("dropped"))
