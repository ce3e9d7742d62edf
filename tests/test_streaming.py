"""Streams: restart from a checkpoint skips processed files; per-batch counts keep no state."""

from pyspark.sql import functions as F

from tessera.session import read_table, work_path
from tessera.streaming import streams as ST

from table_helpers import SF_SMALL


def test_restart_reads_only_new_files(spark):
    e = read_table(spark, SF_SMALL, "events").select("event_id", "ts", "event_type")
    src = work_path(spark, "restart_src")
    e.filter(F.col("event_id") % 2 == 0).coalesce(1).write.parquet(src)
    out = work_path(spark, "restart_out")
    ckpt = work_path(spark, "restart_ckpt")
    s = spark.readStream.schema(e.schema).parquet(src)
    ST.run_to_end(ST.start(ST.tag_parity(s, "event_id", "parity"), out, "append", checkpoint=ckpt))
    first = spark.read.parquet(out).count()
    e.filter(F.col("event_id") % 2 == 1).coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema(e.schema).parquet(src)
    ST.run_to_end(ST.start(ST.tag_parity(s, "event_id", "parity"), out, "append", checkpoint=ckpt))
    total = spark.read.parquet(out)
    assert total.count() == e.count() and first < total.count()
    assert total.groupBy("event_id").count().filter("count > 1").count() == 0


def test_per_batch_counts_have_no_state(spark):
    src = work_path(spark, "pb_src")
    df = spark.createDataFrame([("a b a",), ("b c",)], "text string")
    df.limit(1).coalesce(1).write.parquet(src)
    out = work_path(spark, "pb_out")
    ckpt = work_path(spark, "pb_ckpt")
    s = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(src)
    ST.run_to_end(ST.per_batch_word_count(s, "text", out, checkpoint=ckpt))
    spark.createDataFrame([("a c",)], "text string").coalesce(1).write.mode("append").parquet(src)
    s = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(src)
    ST.run_to_end(ST.per_batch_word_count(s, "text", out, checkpoint=ckpt))
    got = {(r.batch_id, r.word): r["count"] for r in spark.read.parquet(out).collect()}
    assert got == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1, (1, "c"): 1}


def test_envelope_parse_is_tolerant(spark):
    df = spark.createDataFrame(
        [('{"data": {"id": "1", "text": "hi", "author_id": "u", "created_at": "2024-01-01T00:00:00", "lang": "en"}}',),
         ('{"data": {"id": "2", "text": "x", "author_id": "u", "created_at": "not a time", "lang": "en"}}',),
         ("not json",)], "value string")
    parsed = ST.parse_envelope(df)
    assert parsed.count() == 3
    assert ST.english_posts(parsed).count() == 1


def test_rate_source_parity_with_processing_time_trigger(spark):
    """STM-1 / STM-10: a rate stream tagged EVEN / ODD, processing-time trigger, append."""
    import time
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    out, ckpt = work_path(spark, "rate_out"), work_path(spark, "rate_ckpt")
    q = ST.start(ST.tag_parity(rate, "value", "event_type"), out, "append",
                 trigger="1 second", checkpoint=ckpt)
    try:
        time.sleep(6)          # an endless source: let a few 1-second batches commit
    finally:
        q.stop()
    got = spark.read.parquet(out)
    assert got.count() > 0
    wrong = got.filter(((F.col("value") % 2 == 0) & (F.col("event_type") != "EVEN"))
                       | ((F.col("value") % 2 == 1) & (F.col("event_type") != "ODD")))
    assert wrong.count() == 0


def test_a_batch_that_runs_again_writes_the_same(spark):
    """STM-13: after a failure a batch is replayed with its id; its output is replaced."""
    out = work_path(spark, "again")
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "word string, count long")
    ST.write_batch(batch, 0, out)
    ST.write_batch(batch.limit(1), 1, out)
    once = sorted(map(tuple, spark.read.parquet(out).collect()))
    ST.write_batch(batch.limit(1), 1, out)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == once and len(once) == 3
