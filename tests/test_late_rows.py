"""Late rows: divided by the watermark of the batches before, also when a batch runs again."""

from pyspark.sql import functions as F

from tessera.session import work_path
from tessera.streaming import late as LT
from tessera.streaming import streams as ST

SCHEMA = "id int, t timestamp"


def _batch(spark, rows):
    return spark.createDataFrame(rows, "id int, s string").select("id", F.col("s").cast("timestamp").alias("t"))


BATCHES = [
    [(1, "2024-01-01 10:05:00"), (2, None)],
    # watermark 09:55: only the window that ended by then is closed
    [(3, "2024-01-01 08:59:59"), (4, "2024-01-01 09:54:00"), (5, "2024-01-01 12:10:00"), (6, "2024-01-01 12:10:00")],
    # watermark 12:00: the window that ends with it is closed, the one that begins is open
    [(7, "2024-01-01 11:59:59"), (8, "2024-01-01 12:00:00"), (9, None)]]
LATE = {2, 3, 7, 9}


def _run(spark, src, path, ckpt):
    s = spark.readStream.schema(SCHEMA).parquet(src)
    ST.run_to_end(LT.divide_late(s, "t", "1 hour", "10 minutes", path, checkpoint=ckpt))


def test_rows_are_divided_and_none_is_lost(spark):
    src, path, ckpt = (work_path(spark, f"lt_{n}") for n in ("src", "path", "ckpt"))
    for rows in BATCHES:
        _batch(spark, rows).coalesce(1).write.mode("append").parquet(src)
        _run(spark, src, path, ckpt)
    schema = spark.read.parquet(src).schema
    got = {r["id"]: r[LT.LATE] for r in LT.divided(spark, path, schema).collect()}
    assert got == {i: i in LATE for rows in BATCHES for i, _ in rows}
    out = work_path(spark, "lt_out")
    counts = ST.windowed_count(LT.on_time(spark, path, schema), "t", "1 hour", delay="10 minutes")
    q = ST.start(counts, out, "update")
    ST.run_to_end(q)
    assert LT.dropped_rows(q) == 0
    assert ST.latest_updates(spark, out, ["window"]).agg(F.sum("count")).first()[0] == 5


def test_a_batch_that_runs_again_divides_alike(spark):
    path = work_path(spark, "lt_again")
    frames = [_batch(spark, rows) for rows in BATCHES]

    class Stream:  # hands the batch function over instead of starting a query
        sparkSession = spark

        @property
        def writeStream(self):
            return self

        def option(self, *_):
            return self

        def foreachBatch(self, fn):
            self.fn = fn
            return self

        def trigger(self, **_):
            return self

        def start(self):
            return self.fn

    divide = LT.divide_late(Stream(), "t", "1 hour", "10 minutes", path)
    for n, frame in enumerate(frames):
        divide(frame, n)
    read = lambda: sorted(map(tuple, LT.divided(spark, path, frames[0].schema).collect()), key=repr)
    before = read()
    divide(frames[1], 1)  # again, after later batches have stored their times
    assert read() == before
    assert {i for i, _, late, _ in before if late} == LATE


def test_no_time_at_all(spark):
    path = work_path(spark, "lt_none")
    empty = spark.createDataFrame([], SCHEMA)
    assert LT.flag_late(empty, "t", "1 hour", None).count() == 0
    for n in range(2):
        _batch(spark, [(n, None)]).agg(F.max("t").alias("high")).write.parquet(f"{path}/high/batch_id={n}")
    assert LT.watermark_before(spark, path, 2, "10 minutes") is None
