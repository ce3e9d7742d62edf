"""Complete mode of sorted reports: the whole result after every batch, without engine state."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.session import checkpoint_root, work_path
from tessera.streaming import streams as ST

from test_entry import _rows

SCHEMA = "at timestamp, text string"


def feed(spark, src, rows):
    spark.createDataFrame(rows, "at string, text string").select(
        F.to_timestamp("at").alias("at"), "text").coalesce(1).write.mode("append").parquet(src)


def report(spark, src, out, state):
    order = [F.desc("count"), F.col("word")]
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    ST.run_to_end(ST.start_report(stream, lambda b: ST.windowed_tokens(b, "text", "at"), out, order, checkpoint=state))
    found = ST.last_report(spark, out).select(F.date_format("window.start", "dd HH:mm").alias("w"), "word", "count")
    return [tuple(r) for r in found.orderBy(*order, "w").collect()]


def test_every_batch_leaves_the_whole_report(spark):
    src, out, state = (work_path(spark, f"report_{n}") for n in ("src", "out", "state"))
    feed(spark, src, [("2024-01-01 00:01:00", "alpha beta! alpha abc"), ("2024-01-01 00:06:00", "beta"), (None, "lost")])
    assert report(spark, src, out, state) == [("01 00:00", "alpha", 2), ("01 00:00", "beta", 1), ("01 00:05", "beta", 1)]
    # the second batch begins in the last window of the first
    feed(spark, src, [("2024-01-01 00:09:00", "Beta gamma"), ("2024-01-02 00:00:00", "beta"), ("2024-01-02 00:00:01", None)])
    second = [("01 00:00", "alpha", 2), ("01 00:05", "beta", 2), ("01 00:00", "beta", 1), ("02 00:00", "beta", 1),
              ("01 00:05", "gamma", 1)]
    assert report(spark, src, out, state) == second
    # long after its window a late row is counted, and a batch without words loses nothing
    feed(spark, src, [("2024-01-01 00:02:00", "beta beta beta")])
    feed(spark, src, [("2024-01-03 00:00:00", "abc")])
    third = [("01 00:00", "beta", 4), *[r for r in second if r != ("01 00:00", "beta", 1)]]
    assert report(spark, src, out, state) == third
    feed(spark, src, [("2024-01-03 00:00:00", "abc")])
    assert report(spark, src, out, state) == third
    # written in order, and no more than two reports stay
    written = [r["count"] for r in ST.last_report(spark, out).collect()]
    assert written == sorted(written, reverse=True)
    assert len([d for d in os.listdir(out.removeprefix("file://")) if d.startswith("batch_id=")]) == 2


def test_a_batch_that_runs_again_leaves_the_same_report(spark):
    src, out, state = (work_path(spark, f"again_{n}") for n in ("src", "out", "state"))
    feed(spark, src, [("2024-01-01 00:01:00", "alpha beta")])
    report(spark, src, out, state)
    feed(spark, src, [("2024-01-01 00:02:00", "alpha")])
    want = report(spark, src, out, state)
    commits = f"{state.removeprefix('file://')}/commits"
    for name in ("1", ".1.crc"):                     # as after a failure between the write and its commit
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    assert report(spark, src, out, state) == want == [("01 00:00", "alpha", 2), ("01 00:00", "beta", 1)]


@pytest.mark.parametrize("rows", [60, 0])
def test_word_windows_need_no_engine_state(spark, tmp_path, rows):
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT i AS doc_id, CASE WHEN i % 9 > 0 THEN 'word' || i % 5 || ' Some-thing abc  same' END AS text,
        'en' AS lang, 's' AS source, 30 AS n_chars FROM range({rows}) t(i) UNION ALL
        SELECT NULL, 'nowhere', 'en', 's', 7 FROM range({rows // 30})) TO '{tmp_path}/documents.parquet'""")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    root = checkpoint_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    got = entry.queries()["stream_word_window"](spark, str(tmp_path))
    found = _rows(got.columns, got.collect())
    want = con.execute(entry.oracle_sql()["stream_word_window"])
    assert found == _rows([d[0] for d in want.description], want.fetchall()) and bool(found) == bool(rows)
    mine = [d for d in os.listdir(root) if d not in before and d.startswith("replay_state")]
    assert mine and not any(os.path.isdir(f"{root}/{d}/state") for d in mine)
