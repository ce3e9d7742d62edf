"""Catalog statements, statistics, JSON config, late data, surrogate keys, codecs."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import mutation as MU
from tessera.operators.aggregate import kpis
from tessera.operators.joins import with_config
from tessera.queries.agg_queries import balance_report
from tessera.queries.report_queries import customer_silver, with_surrogate_key
from tessera.session import read_table, work_path
from tessera.sinks import layout as L
from tessera.sources import files as S
from tessera.streaming import streams as ST

from table_helpers import SF_SMALL


def test_database_and_table_statements(spark):
    loc = work_path(spark, "retail_db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS retail_demo COMMENT 'demo' LOCATION '{loc}' "
              "WITH DBPROPERTIES ('team' = 'data')")
    spark.sql("ALTER DATABASE retail_demo SET DBPROPERTIES ('stage' = 'dev')")
    props = {r[0]: r[1] for r in spark.sql("DESCRIBE DATABASE EXTENDED retail_demo").collect()}
    assert "team" in props.get("Properties", "") and "stage" in props.get("Properties", "")
    n = read_table(spark, SF_SMALL, "nation")
    n.write.option("path", work_path(spark, "nation_t")).saveAsTable("retail_demo.nation_t")
    spark.sql("ALTER TABLE retail_demo.nation_t SET TBLPROPERTIES ('layer' = 'silver')")
    assert "nation_t" in [r.tableName for r in spark.sql("SHOW TABLES IN retail_demo").collect()]
    tp = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES retail_demo.nation_t").collect()}
    assert tp["layer"] == "silver"
    spark.sql("DROP TABLE retail_demo.nation_t")
    spark.sql("DROP DATABASE retail_demo")


def test_analyze_statistics(spark):
    c = read_table(spark, SF_SMALL, "customer").select("c_custkey", "c_nationkey")
    c.write.option("path", work_path(spark, "stats_t")).saveAsTable("stats_t")
    out = {r.column: r for r in MU.analyze(spark, "stats_t", ["c_custkey", "c_nationkey"]).collect()}
    agg = c.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    assert int(out["c_custkey"]["min"]) == agg[0] and int(out["c_custkey"]["max"]) == agg[1]
    assert out["c_nationkey"]["num_nulls"] == "0"
    spark.sql("DROP TABLE stats_t")


def test_multiline_json_config(spark, tmp_path):
    p = tmp_path / "config.json"
    p.write_text(json.dumps({"academy_name": "A", "currency": "INR",
                             "attendance_warning_percent": 75, "total_fee": 5000}, indent=2))
    cfg = S.read_json(spark, str(p), multiline=True)
    assert cfg.count() == 1
    cfg = cfg.withColumn("total_fee", F.col("total_fee").cast("decimal(18,2)"))
    out = balance_report(read_table(spark, SF_SMALL, "customer"), cfg)
    assert out.count() > 0 and set(out.columns) >= {"pending_fee", "below_warning"}
    two = cfg.unionByName(cfg)
    try:
        with_config(read_table(spark, SF_SMALL, "nation"), two)
        raise AssertionError("two config rows accepted")
    except ValueError:
        pass


def test_late_rows_are_dropped_in_append_mode(spark):
    src = work_path(spark, "late_src")
    mk = lambda rows: spark.createDataFrame(rows, "ts string, v int").withColumn(
        "ts", F.to_timestamp("ts"))
    mk([("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 2)]).coalesce(1).write.parquet(src)
    out, ckpt = work_path(spark, "late_out"), work_path(spark, "late_ckpt")

    def run():
        s = spark.readStream.schema("ts timestamp, v int").option("maxFilesPerTrigger", 1).parquet(src)
        ST.run_to_end(ST.start(ST.windowed_count(s, "ts", "5 minutes", delay="10 minutes"), out,
                               "append", checkpoint=ckpt))
    run()
    # a row 1 hour behind the watermark arrives later: dropped, its window never reopens
    mk([("2024-01-01 00:01:00", 3), ("2024-01-01 02:00:00", 4)]).coalesce(1).write.mode(
        "append").parquet(src)
    run()
    got = {r.window.start.strftime("%H:%M"): r["count"] for r in spark.read.parquet(out).collect()}
    assert got.get("00:00") == 1 and "02:00" not in got


def test_surrogate_key_is_stable(spark):
    s = customer_silver(spark, SF_SMALL).select("c_custkey")
    a = with_surrogate_key(s, "c_custkey")
    b = with_surrogate_key(s.orderBy(F.desc("c_custkey")), "c_custkey")
    assert a.exceptAll(b).count() == 0
    assert a.select("customer_key").distinct().count() == s.count()


def test_codec_sizes_and_approx_kpis(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    sizes = {}
    for codec in ("uncompressed", "gzip"):
        p = L.write_layer(li, work_path(spark, f"sz_{codec}"), codec=codec)
        sizes[codec] = L.file_sizes(spark, p).first()["bytes"]
    assert sizes["gzip"] < sizes["uncompressed"]
    exact = kpis(li, {"parts": "l_partkey"}, {}).first()["parts"]
    approx = kpis(li, {"parts": "l_partkey"}, {}, approx=True).first()["parts"]
    assert abs(approx - exact) <= 0.1 * exact


def test_bad_rows_without_a_schema(spark, tmp_path):
    for n, body in enumerate(("a,b\n1,2\n\n3\n", "a,b\n4,5,6\n7,8\n")):
        (tmp_path / f"f{n}.csv").write_text(body)
    good, bad = S.read_delimited(spark, str(tmp_path))
    assert sorted(map(tuple, good.collect())) == [("1", "2"), ("7", "8")]
    assert sorted(r["raw_record"] for r in bad.collect()) == ["3", "4,5,6"]
    assert S.read_delimited(spark, str(tmp_path), on_bad="drop").count() == 2
    try:
        S.read_delimited(spark, str(tmp_path), on_bad="fail").collect()
        raise AssertionError("bad rows accepted")
    except Exception as e:  # noqa: BLE001
        assert "MALFORMED" in str(e)


def test_columns_are_found_by_each_files_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note,n\n1,one,5\n\n2,two,x\n")
    (tmp_path / "b.csv").write_text('n,"id",note\n6,3,"a, b"\n7,4,\n')
    (tmp_path / "c.csv").write_text("id,note\n9,lost\n")
    (tmp_path / "d.csv").write_text("id,note,n,id\n9,lost,1,9\n\nid,note,n,id\n")
    ddl = "id INT, note STRING, n INT"
    good, bad = S.read_delimited(spark, str(tmp_path), ddl)
    assert sorted(map(tuple, good.collect())) == [(1, "one", 5), (3, "a, b", 6), (4, None, 7)]
    assert sorted(r["raw_record"] for r in bad.collect()) == ["2,two,x", "9,lost", "9,lost,1,9"]
    assert len(S.read_delimited(spark, str(tmp_path), ddl, on_bad="drop").collect()) == 3
    with pytest.raises(ValueError, match="has the columns"):
        S.read_delimited(spark, str(tmp_path), ddl, on_bad="fail")


def test_silver_keeps_count_of_copies_without_an_index(spark, tmp_path):
    from tessera.operators.medallion import customer_bronze, customer_silver
    head = "Customer Id,First Name,Last Name,Company,City,Country,Phone 1,Email,Subscription Date\n"
    row = "{},ann,bell,co,rome,italy,1,a@b.org,{}\n"
    (tmp_path / "feed.csv").write_text(head + "".join(
        row.format(i, d) for i, d in [(1, "2024-01-01"), (1, "2024-01-01"), (1, "2023-01-01"), (2, "2024-05-05"),
                                      (2, "2024-05-05"), (3, "no date")]))
    customer_bronze(spark, f"{tmp_path}/feed.csv", f"{tmp_path}/bronze")
    res = customer_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/rejected",
                          f"{tmp_path}/copies")
    kept, rejected, copies = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("silver", "rejected", "copies"))
    assert [kept.count(), rejected.count(), copies.count()] == [2, 1, 3]
    assert "_row" not in {*kept.columns, *rejected.columns, *copies.columns, *res.valid.columns}


FEED = ["Index", "Customer Id", "First Name", "Last Name", "Company", "City", "Country", "Phone 1", "Email",
        "Subscription Date"]


@pytest.mark.parametrize("turned", [False, True], ids=["same headers", "other order"])
def test_a_feed_of_several_files_reaches_bronze_and_silver(spark, tmp_path, turned):
    """Each row keeps its own file, also where the files' columns stand in another order."""
    from tessera.operators.medallion import customer_bronze, customer_silver
    feed = tmp_path / "feed"
    feed.mkdir()
    for n in range(3):
        row = dict(zip(FEED, [str(n), f"c{n}", "Ann", "Lee", "Co", "Rome", "Italy", "1", f"a{n}@mail.com",
                              "2024-01-02"]))
        columns = FEED[::-1] if turned and n else FEED
        (feed / f"f{n}.csv").write_text(",".join(columns) + "\n" + ",".join(row[c] for c in columns) + "\n")
    customer_bronze(spark, str(feed), f"{tmp_path}/bronze")
    bronze = spark.read.option("header", "true").csv(f"{tmp_path}/bronze").collect()
    assert {r["Customer Id"]: r["_source_file"].rsplit("/", 1)[1] for r in bronze} == {
        f"c{n}": f"f{n}.csv" for n in range(3)}
    res = customer_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/rejected")
    assert res.counts["input"] == res.counts["valid"] == 3


def test_files_of_one_header_are_read_in_one_go(spark, tmp_path):
    """The read by names is for files whose headers differ."""
    for n in range(2):
        (tmp_path / f"f{n}.csv").write_text(f"a,b\n{n},x\n")
    good, _ = S.read_delimited(spark, str(tmp_path))
    assert "Union" not in good._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, good.collect())) == [("0", "x"), ("1", "x")]


def test_strict_load_has_few_files(spark, tmp_path, monkeypatch):
    """Files hold up to FILE_LINES lines, whatever the keys are; every line is in one of them."""
    from tessera.queries import table_queries as TQ
    spark.range(1, 5001).selectExpr("id * 200 + id % 2 AS o_orderkey", "'1-URGENT' AS o_orderpriority").coalesce(1).write.parquet(
        f"{tmp_path}/orders.parquet")
    files, read = [], S.read_delimited

    def seen(session, path, **how):
        files.extend(session.read.text(path).inputFiles())
        return read(session, path, **how)

    monkeypatch.setattr(TQ.S, "read_delimited", seen)
    monkeypatch.setattr(TQ, "FILE_LINES", 1000)
    rows = {r["kind"]: r["records"] for r in TQ.csv_strict_rows(spark, str(tmp_path)).collect()}
    keys = [(i * 200 + i % 2) % 50 for i in range(1, 5001)]
    assert rows == {"good": sum(k not in (1, 2) for k in keys), "bad": sum(k in (1, 2) for k in keys)}
    assert 2 < len(files) <= 8
