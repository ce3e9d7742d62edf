"""Plan evidence: pushdown, pruning, broadcast only when checked, no exchange for
bucketed joins, no Python in any registered query."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.plans.facts import plan_facts
from tessera.session import read_table, work_path
from tessera.sinks import layout as L

from table_helpers import SF_SMALL


def test_filter_and_columns_reach_the_scan(spark):
    o = read_table(spark, SF_SMALL, "orders")
    q = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    f = plan_facts(q)
    assert any("o_orderstatus" in p for p in f.pushed_filters)
    assert f.read_schemas and all("o_orderdate" not in s for s in f.read_schemas)


def test_broadcast_is_bound_by_planned_bytes(spark):
    part, li = (read_table(spark, SF_SMALL, t) for t in ("part", "lineitem"))
    assert 0 < J.plan_bytes(part) < J.plan_bytes(li)
    on = li.l_partkey == part.p_partkey
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_facts(J.join_dim(li, part, on, strategy="broadcast")).broadcast_joins == 1
        assert plan_facts(J.join_dim(li, part, on, strategy="broadcast", max_bytes=10)).broadcast_joins == 0
        assert plan_facts(J.join_dim(li, part, on)).broadcast_joins == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_keeps_rows_and_refuses_outer_kinds(spark):
    big = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 1), (3, 1)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "z")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = J.salted_join(big, small, ["k"], 8, ["v"], how, hot_rows=5)
        want = big.join(small, "k", how)
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(
            map(tuple, want.collect()), key=repr)
    for how in ("full", "right"):
        with pytest.raises(ValueError):
            J.salted_join(big, small, ["k"], 8, ["v"], how)


@pytest.mark.parametrize("name,kind", [("bucket_join", "SortMergeJoin"), ("salted_join", "SortMergeJoin"),
                                       ("broadcast_join", "BroadcastHashJoin")])
def test_plans_match_their_names(spark, name, kind):
    import __spark_entry__ as entry
    text = plan_facts(entry.queries()[name](spark, SF_SMALL)).text
    assert kind in text
    if name == "bucket_join":
        assert "BroadcastExchange" not in text and "Bucketed: true" in text


def test_latest_per_key_has_a_group_limit_and_no_sort_aggregate(spark):
    from tessera.operators.dedup import latest_per_key
    o = read_table(spark, SF_SMALL, "orders")
    f = plan_facts(latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"]))
    assert f.window_group_limits >= 1 and "SortAggregate" not in f.text


def test_bucketed_join_has_no_exchange(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    o = read_table(spark, SF_SMALL, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    a = L.save_bucketed(spark, li, "b_li", ["k"], 4)
    b = L.save_bucketed(spark, o, "b_o", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = J.join_dim(spark.table(a), spark.table(b), "k", strategy="bucket")
        f = plan_facts(j)
        assert f.sort_merge_joins == 1 and f.shuffle_exchanges == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partition_pruning(spark):
    path = work_path(spark, "pruned")
    L.write_layer(read_table(spark, SF_SMALL, "orders"), path, partition_by=["o_orderstatus"])
    q = spark.read.parquet(path).filter(F.col("o_orderstatus") == "O")
    f = plan_facts(q)
    assert any("o_orderstatus" in p for p in f.partition_filters)


def test_share_of_total_has_no_single_partition_window(spark):
    import __spark_entry__ as entry
    df = entry.queries()["customers_by_nation"](spark, SF_SMALL)
    f = plan_facts(df)
    assert "SinglePartition" not in f.text or "Window" not in f.text


@pytest.mark.parametrize("name", ["win_running_total", "win_moving_avg", "win_ntile",
                                  "win_grand_total"])
def test_global_windows_are_not_single_task(spark, name, monkeypatch):
    """Above the one-task bound, no Window runs over the whole table in one partition."""
    import __spark_entry__ as entry
    from tessera.operators import windows as W
    monkeypatch.setattr(W, "DEFAULT_HOT_ROWS", 1000)
    df = entry.queries()[name](spark, SF_SMALL)
    import re
    text = plan_facts(df).text
    unpartitioned = [ln for ln in text.splitlines() if re.search(r"Window \[.*\], \[\], \[", ln)]
    for line in unpartitioned:
        # the only unpartitioned window allowed is the prefix over the tiny per-range table
        assert "_cnt" in line or "_sum_" in line or "_dcnt" in line, line


def test_small_global_window_stays_plain(spark):
    """Below the bound (one partial/final count) the plain window is used: one shuffle."""
    import __spark_entry__ as entry
    df = entry.queries()["win_running_total"](spark, SF_SMALL)
    f = plan_facts(df)
    assert f.broadcast_joins == 0 and f.text.count("Window [") == 1


def test_no_python_in_registered_queries(spark):
    """The last plan of every query; what queries write before it is built from the same functions."""
    from tessera.queries import QUERIES
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):  # these run for a while; their operators are plain functions
            continue
        assert plan_facts(fn(spark, SF_SMALL)).python_evals == 0, name


def test_hot_path_join_broadcasts_only_hot_keys(spark):
    from tessera.operators.joins import heavy_keys, hot_path_join
    big = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 3000).alias("k"), "id")
    small = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert len(heavy_keys(big, ["k"], 1000)) == 1
    out = hot_path_join(big, small, ["k"], hot_rows=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert out.count() == 20_000
    assert out.agg(F.sum("v")).first() == big.join(small, "k").agg(F.sum("v")).first()
    with pytest.raises(ValueError):
        hot_path_join(big, small, ["k"], "full")
