"""The parallel (segmented) window forms equal the stock Window forms."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import windows as W
from tessera.session import read_table

from table_helpers import SF_SMALL


@pytest.fixture(scope="module")
def orders(spark):
    return read_table(spark, SF_SMALL, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus")


def same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


CASES = {
    "rank": (lambda df, s: W.with_rank_columns(df, ["o_orderpriority"], ["-o_totalprice", "o_orderkey"],
                                               "rn", "rk", "drk", rank_order=["-o_totalprice"],
                                               strategy=s), ["o_orderkey", "rn", "rk", "drk"]),
    "rank_ties": (lambda df, s: W.with_rank_columns(df, ["o_orderstatus"], ["o_orderdate", "o_orderkey"],
                                                    None, "rk", "drk", rank_order=["o_orderdate"],
                                                    strategy=s), ["o_orderkey", "rk", "drk"]),
    "running_global": (lambda df, s: W.with_running_sum(df, [], ["o_orderdate", "o_orderkey"], "o_totalprice",
                                                        "rt", strategy=s, scale=2), ["o_orderkey", "rt"]),
    "running_key": (lambda df, s: W.with_running_sum(df, "o_custkey", ["o_orderdate", "o_orderkey"],
                                                     "o_totalprice", "rt", strategy=s, scale=2),
                    ["o_orderkey", "rt"]),
    "ntile": (lambda df, s: W.with_ntile(df, [], ["-o_totalprice", "o_orderkey"], 4, "nt", strategy=s), ["o_orderkey", "nt"]),
    "ntile_key": (lambda df, s: W.with_ntile(df, "o_orderpriority", ["-o_totalprice", "o_orderkey"], 7, "nt",
                                             strategy=s), ["o_orderkey", "nt"]),
    "lag_lead": (lambda df, s: W.with_lag_lead(df, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice",
                                               "lg", "ld", diff_name="d", strategy=s),
                 ["o_orderkey", "lg", "ld", "d"]),
    "lag_lead_global_3": (lambda df, s: W.with_lag_lead(df, [], ["o_orderdate", "o_orderkey"], "o_totalprice",
                                                        "lg", "ld", offset=3, strategy=s),
                          ["o_orderkey", "lg", "ld"]),
    "moving_avg": (lambda df, s: W.with_moving_avg(df, [], ["o_orderdate", "o_orderkey"], "o_totalprice", 2,
                                                   "ma", strategy=s, scale=2), ["o_orderkey", "ma"]),
    "first_last": (lambda df, s: W.with_first_last(df, "o_custkey", ["o_orderdate", "o_orderkey"],
                                                   "o_orderstatus", "f", "l", strategy=s),
                   ["o_orderkey", "f", "l"]),
    "percent": (lambda df, s: W.with_percent_of_partition(df, "o_orderpriority", "o_totalprice", "p",
                                                          strategy=s), ["o_orderkey", "p"]),
    "avg": (lambda df, s: W.with_partition_avg(df, "o_orderstatus", "o_totalprice", "a", "d", strategy=s, scale=2),
            ["o_orderkey", "a", "d"]),
    "total": (lambda df, s: W.with_total(df, "o_totalprice", "t", strategy=s, scale=2), ["o_orderkey", "t"]),
}


@pytest.fixture(params=[None, 40], ids=["no-hot-keys", "all-keys-split"])
def hot(request, monkeypatch):
    """Run each case with the default threshold and with a threshold so low that
    every key is split into ranges (exercising offsets and halos on keyed windows)."""
    if request.param is not None:
        monkeypatch.setattr(W, "DEFAULT_HOT_ROWS", request.param)
    return request.param


@pytest.mark.parametrize("case", sorted(CASES))
def test_segmented_equals_literal(orders, case, hot):
    fn, cols = CASES[case]
    assert same(fn(orders, "literal"), fn(orders, "segmented"), cols)


@pytest.mark.parametrize("case", ["rank", "running_key", "lag_lead", "moving_avg", "ntile_key"])
def test_one_hot_key(orders, case, monkeypatch):
    """Every row under one key (the skew case): the key is split, still exact."""
    monkeypatch.setattr(W, "DEFAULT_HOT_ROWS", 100)
    fn, cols = CASES[case]
    hot = orders.withColumns({"o_orderpriority": F.lit("HOT"), "o_custkey": F.lit(1).cast("long")})
    assert same(fn(hot, "literal"), fn(hot, "segmented"), cols)


def test_nulls_in_order_column(spark, orders, hot):
    nulled = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, None)
                               .otherwise(F.col("o_totalprice")))
    for s_fn in (lambda s: W.with_rank_columns(nulled, "o_orderpriority", ["-o_totalprice", "o_orderkey"],
                                               "rn", "rk", "drk", rank_order=["-o_totalprice"],
                                               strategy=s),
                 lambda s: W.with_rank_columns(nulled, [], ["o_totalprice", "o_orderkey"], "rn", "rk",
                                               "drk", rank_order=["o_totalprice"], strategy=s)):
        assert same(s_fn("literal"), s_fn("segmented"), ["o_orderkey", "rn", "rk", "drk"])


def test_ntile_sizes_and_running_total_end(orders):
    nt = W.with_ntile(orders, [], ["-o_totalprice", "o_orderkey"], 4, "nt")
    sizes = sorted(r["count"] for r in nt.groupBy("nt").count().collect())
    assert sizes[-1] - sizes[0] <= 1 and sum(sizes) == orders.count()
    rt = W.with_running_sum(orders, [], ["o_orderdate", "o_orderkey"], "o_totalprice", "rt", scale=2)
    last = rt.orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).first().rt
    total = orders.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")).first()[0]
    assert last == total


def test_top_n_uses_group_limit(orders):
    from tessera.plans.facts import plan_facts
    top = W.top_n_per_group(orders, "o_orderpriority", ["-o_totalprice", "o_orderkey"], 2)
    assert plan_facts(top).window_group_limits >= 1
    assert top.count() == 10


@pytest.mark.parametrize("order", [["o_orderdate", "o_orderkey"], ["tied", "o_orderkey"], ["o_orderpriority", "o_orderkey"],
                                   ["-flag", "-o_orderkey"]])
def test_no_range_exceeds_twice_the_bound(orders, order):
    """One tied date, a text order and a boolean order are split by the later columns."""
    df = orders.withColumns({"tied": F.lit("2020-01-01").cast("date"), "flag": F.col("o_orderkey") % 2 == 0})
    pos, offs = W.positions(df, [], order, hot_rows=100)
    sizes = [r["count"] for r in pos.groupBy("_seg").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) <= 200 and len(sizes) >= 15
    assert offs.count() == len(sizes)


def test_range_table_holds_only_keys_in_several_ranges(orders):
    _, offs = W.positions(orders, "o_custkey", ["o_orderdate", "o_orderkey"], hot_rows=5)
    ranges = -(-2 * 1500 // 5)
    assert 0 < offs.count() <= 2 * ranges


def test_sums_keep_every_digit(spark):
    df = spark.createDataFrame([(1, "1.005"), (2, "2.004")], "id int, t string").select(
        "id", F.col("t").cast("decimal(18,3)").alias("v"))
    assert {str(r["s"]) for r in W.with_total(df, "v", "s").collect()} == {"3.009"}


def test_number_of_ranges_is_bounded(orders, monkeypatch):
    """More rows make larger ranges, not ever more tasks, up to the default bound of a task."""
    assert [W._ranges(n, 1000) for n in (1500, 900_000, 54_000_000)] == [3, W.MOST_RANGES, W.MOST_RANGES]
    assert W._ranges(10**12, 1000) == W._ranges(10**12, W.DEFAULT_HOT_ROWS) == 10**6
    assert W._ranges(10**9, 10 * W.DEFAULT_HOT_ROWS) == 100
    monkeypatch.setattr(W, "MOST_RANGES", 7)
    ranked = W.with_rank_columns(orders, "o_orderstatus", ["o_orderdate", "o_orderkey"], "rn", "rk", "drk",
                                 rank_order=["o_orderdate"], hot_rows=10)
    plain = W.with_rank_columns(orders, "o_orderstatus", ["o_orderdate", "o_orderkey"], "rn", "rk", "drk",
                                rank_order=["o_orderdate"], strategy="literal")
    assert same(ranked, plain, ["o_orderkey", "rn", "rk", "drk"])
    pos, _ = W.positions(orders, [], ["o_orderkey"], hot_rows=10)
    assert pos.select("_seg").distinct().count() <= 7
