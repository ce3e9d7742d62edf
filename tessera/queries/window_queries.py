"""Window queries (WIN-1..21) over ``orders`` and ``customer``.

Money is DOUBLE in the tables, so its sums are taken as exact decimals of two digits
(``scale=2``) and returned as DOUBLE on both sides.  The ``_split`` forms run the same
operators with a low hot-key threshold, so that the range-split path is what is compared;
some of them over amounts with nulls, NaN and three digits, over tied dates and text orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import sql_cents, sql_money, sql_percent
from tessera.operators import windows as W
from tessera.operators.dedup import latest_per_key
from tessera.queries.registry import query
from tessera.session import read_table

PRICE, BALANCE = sql_money("o_totalprice"), sql_money("c_acctbal")
BY_DATE = ["o_orderdate", "o_orderkey"]
BY_PRICE = ["-o_totalprice", "o_orderkey"]
BY_BALANCE = ["-c_acctbal", "c_custkey"]
SQL_BY_DATE = "ORDER BY o_orderdate, o_orderkey"
SQL_BY_PRICE = "ORDER BY o_totalprice DESC, o_orderkey"
SQL_BY_BALANCE = "ORDER BY c_acctbal DESC, c_custkey"
#: Threshold of the split forms, far below the default so that the small tables are split.
SPLIT_ROWS = 1000


def _orders(spark, sf, *columns) -> DataFrame:
    return read_table(spark, sf, "orders").select("o_orderkey", *columns)


def _customers(spark, sf, *columns) -> DataFrame:
    return read_table(spark, sf, "customer").select("c_custkey", *columns)


# ---------------------------------------------------------------- totals and averages

@query("win_grand_total", f"""
SELECT o_orderkey, o_totalprice, CAST(SUM({PRICE}) OVER () AS DOUBLE) AS all_orders FROM orders""")
def win_grand_total(spark, sf):
    return W.with_total(_orders(spark, sf, "o_totalprice"), "o_totalprice", "all_orders", scale=2)


@query("win_region_total", f"""
SELECT o_orderkey, o_orderpriority,
       CAST(SUM({PRICE}) OVER (PARTITION BY o_orderpriority) AS DOUBLE) AS priority_total FROM orders""")
def win_region_total(spark, sf):
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.with_partition_total(df, "o_orderpriority", "o_totalprice", "priority_total",
                                  scale=2).drop("o_totalprice")


@query("win_category_avg", f"""
SELECT o_orderkey, o_orderstatus, m AS status_mean, o_totalprice - m AS off_mean FROM (
  SELECT *, CAST(SUM({PRICE}) OVER g AS DOUBLE) / COUNT(o_totalprice) OVER g AS m
  FROM orders WINDOW g AS (PARTITION BY o_orderstatus))""")
def win_category_avg(spark, sf):
    df = _orders(spark, sf, "o_orderstatus", "o_totalprice")
    return W.with_partition_avg(df, "o_orderstatus", "o_totalprice", "status_mean", "off_mean",
                                scale=2).drop("o_totalprice")


@query("win_salary_vs_avg", f"""
SELECT c_custkey, c_nationkey, m AS nation_mean, c_acctbal - m AS off_mean FROM (
  SELECT *, CAST(SUM({BALANCE}) OVER g AS DOUBLE) / COUNT(c_acctbal) OVER g AS m
  FROM customer WINDOW g AS (PARTITION BY c_nationkey))""")
def win_salary_vs_avg(spark, sf):
    df = _customers(spark, sf, "c_nationkey", "c_acctbal")
    return W.with_partition_avg(df, "c_nationkey", "c_acctbal", "nation_mean", "off_mean",
                                scale=2).drop("c_acctbal")


@query("win_percent_of_region", f"""
SELECT o_orderkey, o_orderpriority, {sql_percent(
    sql_cents("o_totalprice"), "SUM(" + sql_cents("o_totalprice") + ") OVER (PARTITION BY o_orderpriority)")}
  AS pct_of_priority FROM orders""")
def win_percent_of_region(spark, sf):
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.with_percent_of_partition(df, "o_orderpriority", "o_totalprice",
                                       "pct_of_priority").drop("o_totalprice")


# ---------------------------------------------------------------- ranks and tiles

@query("win_row_number", f"""
SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderpriority {SQL_BY_PRICE}) AS place FROM orders""")
def win_row_number(spark, sf):
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.with_rank_columns(df, "o_orderpriority", BY_PRICE, row_number="place").select("o_orderkey", "place")


_RANKS = """
SELECT o_orderkey, RANK() OVER w AS place, DENSE_RANK() OVER w AS level
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC)"""


@query("win_rank_dense", _RANKS)
def win_rank_dense(spark, sf):
    df = _orders(spark, sf, "o_orderstatus", "o_orderdate")
    return W.with_rank_columns(df, "o_orderstatus", ["-o_orderdate", "o_orderkey"], rank="place",
                               dense_rank="level", rank_order=["-o_orderdate"]).select(
        "o_orderkey", "place", "level")


_THREE = """
SELECT o_orderkey, ROW_NUMBER() OVER (w, o_orderkey) AS n, RANK() OVER w AS place, DENSE_RANK() OVER w AS level
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC)""".replace(
    "(w, o_orderkey)", "(PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey)")


def _three_ranks(spark, sf, **kw):
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.with_rank_columns(df, "o_orderpriority", BY_PRICE, "n", "place", "level",
                               rank_order=["-o_totalprice"], **kw).select("o_orderkey", "n", "place", "level")


@query("win_rank_compare", _THREE)
def win_rank_compare(spark, sf):
    return _three_ranks(spark, sf)


@query("win_salary_rank", """
SELECT c_custkey, RANK() OVER w AS place, DENSE_RANK() OVER w AS level
FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)""")
def win_salary_rank(spark, sf):
    df = _customers(spark, sf, "c_nationkey", "c_acctbal")
    return W.with_rank_columns(df, "c_nationkey", BY_BALANCE, rank="place", dense_rank="level",
                               rank_order=["-c_acctbal"]).select("c_custkey", "place", "level")


@query("win_top2_per_region", f"""
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderpriority {SQL_BY_PRICE}) <= 2""")
def win_top2_per_region(spark, sf):
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.top_n_per_group(df, "o_orderpriority", BY_PRICE, 2).drop("rn")


@query("win_top2_salary", f"""
SELECT c_nationkey, c_custkey, c_name FROM customer
QUALIFY ROW_NUMBER() OVER (PARTITION BY c_nationkey {SQL_BY_BALANCE}) <= 2""")
def win_top2_salary(spark, sf):
    df = _customers(spark, sf, "c_nationkey", "c_name", "c_acctbal")
    return W.top_n_per_group(df, "c_nationkey", BY_BALANCE, 2).drop("rn", "c_acctbal")


_TILES = f"SELECT o_orderkey, NTILE(4) OVER ({SQL_BY_PRICE}) AS quarter FROM orders"


def _tiles(spark, sf, **kw):
    return W.with_ntile(_orders(spark, sf, "o_totalprice"), [], BY_PRICE, 4, "quarter", **kw).drop("o_totalprice")


@query("win_ntile", _TILES)
def win_ntile(spark, sf):
    return _tiles(spark, sf)


@query("win_latest_per_salesperson", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def win_latest_per_salesperson(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_orderstatus")
    return latest_per_key(df, "o_custkey", BY_DATE).drop("o_orderdate")


# ---------------------------------------------------------------- running and neighbouring rows

_RUNNING = f"""
SELECT o_orderkey, CAST(SUM({PRICE}) OVER ({SQL_BY_DATE} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far FROM orders"""


def _running(spark, sf, **kw):
    df = _orders(spark, sf, "o_orderdate", "o_totalprice")
    return W.with_running_sum(df, [], BY_DATE, "o_totalprice", "so_far", scale=2, **kw).select("o_orderkey", "so_far")


@query("win_running_total", _RUNNING)
def win_running_total(spark, sf):
    return _running(spark, sf)


@query("win_running_by_salesperson", f"""
SELECT o_orderkey, CAST(SUM({PRICE}) OVER (PARTITION BY o_custkey {SQL_BY_DATE} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
  AS customer_so_far FROM orders""")
def win_running_by_salesperson(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_totalprice")
    return W.with_running_sum(df, "o_custkey", BY_DATE, "o_totalprice", "customer_so_far", scale=2).select(
        "o_orderkey", "customer_so_far")


_MOVING = f"""
SELECT o_orderkey, CAST(SUM({PRICE}) OVER w AS DOUBLE) / COUNT(o_totalprice) OVER w AS mean_of_three
FROM orders WINDOW w AS ({SQL_BY_DATE} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


def _moving(spark, sf, **kw):
    df = _orders(spark, sf, "o_orderdate", "o_totalprice")
    return W.with_moving_avg(df, [], BY_DATE, "o_totalprice", 2, "mean_of_three", scale=2, **kw).select(
        "o_orderkey", "mean_of_three")


@query("win_moving_avg", _MOVING)
def win_moving_avg(spark, sf):
    return _moving(spark, sf)


@query("win_lag_lead", f"""
SELECT o_orderkey, LAG(o_totalprice) OVER w AS earlier, LEAD(o_totalprice) OVER w AS later
FROM orders WINDOW w AS (PARTITION BY o_custkey {SQL_BY_DATE})""")
def win_lag_lead(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_totalprice")
    return W.with_lag_lead(df, "o_custkey", BY_DATE, "o_totalprice", "earlier", "later").select(
        "o_orderkey", "earlier", "later")


@query("win_diff_previous", f"""
SELECT o_orderkey, o_totalprice - LAG(o_totalprice) OVER (PARTITION BY o_custkey {SQL_BY_DATE}) AS change FROM orders""")
def win_diff_previous(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_totalprice")
    return W.with_lag_lead(df, "o_custkey", BY_DATE, "o_totalprice", diff_name="change").select("o_orderkey", "change")


@query("win_salary_neighbours", f"""
SELECT c_custkey, LAG(c_acctbal) OVER w AS above, LEAD(c_acctbal) OVER w AS below
FROM customer WINDOW w AS (PARTITION BY c_nationkey {SQL_BY_BALANCE})""")
def win_salary_neighbours(spark, sf):
    df = _customers(spark, sf, "c_nationkey", "c_acctbal")
    return W.with_lag_lead(df, "c_nationkey", BY_BALANCE, "c_acctbal", "above", "below").select(
        "c_custkey", "above", "below")


@query("win_first_last", f"""
SELECT o_orderkey, FIRST_VALUE(o_totalprice) OVER w AS opening, LAST_VALUE(o_totalprice) OVER w AS closing
FROM orders WINDOW w AS (PARTITION BY o_custkey {SQL_BY_DATE} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def win_first_last(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_totalprice")
    return W.with_first_last(df, "o_custkey", BY_DATE, "o_totalprice", "opening", "closing").select(
        "o_orderkey", "opening", "closing")


@query("win_first_last_category", f"""
SELECT o_orderkey, FIRST_VALUE(o_orderstatus) OVER w AS first_status, LAST_VALUE(o_orderstatus) OVER w AS last_status
FROM orders WINDOW w AS (PARTITION BY o_custkey {SQL_BY_DATE} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def win_first_last_category(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_orderstatus")
    return W.with_first_last(df, "o_custkey", BY_DATE, "o_orderstatus", "first_status", "last_status").select(
        "o_orderkey", "first_status", "last_status")


_DESCENDING = """
SELECT o_orderkey, FIRST_VALUE(o_orderstatus) OVER w AS newest, LAST_VALUE(o_orderstatus) OVER w AS oldest
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey {}
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


@query("win_first_last_descending", _DESCENDING.format("DESC"))
def win_first_last_descending(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_orderstatus")
    return W.with_first_last(df, "o_custkey", ["-o_orderdate", "-o_orderkey"], "o_orderstatus", "newest",
                             "oldest").select("o_orderkey", "newest", "oldest")


@query("win_first_last_mixed", _DESCENDING.format("ASC"))
def win_first_last_mixed(spark, sf):
    df = _orders(spark, sf, "o_custkey", "o_orderdate", "o_orderstatus")
    return W.with_first_last(df, "o_custkey", ["-o_orderdate", "o_orderkey"], "o_orderstatus", "newest",
                             "oldest").select("o_orderkey", "newest", "oldest")


# ---------------------------------------------------------------- split forms

@query("win_running_total_split", _RUNNING)
def win_running_total_split(spark, sf):
    return _running(spark, sf, hot_rows=SPLIT_ROWS)


@query("win_rank_compare_split", _THREE)
def win_rank_compare_split(spark, sf):
    return _three_ranks(spark, sf, hot_rows=SPLIT_ROWS)


@query("win_rank_ties_split", _RANKS)
def win_rank_ties_split(spark, sf):
    """Ranks by a date that many orders share: values reach over from range to range."""
    df = _orders(spark, sf, "o_orderstatus", "o_orderdate")
    return W.with_rank_columns(df, "o_orderstatus", ["-o_orderdate", "o_orderkey"], rank="place",
                               dense_rank="level", rank_order=["-o_orderdate"], hot_rows=300).select(
        "o_orderkey", "place", "level")


@query("win_ntile_split", _TILES)
def win_ntile_split(spark, sf):
    return _tiles(spark, sf, hot_rows=SPLIT_ROWS)


@query("win_moving_avg_split", _MOVING)
def win_moving_avg_split(spark, sf):
    return _moving(spark, sf, hot_rows=SPLIT_ROWS)


@query("win_region_neighbours_split", f"""
SELECT o_orderkey, LAG(o_totalprice) OVER w AS above, LEAD(o_totalprice) OVER w AS below
FROM orders WINDOW w AS (PARTITION BY o_orderpriority {SQL_BY_PRICE})""")
def win_region_neighbours_split(spark, sf):
    """LAG / LEAD inside five hot keys, each split into ranges."""
    df = _orders(spark, sf, "o_orderpriority", "o_totalprice")
    return W.with_lag_lead(df, "o_orderpriority", BY_PRICE, "o_totalprice", "above", "below",
                           hot_rows=SPLIT_ROWS).select("o_orderkey", "above", "below")


#: Amounts of three digits, every seventh missing and also whole stretches of keys, as a fixed
#: expression both engines read alike.
ROUGH = """CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 4000 < 900 THEN NULL
  ELSE CAST(o_totalprice AS DECIMAL(18,2)) + CAST((o_orderkey % 10) * 0.001 AS DECIMAL(18,3)) END"""
#: A DOUBLE sort value with NaN and nulls.
HOLES = """CASE WHEN o_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) WHEN o_orderkey % 11 = 0 THEN NULL
  ELSE CAST(o_orderkey % 100 AS DOUBLE) END"""


def _rough(spark, sf):
    return _orders(spark, sf, F.expr(ROUGH).alias("amount"), F.expr(HOLES).alias("v"), "o_orderpriority")


_ROUGH_SUMS = f"""
SELECT o_orderkey, CAST(SUM(a) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far,
  CAST(SUM(a) OVER w AS DOUBLE) / NULLIF(COUNT(a) OVER w, 0) AS mean_of_three, CAST(SUM(a) OVER () AS DOUBLE) AS total
FROM (SELECT o_orderkey, {ROUGH} AS a FROM orders)
WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""


def _rough_sums(spark, sf, **kw):
    df = _rough(spark, sf).select("o_orderkey", "amount")
    df = W.with_running_sum(df, [], ["o_orderkey"], "amount", "so_far", **kw)
    df = W.with_moving_avg(df, [], ["o_orderkey"], "amount", 2, "mean_of_three", **kw)
    df = W.with_total(df, "amount", "total")
    return df.select("o_orderkey", F.col("so_far").cast("double"), "mean_of_three", F.col("total").cast("double"))


@query("win_rough_sums", _ROUGH_SUMS)
def win_rough_sums(spark, sf):
    return _rough_sums(spark, sf)


@query("win_rough_sums_split", _ROUGH_SUMS)
def win_rough_sums_split(spark, sf):
    return _rough_sums(spark, sf, hot_rows=SPLIT_ROWS)


_ROUGH_RANKS = f"""
SELECT o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY v DESC NULLS LAST, o_orderkey) AS n,
  RANK() OVER (PARTITION BY o_orderpriority ORDER BY v DESC NULLS LAST) AS place,
  DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY v DESC NULLS LAST) AS level,
  ROW_NUMBER() OVER (ORDER BY v NULLS FIRST, o_orderkey) AS n_up
FROM (SELECT o_orderkey, o_orderpriority, {HOLES} AS v FROM orders)"""


def _rough_ranks(spark, sf, **kw):
    df = _rough(spark, sf).drop("amount")
    df = W.with_rank_columns(df, "o_orderpriority", ["-v", "o_orderkey"], "n", "place", "level",
                             rank_order=["-v"], **kw)
    df = W.with_rank_columns(df, [], ["v", "o_orderkey"], "n_up", **kw)
    return df.select("o_orderkey", "n", "place", "level", "n_up")


@query("win_rough_ranks", _ROUGH_RANKS)
def win_rough_ranks(spark, sf):
    return _rough_ranks(spark, sf)


@query("win_rough_ranks_split", _ROUGH_RANKS)
def win_rough_ranks_split(spark, sf):
    return _rough_ranks(spark, sf, hot_rows=SPLIT_ROWS)


@query("win_text_order_split", f"""
SELECT o_orderkey, LAG(o_totalprice) OVER w AS above,
  CAST(SUM({PRICE}) OVER (ORDER BY o_clerk, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS so_far
FROM (SELECT *, 'Clerk#' || CAST(o_custkey % 40 AS VARCHAR) AS o_clerk FROM orders)
WINDOW w AS (ORDER BY o_clerk, o_orderkey)""")
def win_text_order_split(spark, sf):
    """A text order with heavy ties, split on all its order columns."""
    df = _orders(spark, sf, "o_totalprice", F.concat(
        F.lit("Clerk#"), (F.col("o_custkey") % 40).cast("string")).alias("o_clerk"))
    order = ["o_clerk", "o_orderkey"]
    df = W.with_running_sum(df, [], order, "o_totalprice", "so_far", scale=2, hot_rows=SPLIT_ROWS)
    return W.with_lag_lead(df, [], order, "o_totalprice", "above", hot_rows=SPLIT_ROWS).select(
        "o_orderkey", "above", "so_far")


#: DOUBLE amounts of very different size whose plain sums depend on the order of additions;
#: every seventh is missing.
MIXED = """CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 < 3 THEN o_totalprice * 1073741824
  WHEN o_orderkey % 7 < 5 THEN -o_totalprice * 1073741824 WHEN o_orderkey % 7 = 5 THEN o_totalprice / 1024
  ELSE o_totalprice END"""


def _nearest(total: str) -> str:
    """The double nearest to an integer (ties to even), over 2**62, in HUGEINT arithmetic."""
    size = f"abs({total})"
    cut = f"greatest(0, length(ltrim(bin({size}), '0')) - 53)"
    unit = f"(1::HUGEINT << ({cut})::INT)"
    head, rest = f"({size} // {unit})", f"({size} % {unit})"
    up = f"(CASE WHEN 2 * {rest} > {unit} OR (2 * {rest} = {unit} AND {head} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(sign({total}) * CAST({head} + {up} AS DOUBLE) * pow(2, {cut} - 62))"


#: Exact sums: the amounts are multiples of 2**-62, so whole numbers after scaling.
_DOUBLE_SUMS = f"""
SELECT o_orderkey, {_nearest('so_far')} AS so_far, {_nearest('in_priority')} AS in_priority,
  {_nearest('of_three')} / nullif(n_three, 0) AS mean_of_three, {_nearest('total')} AS total
FROM (
  SELECT o_orderkey, SUM(a) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS so_far,
    SUM(a) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS in_priority,
    SUM(a) OVER w AS of_three, COUNT(a) OVER w AS n_three, SUM(a) OVER () AS total
  FROM (SELECT o_orderkey, o_orderpriority, CAST(({MIXED}) * pow(2, 62) AS HUGEINT) AS a FROM orders)
  WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


def _double_sums(spark, sf, **kw):
    df = _orders(spark, sf, F.expr(MIXED).alias("amount"), "o_orderpriority")
    df = W.with_running_sum(df, [], ["o_orderkey"], "amount", "so_far", **kw)
    df = W.with_running_sum(df, "o_orderpriority", ["o_orderkey"], "amount", "in_priority", **kw)
    df = W.with_moving_avg(df, [], ["o_orderkey"], "amount", 2, "mean_of_three", **kw)
    df = W.with_total(df, "amount", "total")
    return df.select("o_orderkey", "so_far", "in_priority", "mean_of_three", "total")


@query("win_double_sums", _DOUBLE_SUMS)
def win_double_sums(spark, sf):
    return _double_sums(spark, sf)


@query("win_double_sums_split", _DOUBLE_SUMS)
def win_double_sums_split(spark, sf):
    """The same bits from ranges of a few hundred rows."""
    return _double_sums(spark, sf, hot_rows=SPLIT_ROWS)
