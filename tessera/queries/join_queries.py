"""Dimensional joins (JON-1..9) over lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.queries.registry import query
from tessera.session import read_table
from tessera.sinks.layout import save_bucketed

REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


def revenue():
    return F.col("l_extendedprice").cast("decimal(18,2)") * (
        F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))


def _ship_year(li, year: int):
    lo = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    hi = F.lit(f"{year}-12-31").cast("timestamp_ntz")
    return li.filter(F.col("l_shipdate").between(lo, hi))


@query("daily_city_category_revenue", f"""
SELECT CAST(l_shipdate AS DATE) AS ship_day, n_name AS city, p_type AS category,
       COUNT(*) AS lines, CAST(SUM({REVENUE}) AS DOUBLE) AS revenue
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey
WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'
GROUP BY 1, 2, 3""")
def daily_city_category_revenue(spark, sf):
    """JON-1 / JON-7 / REP-9: filter and project first, fact ⋈ dims, then group."""
    li = _ship_year(read_table(spark, sf, "lineitem"), 1997).select(
        "l_orderkey", "l_partkey", "l_shipdate", revenue().alias("rev"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    p = read_table(spark, sf, "part").select("p_partkey", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey)              # large × large: shuffle join
    j = J.join_dim(j, c, j.o_custkey == c.c_custkey)
    j = J.join_dim(j, n, j.c_nationkey == n.n_nationkey)
    j = J.join_dim(j, p, j.l_partkey == p.p_partkey)
    return j.groupBy(F.col("l_shipdate").cast("date").alias("ship_day"),
                     F.col("n_name").alias("city"), F.col("p_type").alias("category")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("rev").cast("double").alias("revenue"))


BRAND_SQL = f"""
SELECT p_brand, COUNT(*) AS lines, CAST(SUM({REVENUE}) AS DOUBLE) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_size <= 25 GROUP BY p_brand"""


@query("broadcast_join", BRAND_SQL)
def broadcast_join(spark, sf):
    """JON-2: the part dimension broadcast if its planned size in bytes is within the bound."""
    li = read_table(spark, sf, "lineitem").select("l_partkey", revenue().alias("rev"))
    p = read_table(spark, sf, "part").filter(F.col("p_size") <= 25).select("p_partkey", "p_brand")
    j = J.join_dim(li, p, li.l_partkey == p.p_partkey, strategy="broadcast")
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"),
                                    F.sum("rev").cast("double").alias("revenue"))


@query("salted_join", BRAND_SQL)
def salted_join(spark, sf):
    """JON-6: the same join with the fact's keys split over 8 salts (only keys with more than 20 lines here)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                  revenue().alias("rev"))
    p = read_table(spark, sf, "part").filter(F.col("p_size") <= 25).select(
        F.col("p_partkey").alias("l_partkey"), "p_brand")
    j = J.salted_join(li, p, ["l_partkey"], 8, ["l_orderkey", "l_linenumber"],
                      hot_rows=20)
    return j.groupBy("p_brand").agg(F.count(F.lit(1)).alias("lines"),
                                    F.sum("rev").cast("double").alias("revenue"))


@query("hot_path_join", BRAND_SQL)
def hot_path_join(spark, sf):
    """JON-6: the keys that a sketch finds hot (more than 40 lines here) meet a broadcast of their
    parts; all others are merged."""
    li = read_table(spark, sf, "lineitem").select("l_partkey", revenue().alias("rev"))
    p = read_table(spark, sf, "part").filter(F.col("p_size") <= 25).select(
        F.col("p_partkey").alias("l_partkey"), "p_brand")
    return J.hot_path_join(li, p, ["l_partkey"], hot_rows=40).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("rev").cast("double").alias("revenue"))


_KEYED = """(SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN NULL WHEN l_orderkey % 3 = 1 THEN l_orderkey % 5
  ELSE l_partkey END AS k FROM lineitem)"""


@query("hot_path_kinds", f"""
WITH f AS {_KEYED}, p AS (SELECT p_partkey AS k, p_size FROM part WHERE p_size <= 25)
SELECT 'inner' AS kind, COUNT(*) AS records, SUM(l_linenumber)::BIGINT AS lines, SUM(p_size)::BIGINT AS sizes
FROM f JOIN p ON f.k = p.k
UNION ALL SELECT 'left', COUNT(*), SUM(l_linenumber)::BIGINT, SUM(p_size)::BIGINT FROM f LEFT JOIN p ON f.k = p.k
UNION ALL SELECT 'left_semi', COUNT(*), SUM(l_linenumber)::BIGINT, NULL FROM f WHERE EXISTS (SELECT 1 FROM p WHERE p.k = f.k)
UNION ALL SELECT 'left_anti', COUNT(*), SUM(l_linenumber)::BIGINT, NULL FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k = f.k)""")
def hot_path_kinds(spark, sf):
    """JON-6: a third of the keys null, a third in five values, the rest spread; all join kinds."""
    k = F.col("l_orderkey")
    f = read_table(spark, sf, "lineitem").select("l_linenumber", F.when(k % 3 == 1, k % 5).when(
        k % 3 == 2, F.col("l_partkey")).alias("k"))
    p = read_table(spark, sf, "part").filter(F.col("p_size") <= 25).select(F.col("p_partkey").alias("k"), "p_size")
    out = []
    for kind in ("inner", "left", "left_semi", "left_anti"):
        j = J.hot_path_join(f, p, ["k"], kind, hot_rows=500)
        size = F.sum("p_size").cast("long") if "p_size" in j.columns else F.lit(None).cast("long")
        out.append(j.agg(F.count(F.lit(1)).alias("records"), F.sum("l_linenumber").cast("long").alias("lines"),
                         size.alias("sizes")).withColumn("kind", F.lit(kind)))
    return reduce(DataFrame.unionByName, out)


PRIORITY_SQL = f"""
SELECT o_orderpriority, COUNT(*) AS lines, COUNT(DISTINCT o_orderkey) AS orders,
       CAST(SUM({REVENUE}) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority"""


@query("merge_join", PRIORITY_SQL)
def merge_join(spark, sf):
    """JON-4: large × large, sort-merge join on the order key."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", revenue().alias("rev"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    j = J.join_dim(li, o, li.l_orderkey == o.o_orderkey, strategy="merge")
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"),
                                            F.countDistinct("o_orderkey").alias("orders"),
                                            F.sum("rev").cast("double").alias("revenue"))


@query("bucket_join", PRIORITY_SQL)
def bucket_join(spark, sf):
    """JON-3: both sides written bucketed (and sorted) by the order key, then joined
    without an exchange on either side."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", revenue().alias("rev"))
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lt = save_bucketed(spark, li.withColumnRenamed("l_orderkey", "orderkey"), "bj_lineitem",
                       ["orderkey"], buckets)
    ot = save_bucketed(spark, o.withColumnRenamed("o_orderkey", "orderkey"), "bj_orders",
                       ["orderkey"], buckets)
    j = J.join_dim(spark.table(lt), spark.table(ot), "orderkey", strategy="bucket")
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"),
                                            F.countDistinct("orderkey").alias("orders"),
                                            F.sum("rev").cast("double").alias("revenue"))


@query("preagg_join", f"""
SELECT p_type, CAST(l_shipdate AS DATE) AS ship_day, CAST(SUM(l_quantity) AS BIGINT) AS quantity,
       COUNT(*) AS lines
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2""")
def preagg_join(spark, sf):
    """JON-5: aggregate lineitem to (part, day) before joining the part dimension."""
    li = read_table(spark, sf, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("ship_day"), "l_quantity")
    p = read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    out = J.preagg_join(li, p, "l_partkey", ["ship_day"], ["p_type"],
                        {"quantity": F.sum("l_quantity"), "lines": F.count(F.lit(1))})
    return out.select("p_type", "ship_day", F.col("quantity").cast("long").alias("quantity"),
                      F.col("lines").cast("long").alias("lines"))


@query("star_join", f"""
SELECT n_name AS state, p_type AS category, COUNT(*) AS lines,
       CAST(SUM({REVENUE}) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2""")
def star_join(spark, sf):
    """JON-9: revenue by state (nation) and category (part type)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", revenue().alias("rev"))
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = read_table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    p = read_table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    j = li.join(o, "l_orderkey")
    j = J.star_join(j, [(c, "o_custkey"), (n, "c_nationkey"), (p, "l_partkey")])
    return j.groupBy(F.col("n_name").alias("state"), F.col("p_type").alias("category")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("rev").cast("double").alias("revenue"))


@query("top_segment_by_revenue", f"""
SELECT c_mktsegment AS segment, CAST(SUM({REVENUE}) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1 ORDER BY revenue DESC, segment LIMIT 1""")
def top_segment_by_revenue(spark, sf):
    """JON-9 (second part): the customer segment with the most revenue."""
    from tessera.operators.dedup import top_k
    li = read_table(spark, sf, "lineitem").select("l_orderkey", revenue().alias("rev"))
    o = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                 F.col("c_mktsegment").alias("segment"))
    j = J.join_dim(li.join(o, "l_orderkey"), c, "o_custkey")
    g = j.groupBy("segment").agg(F.sum("rev").alias("revenue"))
    return top_k(g, ["-revenue"], 1, tie_breaker=["segment"]).select(
        "segment", F.col("revenue").cast("double").alias("revenue"))


@query("orders_without_items", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def orders_without_items(spark, sf):
    """JON-8: left anti join."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               "o_orderdate")
    li = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.unmatched(o, li, "o_orderkey")
