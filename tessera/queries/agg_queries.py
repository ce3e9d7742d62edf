"""Keyed aggregation, word counts, string / date / JSON functions (AGG, FLT, STR, DAT, JSN)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import text as T
from tessera.functions.numeric import (exact_sum, round_money_avg, sql_exact_sum,
                                       sql_round_money_avg)
from tessera.operators import aggregate as A
from tessera.operators import wordcount as WC
from tessera.operators.aggregate import (count_distinct_states, count_sketch_states, distinct_states,
                                         sketch_states)
from tessera.operators.joins import join_dim, with_config
from tessera.plans.facts import plan_facts
from tessera.queries.registry import query
from tessera.session import read_table, work_path

# ----------------------------------------------------------------------------- word counts

@query("word_count", """
SELECT word, COUNT(*) AS count
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def word_count(spark, sf):
    """AGG-10: case-sensitive whitespace word count over whole documents."""
    return WC.word_count(read_table(spark, sf, "documents"), "text")


@query("word_count_lower", """
SELECT word, COUNT(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\r\\f]+')) AS word FROM conversations)
WHERE word <> '' GROUP BY word""")
def word_count_lower(spark, sf):
    """AGG-10 lower-case variant (per-batch stream rule) over conversation turns."""
    return WC.word_count(read_table(spark, sf, "conversations"), "text", lower=True)


@query("word_count_min_len", """
SELECT word, COUNT(*) AS count
FROM (SELECT unnest(regexp_split_to_array(lower(regexp_replace(text, '[^a-zA-Z0-9 ]', '', 'g')), '\\s+')) AS word
      FROM documents)
WHERE length(word) >= 4 GROUP BY word""")
def word_count_min_len(spark, sf):
    """AGG-10 / STM-4 rule: ASCII letters and digits only, lower-cased, length ≥ 4."""
    return WC.token_word_count(read_table(spark, sf, "documents"), "text", 4)


@query("grep_count", """
SELECT match, COUNT(*) AS count
FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS match
      FROM documents)
GROUP BY match""")
def grep_count(spark, sf):
    """FLT-10: every e-mail-shaped match in the documents, counted."""
    return WC.grep_count(read_table(spark, sf, "documents"), "text", T.EMAIL_PATTERN.strip("^$"))


@query("matching_lines_by_token", """
SELECT split_part_or_null AS token, COUNT(*) AS count FROM (
  SELECT CASE WHEN len(string_split(line, ' ')) >= 4 THEN string_split(line, ' ')[4] END
         AS split_part_or_null
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE contains(line, 'License'))
GROUP BY token""")
def matching_lines_by_token(spark, sf):
    """AGG-12 / FLT-5: lines containing ``License`` grouped by their 4th token."""
    return WC.token_count(read_table(spark, sf, "documents"), "text", "License", 4)


@query("composite_key_count", """
SELECT concat_ws('_', o_orderpriority, o_orderstatus) AS key, COUNT(*) AS count
FROM orders GROUP BY 1""")
def composite_key_count(spark, sf):
    """AGG-11: count per ``priority_status`` key."""
    return A.composite_count(read_table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("part_name_words", """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
GROUP BY word""")
def part_name_words(spark, sf):
    """STR-3 / STR-4: split + explode over part names, counted."""
    p = read_table(spark, sf, "part")
    return (p.select(F.explode(F.split("p_name", " ")).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


# ----------------------------------------------------------------------------- keyed aggregates

@query("filtered_key_sum", """
SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS total_quantity
FROM lineitem WHERE upper(trim(l_returnflag)) = 'R'
GROUP BY l_partkey ORDER BY total_quantity DESC, l_partkey""")
def filtered_key_sum(spark, sf):
    """AGG-13 / FLT-4: quantity per part over returned lines, ordered by (-qty, key)."""
    li = read_table(spark, sf, "lineitem")
    out = A.keyed_sum(li, "l_partkey", "l_quantity", "total_quantity",
                      where=T.text_equals("l_returnflag", "r"))
    return out.withColumn("total_quantity", F.col("total_quantity").cast("long"))


@query("orders_by_nation_summary", f"""
SELECT n_name AS nation, COUNT(*) AS orders, {sql_exact_sum("o_totalprice")} AS total_price,
       {sql_round_money_avg("o_totalprice")} AS avg_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name ORDER BY total_price DESC, nation""")
def orders_by_nation_summary(spark, sf):
    """AGG-1..4: count, exact sum and rounded average per group, ordered by the sum."""
    o = read_table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = join_dim(o, c, o.o_custkey == c.c_custkey)
    j = join_dim(j, n, j.c_nationkey == n.n_nationkey)
    return (j.groupBy(F.col("n_name").alias("nation"))
            .agg(F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("total_price"),
                 round_money_avg("o_totalprice").alias("avg_price"))
            .orderBy(F.desc("total_price"), "nation"))


@query("having_count", """
SELECT o_custkey, COUNT(*) AS orders FROM orders GROUP BY o_custkey HAVING COUNT(*) > 20""")
def having_count(spark, sf):
    """AGG-14: customers with more than 20 orders."""
    return A.group_having(read_table(spark, sf, "orders"), "o_custkey",
                          {"orders": F.count(F.lit(1))}, F.col("orders") > 20)


@query("status_breakdown", f"""
SELECT o_orderstatus, COUNT(*) AS orders, {sql_exact_sum("o_totalprice")} AS total_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'
GROUP BY o_orderstatus""")
def status_breakdown(spark, sf):
    """AGG-16: count and sum per status for one period (filter pushed to the scan)."""
    o = read_table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1996-02-01").cast("timestamp_ntz")))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"),
                                          exact_sum("o_totalprice").alias("total_price"))


@query("conditional_sum_by_day", """
SELECT CAST(l_shipdate AS DATE) AS ship_day,
  CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS returned_revenue,
  CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS open_revenue
FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
GROUP BY 1""")
def conditional_sum_by_day(spark, sf):
    """AGG-17 / FLT-2: returned and open revenue per ship day, one pass (BETWEEN inclusive)."""
    li = read_table(spark, sf, "lineitem").filter(F.col("l_shipdate").between(
        F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    out = A.conditional_sums(li, F.col("l_shipdate").cast("date").alias("ship_day"), price, {
        "returned_revenue": F.col("l_returnflag") == "R",
        "open_revenue": F.col("l_linestatus") == "O"})
    return out.select("ship_day", F.col("returned_revenue").cast("double"),
                      F.col("open_revenue").cast("double"))


@query("salted_key_sum", f"""
SELECT l_returnflag, {sql_exact_sum("l_extendedprice")} AS revenue FROM lineitem GROUP BY l_returnflag""")
def salted_key_sum(spark, sf):
    """Skew-proof keyed sum: 3 hot keys split over 16 salts, then re-summed (exact)."""
    li = read_table(spark, sf, "lineitem")
    out = A.salted_sum(li, "l_returnflag", F.col("l_extendedprice").cast("decimal(18,2)"),
                       "revenue", 16, ["l_orderkey", "l_linenumber"])
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query("pending_and_low", f"""
WITH cfg AS (SELECT 'TESSERA ACADEMY' AS academy_name, 'INR' AS currency,
                    75 AS attendance_warning_percent, CAST(5000 AS DECIMAL(18,2)) AS total_fee)
SELECT c_custkey AS id, c_name AS name,
       CAST(total_fee - CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS pending_fee,
       CAST(c_acctbal AS DECIMAL(18,2)) * 100 < total_fee * attendance_warning_percent AS below_warning,
       academy_name, currency
FROM customer, cfg WHERE total_fee - CAST(c_acctbal AS DECIMAL(18,2)) > 0""")
def pending_and_low(spark, sf):
    """AGG-18 / SRC-8 / JON-10: per-row rules driven by a one-row configuration."""
    cfg = spark.createDataFrame(
        [("TESSERA ACADEMY", "INR", 75, 5000)],
        "academy_name string, currency string, attendance_warning_percent int, total_fee int")
    cfg = cfg.withColumn("total_fee", F.col("total_fee").cast("decimal(18,2)"))
    c = read_table(spark, sf, "customer")
    return balance_report(c, cfg)


def balance_report(df, cfg):
    paid = F.col("c_acctbal").cast("decimal(18,2)")
    j = with_config(df, cfg)
    pending = F.col("total_fee") - paid
    return (j.filter(pending > 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        pending.cast("double").alias("pending_fee"),
        (paid * 100 < F.col("total_fee") * F.col("attendance_warning_percent")).alias("below_warning"),
        "academy_name", "currency"))


# ----------------------------------------------------------------------------- strings, dates, json

@query("string_suite", """
SELECT c_custkey,
  upper(c_name) AS name_upper, lower(c_name) AS name_lower,
  upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS segment_initcap,
  substr(c_name, 10, 9) AS name_digits, length(c_name) AS name_length,
  lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded_id,
  c_name || '/' || c_mktsegment AS name_segment, concat_ws('-', c_mktsegment, c_name) AS segment_name,
  string_split(c_name, '#')[2] AS split_second,
  regexp_extract(c_name, '#([0-9]+)', 1) AS extracted_digits,
  regexp_replace(c_name, '[^0-9]', '', 'g') AS digits_only,
  starts_with(c_name, 'Customer') AS starts_customer, suffix(c_name, '0') AS ends_zero,
  trim('  ' || c_mktsegment || '  ') AS trimmed,
  ltrim('  ' || c_mktsegment) AS ltrimmed, rtrim(c_mktsegment || '  ') AS rtrimmed,
  CASE WHEN c_acctbal < 0 THEN 'NEGATIVE' WHEN c_acctbal < 1000 THEN 'LOW' ELSE 'NORMAL' END AS balance_band
FROM customer""")
def string_suite(spark, sf):
    """STR-1..11, PRJ-6: the string functions over customer names and segments."""
    c = read_table(spark, sf, "customer")
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return c.select(
        "c_custkey",
        F.upper(name).alias("name_upper"), F.lower(name).alias("name_lower"),
        F.initcap(F.lower(seg)).alias("segment_initcap"),
        F.substring(name, 10, 9).alias("name_digits"), F.length(name).alias("name_length"),
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("padded_id"),
        F.concat(name, F.lit("/"), seg).alias("name_segment"),
        F.concat_ws("-", seg, name).alias("segment_name"),
        F.try_element_at(F.split(name, "#"), F.lit(2)).alias("split_second"),
        F.regexp_extract(name, "#([0-9]+)", 1).alias("extracted_digits"),
        F.regexp_replace(name, "[^0-9]", "").alias("digits_only"),
        name.startswith("Customer").alias("starts_customer"),
        name.endswith("0").alias("ends_zero"),
        F.trim(F.concat(F.lit("  "), seg, F.lit("  "))).alias("trimmed"),
        F.ltrim(F.concat(F.lit("  "), seg)).alias("ltrimmed"),
        F.rtrim(F.concat(seg, F.lit("  "))).alias("rtrimmed"),
        F.when(F.col("c_acctbal") < 0, "NEGATIVE").when(F.col("c_acctbal") < 1000, "LOW")
         .otherwise("NORMAL").alias("balance_band"))


_FORMATS_SQL = """CASE o_orderkey % 4
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y')
      WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE strftime(o_orderdate, '%d/%m/%Y') END"""


@query("date_suite", f"""
WITH s AS (SELECT o_orderkey, o_orderdate, {_FORMATS_SQL} AS date_text FROM orders)
SELECT o_orderkey, date_text,
  COALESCE(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE), CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE),
           CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE), CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE)) AS parsed_date,
  CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
  strftime(o_orderdate, '%Y-%m') AS order_year_month,
  strftime(o_orderdate, '%d-%m-%Y %I:%M %p') AS display_time,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) AS due_date
FROM s""")
def date_suite(spark, sf):
    """DAT-1..6: four textual date formats parsed back (first success wins), parts,
    labels, a strftime-style display format and date arithmetic."""
    o = read_table(spark, sf, "orders")
    d = F.col("o_orderdate")
    text = (F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
            .when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "dd-MM-yyyy"))
            .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "MM/dd/yyyy"))
            .otherwise(F.date_format(d, "dd/MM/yyyy")))
    s = o.select("o_orderkey", "o_orderdate", text.alias("date_text"))
    return s.select(
        "o_orderkey", "date_text", D.parse_date_multi("date_text").alias("parsed_date"),
        F.year(d).alias("order_year"), F.month(d).alias("order_month"),
        D.year_month(d).alias("order_year_month"),
        F.date_format(d, D.python_to_spark_format("%d-%m-%Y %I:%M %p")).alias("display_time"),
        F.date_add(d.cast("date"), 30).alias("due_date"))


@query("json_flatten", """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_flatten(spark, sf):
    """JSN-1: ``from_json`` with an explicit schema, then flatten the struct."""
    e = read_table(spark, sf, "events")
    parsed = e.select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", "event_type", "p.k")


@query("url_parts", """
SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
  CASE WHEN lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) IN ('gmail.com', 'yahoo.com', 'outlook.com')
       THEN 'Public' ELSE 'Business' END AS provider_type,
  starts_with(url, 'https://') AS is_secure
FROM pages""")
def url_parts(spark, sf):
    """STR-10 / STR-13 / STR-5: host name, provider class and scheme test per page."""
    p = read_table(spark, sf, "pages")
    host = T.url_host("url")
    return p.select("page_id", host.alias("host"), T.provider_type(host).alias("provider_type"),
                    F.col("url").startswith("https://").alias("is_secure"))


# ----------------------------------------------------------------------------- SQL API, dedup, top-k

_MODES = """
SELECT p.p_brand, l.l_returnflag, COUNT(*) AS lines, MAX(l.l_quantity) AS largest,
  CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
FROM {lineitem} l INNER JOIN {part} p ON p.p_partkey = l.l_partkey
WHERE l.l_quantity > 10 GROUP BY p.p_brand, l.l_returnflag"""


@query("sql_trip_summary", _MODES.format(lineitem="lineitem", part="part"))
def sql_trip_summary(spark, sf):
    """AGG-2..4 through the SQL API: several aggregates per group of two keys."""
    return spark.sql(_MODES, **{t: read_table(spark, sf, t) for t in ("lineitem", "part")})


@query("dedup_removed", """
SELECT o_orderkey, o_custkey, o_orderdate FROM (
  SELECT o_orderkey, o_custkey, o_orderdate,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn > 1""")
def dedup_removed(spark, sf):
    """DED-2 / DED-3: keep the latest order per customer; return the removed copies."""
    from tessera.operators.dedup import latest_per_key, removed_duplicates
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    kept = latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    return removed_duplicates(o, kept, ["o_custkey", "o_orderkey"])


@query("dedup_keys", "SELECT DISTINCT o_custkey FROM orders")
def dedup_keys(spark, sf):
    """DED-1: one arbitrary survivor per key (only the key is deterministic)."""
    from tessera.operators.dedup import drop_duplicates
    return drop_duplicates(read_table(spark, sf, "orders"), "o_custkey").select("o_custkey")


@query("topk_customers", f"""
SELECT o_custkey, {sql_exact_sum("o_totalprice")} AS total_spent FROM orders
GROUP BY o_custkey ORDER BY total_spent DESC, o_custkey LIMIT 3""")
def topk_customers(spark, sf):
    """SRT-5: top-3 customers by total, ties broken by key."""
    from tessera.operators.dedup import top_k
    o = read_table(spark, sf, "orders")
    g = o.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("t"))
    return top_k(g, ["-t"], 3, tie_breaker=["o_custkey"]).select(
        "o_custkey", F.col("t").cast("double").alias("total_spent"))


@query("dedup_latest", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def dedup_latest(spark, sf):
    """WIN-16 / DED-2: the latest order per customer (partial/final ``max_by``)."""
    from tessera.operators.dedup import latest_per_key
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate",
                                               "o_totalprice")
    return latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("error_lines_by_source", """
SELECT source, COUNT(*) AS lines FROM (
  SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE contains(line, 'License') GROUP BY source""")
def error_lines_by_source(spark, sf):
    """FLT-5 / AGG-12: matching lines counted per document source."""
    d = read_table(spark, sf, "documents")
    ln = d.select("source", F.explode(F.split("text", "\n")).alias("line"))
    return (ln.filter(F.col("line").contains("License")).groupBy("source")
            .agg(F.count(F.lit(1)).alias("lines")))


@query("mail_providers", """
SELECT c_custkey, CASE WHEN c_custkey % 5 < 3 THEN 'Public' ELSE 'Business' END AS provider_type FROM customer""")
def mail_providers(spark, sf):
    """STR-13: customers' mail domains in any case, three in five at a public provider."""
    names = F.array(*[F.lit(d) for d in ("Gmail.com", "yahoo.com", "OUTLOOK.COM", "example.org", "gmail.com.example")])
    domain = F.element_at(names, (F.col("c_custkey") % 5 + 1).cast("int"))
    return read_table(spark, sf, "customer").select("c_custkey", T.provider_type(domain).alias("provider_type"))


@query("pushed_filter_rows", """
SELECT o_orderkey, true AS filter_pushed, true AS other_columns_pruned FROM orders WHERE o_orderstatus = 'F'""")
def pushed_filter_rows(spark, sf):
    """MUT-9: the rows of a filtered scan, with what its own physical plan says about it."""
    rows = read_table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    facts = plan_facts(rows)
    return rows.withColumns({
        "filter_pushed": F.lit(any("o_orderstatus" in p for p in facts.pushed_filters)),
        "other_columns_pruned": F.lit(all("o_totalprice" not in s for s in facts.read_schemas))})


_GRAINS = [("day", "strftime(o_orderdate, '%Y-%m-%d')"), ("month", "strftime(o_orderdate, '%Y-%m')"), ("all", "'all'")]


def _stored_customers(spark, sf, make):
    """States per order day, written and read back: later counts never see the orders again."""
    days = make(read_table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_custkey"), ["day"], "o_custkey")
    path = work_path(spark, "distinct_states")
    days.write.parquet(path)
    return spark.read.parquet(path)


def _by_grain(states, count):
    frames = []
    for grain, period in (("day", F.col("day")), ("month", F.substring("day", 1, 7)), ("all", F.lit("all"))):
        frames.append(count(states.withColumn("period", period), ["period"], "customers")
                      .withColumn("grain", F.lit(grain)))
    return reduce(DataFrame.unionByName, frames)


@query("distinct_rollup", " UNION ALL ".join(
    f"SELECT '{g}' AS grain, {e} AS period, COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY 2"
    for g, e in _GRAINS))
def distinct_rollup(spark, sf):
    """AGG-6: exact distinct customers per day, month and in all from one table of day bitmaps."""
    return _by_grain(_stored_customers(spark, sf, distinct_states), count_distinct_states)


@query("distinct_rollup_approx", " UNION ALL ".join(
    f"SELECT '{g}' AS grain, COUNT(DISTINCT {e}) AS periods, true AS within_five_percent FROM orders"
    for g, e in _GRAINS))
def distinct_rollup_approx(spark, sf):
    """AGG-6, approximate mode: the same from stored sketches, held against the exact counts."""
    about = _by_grain(_stored_customers(spark, sf, sketch_states), count_sketch_states)
    exact = distinct_rollup(spark, sf).withColumnRenamed("customers", "exact")
    return about.join(exact, ["grain", "period"]).groupBy("grain").agg(
        F.count(F.lit(1)).alias("periods"),
        F.bool_and(F.abs(F.col("customers") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_five_percent"))
