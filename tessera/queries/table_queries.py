"""Table mutation, layout, codecs and file sources (MUT, SNK, SRC) as read-back queries.

Each query copies a driver table into a fresh catalog table or folder under the
shared checkpoint folder, applies the operator, and returns what a reader then
sees.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import mutation as MU
from tessera.operators.aggregate import composite_count, keyed_sum
from tessera.operators.dedup import latest_per_key, removed_duplicates
from tessera.operators.joins import with_config
from tessera.queries.registry import query
from tessera.session import read_table, work_path
from tessera.sinks import layout as L
from tessera.sources import files as S


def _customer_table(spark, sf, partition_by=()):
    c = read_table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey",
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
    if partition_by:
        return L.save_partitioned_table(spark, c, "cust_copy", partition_by)
    name = f"cust_copy_{uuid.uuid4().hex[:10]}"
    c.write.option("path", work_path(spark, name)).saveAsTable(name)
    return name


_BAL = "CAST(c_acctbal AS DECIMAL(12,2))"


@query("update_where", f"""
SELECT c_custkey, c_mktsegment,
  CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN CAST({_BAL} * 1.10 AS DECIMAL(12,2)) ELSE {_BAL} END AS DOUBLE) AS c_acctbal
FROM customer""")
def update_where(spark, sf):
    """MUT-2: raise BUILDING balances by 10 %, kept at DECIMAL(12,2)."""
    t = _customer_table(spark, sf)
    MU.update_where(spark, t, F.col("c_mktsegment") == "BUILDING",
                    {"c_acctbal": F.col("c_acctbal") * F.lit(1.10).cast("decimal(3,2)")})
    return spark.table(t).select("c_custkey", "c_mktsegment",
                                 F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("update_partitioned", f"""
SELECT c_custkey, c_nationkey,
  CAST(CASE WHEN c_nationkey = 3 AND c_acctbal < 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE {_BAL} END AS DOUBLE) AS c_acctbal
FROM customer""")
def update_partitioned(spark, sf):
    """MUT-2 on a partitioned table: only the touched partition is rewritten."""
    t = _customer_table(spark, sf, ["c_nationkey"])
    MU.update_where(spark, t, (F.col("c_nationkey") == 3) & (F.col("c_acctbal") < 0),
                    {"c_acctbal": F.lit(0)})
    return spark.table(t).select("c_custkey", "c_nationkey",
                                 F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("delete_where", f"""
SELECT c_custkey, c_name, CAST({_BAL} AS DOUBLE) AS c_acctbal FROM customer WHERE NOT (c_acctbal < 0)""")
def delete_where(spark, sf):
    """MUT-3: delete customers with a negative balance."""
    t = _customer_table(spark, sf)
    MU.delete_where(spark, t, "c_acctbal < 0")
    return spark.table(t).select("c_custkey", "c_name",
                                 F.col("c_acctbal").cast("double").alias("c_acctbal"))


@query("upsert", f"""
WITH changes AS (
  SELECT o_custkey AS c_custkey, max(o_totalprice) AS top FROM orders
  WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey)
SELECT c.c_custkey,
  CAST(COALESCE(CAST(CAST(ch.top AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)), {_BAL}) AS DOUBLE) AS c_acctbal,
  CASE WHEN ch.c_custkey IS NULL THEN c_mktsegment ELSE 'UPDATED' END AS c_mktsegment
FROM customer c LEFT JOIN changes ch ON c.c_custkey = ch.c_custkey""")
def upsert(spark, sf):
    """MUT-5: MERGE new balances for customers with orders since 2001."""
    t = _customer_table(spark, sf)
    o = read_table(spark, sf, "orders").filter(
        F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    cur = spark.table(t)
    top = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"))
    changes = (cur.join(top, "c_custkey")
               .withColumn("c_acctbal", (F.col("top").cast("decimal(18,2)")
                                           * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(12,2)"))
               .withColumn("c_mktsegment", F.lit("UPDATED")).drop("top"))
    MU.upsert(spark, t, changes, ["c_custkey"])
    return spark.table(t).select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"),
                                 "c_mktsegment")


@query("insert_truncate", """
SELECT 'after_insert' AS step, 2 * COUNT(*) AS records FROM customer
UNION ALL SELECT 'after_truncate', 0""")
def insert_truncate(spark, sf):
    """MUT-1 / MUT-4: INSERT the rows again, count; TRUNCATE, count."""
    t = _customer_table(spark, sf)
    MU.insert_rows(spark.read.parquet(L.write_layer(
        spark.table(t), work_path(spark, "ins"))), t)
    n1 = spark.table(t).agg(F.count(F.lit(1)).alias("records")).withColumn("step", F.lit("after_insert"))
    n1 = spark.read.parquet(L.write_layer(n1, work_path(spark, "count")))
    MU.truncate(spark, t)
    n2 = spark.table(t).agg(F.count(F.lit(1)).alias("records")).withColumn("step", F.lit("after_truncate"))
    return n1.unionByName(n2).select("step", "records")


@query("partitioned_roundtrip", """
SELECT o_orderpriority, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY o_orderpriority""")
def partitioned_roundtrip(spark, sf):
    """SNK-7 / SNK-11: orders laid out by priority (ORC), read back with a partition
    filter that prunes the other partitions."""
    path = work_path(spark, "orders_by_priority")
    L.write_layer(read_table(spark, sf, "orders"), path, "orc", partition_by=["o_orderpriority"],
                  codec="zlib")
    df = S.read_layer(spark, path, "orc").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return df.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))


@query("dynamic_partition_overwrite", """
SELECT o_orderstatus, COUNT(*) AS orders FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1
UNION ALL SELECT 'P', COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""")
def dynamic_partition_overwrite(spark, sf):
    """SNK-7 / SNK-12 / SNK-14: replace one partition only (INSERT OVERWRITE … dynamic)."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    t = L.save_partitioned_table(spark, o, "orders_by_status", ["o_orderstatus"])
    replacement = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    staged = spark.read.parquet(L.write_layer(replacement, work_path(spark, "stage")))
    L.insert_partitions(staged.select(*spark.table(t).columns), t)
    return spark.table(t).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query("show_partitions", """SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS partition FROM orders""")
def show_partitions(spark, sf):
    """SNK-7: partitions listed from the catalog."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    t = L.save_partitioned_table(spark, o, "orders_parts", ["o_orderstatus"])
    return spark.sql(f"SHOW PARTITIONS {t}")


@query("codec_roundtrip", """
SELECT codec, COUNT(*) AS lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity
FROM lineitem, (VALUES ('snappy'), ('gzip'), ('zstd'), ('uncompressed')) c(codec) GROUP BY codec""")
def codec_roundtrip(spark, sf):
    """SNK-9: the same rows written with four codecs read back identically
    (sizes per codec come from ``file_sizes``)."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    parts = []
    for codec in ("snappy", "gzip", "zstd", "uncompressed"):
        p = L.write_layer(li, work_path(spark, f"codec_{codec}"), "parquet", codec=codec)
        parts.append(spark.read.parquet(p).agg(F.count(F.lit(1)).alias("lines"),
                                               F.sum("l_quantity").cast("long").alias("quantity"))
                     .withColumn("codec", F.lit(codec)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("codec", "lines", "quantity")


@query("compaction", """
SELECT l_returnflag, COUNT(*) AS lines, CAST(SUM(l_quantity) AS BIGINT) AS quantity, true AS fewer_files
FROM lineitem GROUP BY 1""")
def compaction(spark, sf):
    """SNK-10: small files rewritten into files of about ``target_bytes``; rows unchanged."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    small = L.write_layer(li.repartition(64, "l_orderkey"), work_path(spark, "small_files"))
    out = L.compact(spark, small, target_bytes=256 << 10)
    before, after = (L.file_sizes(spark, p).first() for p in (small, out))
    fewer = after["files"] < before["files"] and after["files"] <= -(-before["bytes"] // (256 << 10))
    return spark.read.parquet(out).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"),
        F.lit(fewer).alias("fewer_files"))


@query("csv_quarantine", """
SELECT 'good' AS kind, COUNT(*) AS records FROM lineitem WHERE l_orderkey % 101 <> 0
UNION ALL SELECT 'bad', COUNT(*) FROM lineitem WHERE l_orderkey % 101 = 0""")
def csv_quarantine(spark, sf):
    """SRC-3 / 4 / 5: a quoted CSV where some lines carry a non-numeric quantity;
    typed read, bad lines quarantined with their raw text, none lost."""
    li = read_table(spark, sf, "lineitem")
    qty = F.when(F.col("l_orderkey") % 101 == 0, F.lit("n/a")).otherwise(
        F.col("l_quantity").cast("string"))
    text = li.select(F.concat_ws(";", F.col("l_orderkey").cast("string"),
                                 F.col("l_linenumber").cast("string"), qty,
                                 F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"')))
                     .alias("value"))
    path = work_path(spark, "quoted_csv")
    text.write.text(path)
    good, bad = S.read_delimited(
        spark, path, "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_returnflag STRING",
        sep=";", header=False, quote='"')
    g = good.agg(F.count(F.lit(1)).alias("records")).withColumn("kind", F.lit("good"))
    b = bad.agg(F.count(F.lit(1)).alias("records")).withColumn("kind", F.lit("bad"))
    return g.unionByName(b).select("kind", "records")


@query("csv_header_inference", """
SELECT c_mktsegment, COUNT(*) AS customers, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY 1""")
def csv_header_inference(spark, sf):
    """SRC-1 / SRC-2 / SNK-1: CSV with header written, read back with inferred types,
    and a headerless copy read with names supplied."""
    c = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    p1 = L.write_layer(c, work_path(spark, "csv_h"), "csv")
    inferred, _ = S.read_delimited(spark, p1, header=True, infer=True)
    p2 = L.write_layer(inferred, work_path(spark, "csv_nh"), "csv", header=False)
    named, _ = S.read_delimited(spark, p2, header=False, infer=True,
                                names=["c_custkey", "c_mktsegment", "c_acctbal"])
    return named.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"))


@query("json_lines_source", """
SELECT event_type, COUNT(*) AS events, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value,
       MIN(ts) AS first_ts
FROM events GROUP BY event_type""")
def json_lines_source(spark, sf):
    """SRC-7 / SNK-5: events written as JSON lines, read with an explicit schema."""
    e = read_table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    p = L.write_layer(e, work_path(spark, "events_json"), "json",
                      options={"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    back = S.read_json(spark, p, "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE")
    return back.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total_value"),
        F.min("ts").alias("first_ts"))


@query("text_lines_source", """
SELECT token, COUNT(*) AS count FROM (
  SELECT CASE WHEN len(string_split(line, ' ')) >= 4 THEN string_split(line, ' ')[4] END AS token
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE contains(line, 'License')) GROUP BY token""")
def text_lines_source(spark, sf):
    """SRC-6 / FLT-5 / AGG-12: documents written as text files, read back line by
    line with a glob, matching lines grouped by their 4th token."""
    d = read_table(spark, sf, "documents").select(F.col("text").alias("value"))
    p = work_path(spark, "doc_text")
    d.write.text(p)
    ln = S.read_lines(spark, f"{p}/part-*").filter(F.col("value").contains("License"))
    tok = ln.select(F.try_element_at(F.split("value", " "), F.lit(4)).alias("token"))
    return tok.groupBy("token").agg(F.count(F.lit(1)).alias("count"))


@query("provenance_columns", """
SELECT 'c_nationkey=' || c_nationkey AS folder, COUNT(*) AS records, true AS stamped FROM customer GROUP BY 1""")
def provenance_columns(spark, sf):
    """SRC-13: every row carries the file it came from and the time of reading."""
    path = L.write_layer(read_table(spark, sf, "customer"), work_path(spark, "by_nation"),
                         partition_by=["c_nationkey"])
    rows = S.with_provenance(S.read_layer(spark, path))
    age = F.unix_timestamp() - F.unix_timestamp("_ingestion_timestamp")
    return rows.groupBy(F.regexp_extract("_source_file", "(c_nationkey=[0-9]+)/[^/]+$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("records"), F.bool_and(F.abs(age) < 3600).alias("stamped"))


@query("errorifexists_sink", "SELECT n_nationkey, n_name FROM nation")
def errorifexists_sink(spark, sf):
    """SNK-4: a write to an output folder that exists is refused and leaves it as it was."""
    n = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    p = L.write_layer(n, work_path(spark, "once"), mode="errorifexists")
    try:
        L.write_layer(n.filter("n_nationkey < 3"), p, mode="errorifexists")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError("the second write was accepted")
    return spark.read.parquet(p)


@query("ranked_json_report", f"""
SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag <> 'R'
GROUP BY 1 ORDER BY quantity DESC, l_partkey LIMIT 20""")
def ranked_json_report(spark, sf):
    """SNK-5: a ranked aggregate written as JSON and read back with its schema."""
    li = read_table(spark, sf, "lineitem").filter("l_returnflag <> 'R'")
    ranked = keyed_sum(li, "l_partkey", "l_quantity", "quantity").limit(20)
    path = L.write_layer(ranked.withColumn("quantity", F.col("quantity").cast("long")),
                         work_path(spark, "ranked"), "json")
    return S.read_json(spark, path, "l_partkey BIGINT, quantity BIGINT")


@query("json_config_file", f"""
SELECT c_custkey, CAST(CAST(7500 AS DECIMAL(18,2)) - {_BAL} AS DOUBLE) AS pending,
  c_acctbal < 100 AS below FROM customer""")
def json_config_file(spark, sf):
    """SRC-8 / JON-10: one multi-line JSON document read as configuration and attached to rows."""
    path = work_path(spark, "config")
    # one nation per document would be several rows; the first gives a one-document folder
    doc = read_table(spark, sf, "nation").filter("n_nationkey = 0").select(F.lit(
        '{\n "fee": 7500,\n "limits": {\n  "warning": 100\n }\n}').alias("value"))
    doc.write.text(path)
    config = S.read_json(spark, path, "fee DECIMAL(18,2), limits STRUCT<warning: INT>", multiline=True)
    rows = with_config(read_table(spark, sf, "customer").select("c_custkey", "c_acctbal"), config)
    return rows.select("c_custkey", (F.col("fee") - F.col("c_acctbal").cast("decimal(12,2)")).cast("double")
                       .alias("pending"), (F.col("c_acctbal") < F.col("limits.warning")).alias("below"))


#: Lines of one file of the strict load: bounded text in a task, and few files.
FILE_LINES = 20_000


@query("csv_strict_rows", """
SELECT 'good' AS kind, COUNT(*) AS records, MAX('a;' || o_orderpriority) AS sample FROM orders
WHERE o_orderkey % 50 NOT IN (1, 2)
UNION ALL SELECT 'bad', COUNT(*), MAX(CASE WHEN o_orderkey % 50 = 1 THEN CAST(o_orderkey AS VARCHAR)
  ELSE o_orderkey || ';"x";1;2' END) FROM orders WHERE o_orderkey % 50 IN (1, 2)""")
def csv_strict_rows(spark, sf):
    """SRC-1 / 4 / 5: no schema given; several files with a header each, an escape character of
    its own, blank lines; short and long rows are quarantined with their raw text."""
    k = F.col("o_orderkey")
    line = (F.when(k % 50 == 1, k.cast("string")).when(k % 50 == 2, F.concat(k.cast("string"), F.lit(';"x";1;2')))
            .otherwise(F.concat(k.cast("string"), F.lit(';"a;'), "o_orderpriority", F.lit('~"q";'), k.cast("string"))))
    line = F.when(k % 50 == 3, F.concat(line, F.lit("\n"))).otherwise(line)
    path = work_path(spark, "strict_csv")
    o = read_table(spark, sf, "orders")
    for part in range(2):  # each writer puts the header on top of its single file
        # neighbouring rows of one input partition share a file, FILE_LINES at most
        rows = o.filter(k % 2 == part).select(line.alias("line"), F.floor(
            F.monotonically_increasing_id() / FILE_LINES).alias("file"))
        body = rows.groupBy("file").agg(F.concat_ws("\n", F.lit("id;note;again"), F.collect_list("line")).alias("value"))
        body.select("value").repartition(8).write.mode("append").option(
            "lineSep", "\n").option("maxRecordsPerFile", 1).text(path)
    good, bad = S.read_delimited(spark, path, sep=";", escape="~")
    g = good.agg(F.count(F.lit(1)).alias("records"), F.max(F.split("note", '"')[0]).alias("sample"))
    b = bad.agg(F.count(F.lit(1)).alias("records"), F.max("raw_record").alias("sample"))
    return g.withColumn("kind", F.lit("good")).unionByName(b.withColumn("kind", F.lit("bad")))


@query("csv_headers_by_name", """
SELECT o_orderkey AS id, o_orderpriority AS note, o_totalprice AS price, NULL AS raw_record FROM orders
WHERE o_orderkey % 4 < 2
UNION ALL SELECT NULL, NULL, NULL, o_orderkey || ',' || o_orderpriority FROM orders WHERE o_orderkey % 4 = 2
UNION ALL SELECT NULL, NULL, NULL, o_orderkey || ',' || o_totalprice || ',' || o_orderpriority || ',x'
FROM orders WHERE o_orderkey % 4 = 3""")
def csv_headers_by_name(spark, sf):
    """SRC-5: four kinds of files in one load: the columns in order, reordered, one too few, one
    unknown; the first two are read by name, all rows of the others are quarantined."""
    o = read_table(spark, sf, "orders").withColumn("part", F.col("o_orderkey") % 4)
    key, note, price = (F.col(c).cast("string") for c in ("o_orderkey", "o_orderpriority", "o_totalprice"))
    kinds = [{"id": key, "note": note, "price": price}, {"price": price, "id": key, "note": note},
             {"id": key, "note": note}, {"id": key, "price": price, "note": note, "extra": F.lit("x")}]
    path = work_path(spark, "headers")
    for part, columns in enumerate(kinds):
        (o.filter(F.col("part") == part).select(*[c.alias(n) for n, c in columns.items()])
         .write.mode("append").option("header", True).csv(path))
    good, bad = S.read_delimited(spark, path, "id LONG, note STRING, price DOUBLE")
    return (good.withColumn("raw_record", F.lit(None).cast("string"))
            .unionByName(bad.select("raw_record"), allowMissingColumns=True))


@query("retail_items", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'ORDER' WHEN 1 THEN 'RETURN' ELSE 'UNKNOWN' END AS kind,
  strftime(o_orderdate, '%Y') AS year, 'C' || (o_custkey % 9) AS city, unnest(['pen', 'ink', 'pad']) AS item FROM orders""")
def retail_items(spark, sf):
    """STR-12: codes, store parts and item lists of a retail feed, one row per item."""
    k = F.col("o_orderkey")
    prefix = F.when(k % 3 == 0, "ORD").when(k % 3 == 1, "RET").otherwise("ETC")
    feed = read_table(spark, sf, "orders").select(
        k.alias("id"), F.lit(" some NAME ").alias("name"), F.lit(" A@B.example ").alias("mail"),
        F.concat(prefix, F.lit("-"), F.date_format("o_orderdate", "yyyy"), F.lit("-7")).alias("code"),
        F.lit("pen , ink,pad").alias("items"),
        F.concat(F.lit("ST-C"), (F.col("o_custkey") % 9).cast("string"), F.lit("-1")).alias("store"))
    out = T.retail_clean(feed, "id", "name", "mail", "code", "items", "store")
    return out.select(F.col("id").alias("o_orderkey"), F.col("TransactionType").alias("kind"),
                      F.col("OrderYear").alias("year"), F.col("CityCode").alias("city"), F.col("Item").alias("item"))


# ---------------------------------------------------------------- mutation of partitioned tables

def _status_table(spark, sf, fmt="parquet", buckets=0):
    """Orders by status, one status as the null partition."""
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    name = f"status_{uuid.uuid4().hex[:10]}"
    w = o.write.format(fmt).option("path", work_path(spark, name)).partitionBy("status")
    if buckets:
        w = w.bucketBy(buckets, "o_orderkey").sortBy("o_orderkey")
    w.saveAsTable(name)
    return name


def _per_status(spark, table):
    return spark.table(table).groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("price").cast("double").alias("price"))


_STATUS = "CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END"
_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


@query("delete_empties_partition", f"""
SELECT {_STATUS} AS status, COUNT(*) AS orders, CAST(SUM({_PRICE}) AS DOUBLE) AS price FROM orders
WHERE NOT (o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0)) GROUP BY 1""")
def delete_empties_partition(spark, sf):
    """MUT-3: a delete that empties one partition and halves the null one."""
    t = _status_table(spark, sf)
    MU.delete_where(spark, t, "status = 'F' OR (status IS NULL AND o_orderkey % 2 = 0)")
    return _per_status(spark, t)


@query("update_moves_partition", f"""
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'X' WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  COUNT(*) AS orders, CAST(SUM(CASE WHEN o_orderkey % 3 = 0 THEN {_PRICE} + 1 ELSE {_PRICE} END) AS DOUBLE) AS price
FROM orders GROUP BY 1""")
def update_moves_partition(spark, sf):
    """MUT-2: rows leave every partition, the null one too, for a new one."""
    t = _status_table(spark, sf)
    MU.update_where(spark, t, "o_orderkey % 3 = 0", {"status": F.lit("X"), "price": F.col("price") + 1})
    return _per_status(spark, t)


@query("update_orc_bucketed", f"""
SELECT {_STATUS} AS status, COUNT(*) AS orders,
  CAST(SUM(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE {_PRICE} END) AS DOUBLE) AS price
FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1""")
def update_orc_bucketed(spark, sf):
    """MUT-2 / MUT-3 on a partitioned, bucketed ORC table; its layout stays."""
    t = _status_table(spark, sf, "orc", 4)
    MU.update_where(spark, t, "o_orderkey % 5 = 0", {"price": F.lit(0)})
    MU.delete_where(spark, t, "o_orderkey % 7 = 0")
    layout = MU.table_layout(spark, t)
    if (layout["provider"].lower(), layout["buckets"]) != ("orc", 4):
        raise AssertionError(f"layout changed: {layout}")
    return _per_status(spark, t)


@query("merge_moves_partition", f"""
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'M' WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  COUNT(*) AS orders, CAST(SUM(CASE WHEN o_orderkey % 4 = 0 THEN 10 ELSE {_PRICE} END) AS DOUBLE) AS price
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
      UNION ALL SELECT -4 * (n_nationkey + 1), 'M', 0 FROM nation) GROUP BY 1""")
def merge_moves_partition(spark, sf):
    """MUT-5: changes that move rows to another partition, and new keys."""
    t = _status_table(spark, sf)
    old = read_table(spark, sf, "orders").filter("o_orderkey % 4 = 0").select("o_orderkey")
    new = read_table(spark, sf, "nation").select((-4 * (F.col("n_nationkey") + 1)).cast("long").alias("o_orderkey"))
    changes = old.unionByName(new).withColumns({"price": F.lit(10).cast("decimal(18,2)"), "status": F.lit("M")})
    MU.upsert(spark, t, changes, ["o_orderkey"])
    return _per_status(spark, t)


@query("catalog_statements", """
SELECT 'comment' AS fact, 'orders copy' AS value UNION ALL SELECT 'layer', 'silver'
UNION ALL SELECT 'rows', CAST(COUNT(*) AS VARCHAR) FROM orders""")
def catalog_statements(spark, sf):
    """MUT-6 / MUT-7: database and table statements, read back from the catalog."""
    db = f"db_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {db} COMMENT 'orders copy' LOCATION '{work_path(spark, db)}'")
    read_table(spark, sf, "orders").write.option("path", work_path(spark, "copy")).saveAsTable(f"{db}.copy")
    spark.sql(f"ALTER TABLE {db}.copy SET TBLPROPERTIES ('layer' = 'silver')")
    comment = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Comment'").select(
        F.lit("comment").alias("fact"), F.col("info_value").alias("value"))
    layer = spark.sql(f"SHOW TBLPROPERTIES {db}.copy").filter("key = 'layer'").select(F.col("key").alias("fact"), "value")
    n = spark.table(f"{db}.copy").agg(F.lit("rows").alias("fact"), F.count(F.lit(1)).cast("string").alias("value"))
    return comment.unionByName(layer).unionByName(n)


@query("column_statistics", """
SELECT 'o_custkey' AS "column", CAST(MIN(o_custkey) AS VARCHAR) AS min, CAST(MAX(o_custkey) AS VARCHAR) AS max,
  '0' AS num_nulls FROM orders""")
def column_statistics(spark, sf):
    """MUT-8: ANALYZE TABLE, its column statistics read from the catalog."""
    name = f"stats_{uuid.uuid4().hex[:10]}"
    read_table(spark, sf, "orders").select("o_custkey").write.option(
        "path", work_path(spark, name)).saveAsTable(name)
    return MU.analyze(spark, name, ["o_custkey"]).select("column", "min", "max", "num_nulls")


@query("composite_key_nulls", """
SELECT coalesce(a, '') || '_' || coalesce(b, '') AS key, COUNT(*) AS count FROM (
  SELECT CASE o_orderkey % 4 WHEN 0 THEN 'x_y' WHEN 1 THEN 'x' WHEN 2 THEN NULL ELSE 'x' END AS a,
         CASE o_orderkey % 4 WHEN 0 THEN 'z' WHEN 1 THEN 'y_z' WHEN 2 THEN 'x' END AS b FROM orders) GROUP BY a, b""")
def composite_key_nulls(spark, sf):
    """AGG-11: keys whose texts coincide, and nulls, stay apart."""
    m = F.col("o_orderkey") % 4
    df = read_table(spark, sf, "orders").select(
        F.when(m == 0, "x_y").when(m == 1, "x").when(m == 3, "x").alias("a"),
        F.when(m == 0, "z").when(m == 1, "y_z").when(m == 2, "x").alias("b"))
    return composite_count(df, ["a", "b"])


@query("dedup_null_identity", """
SELECT o_orderkey, who FROM (SELECT o_orderkey, CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 50 END AS who FROM orders)
QUALIFY ROW_NUMBER() OVER (PARTITION BY who ORDER BY o_orderkey) > 1""")
def dedup_null_identity(spark, sf):
    """DED-2 / DED-3 with null keys and a descending order: the kept row is not also removed."""
    df = read_table(spark, sf, "orders").select("o_orderkey", F.when(
        F.col("o_custkey") % 5 > 0, F.col("o_custkey") % 50).alias("who"))
    kept = latest_per_key(df, "who", ["-o_orderkey"])
    return removed_duplicates(df, kept, ["who", "o_orderkey"])


@query("latest_text_descending", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderdate, o_orderkey DESC) = 1""")
def latest_text_descending(spark, sf):
    """WIN-16: the preferred row by a text and a date in descending entries."""
    o = read_table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return latest_per_key(o, "o_custkey", ["-o_orderpriority", "-o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("summary_refresh", """
SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, COUNT(*) AS lines,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM lineitem WHERE year(l_shipdate) = 1996 OR l_returnflag <> 'R' GROUP BY 1""")
def summary_refresh(spark, sf):
    """SNK-14: a monthly summary table kept instead of a materialised view.  It is
    first built without returned lines, then the 1996 partitions are refreshed
    from the full data; other months are left untouched."""
    li = read_table(spark, sf, "lineitem")

    def summary(df):
        return (df.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("ship_month"))
                .agg(F.count(F.lit(1)).alias("lines"),
                     F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue")))
    path = work_path(spark, "monthly_summary")
    L.refresh_summary(spark, summary(li.filter(F.col("l_returnflag") != "R")), path, ["ship_month"])
    L.refresh_summary(spark, summary(li.filter(F.year("l_shipdate") == 1996)), path, ["ship_month"])
    out = spark.read.parquet(path)
    return out.select("ship_month", "lines", F.col("revenue").cast("double").alias("revenue"))


_PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"


@query("summary_increment", f"""
WITH base AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS priority, {_PRICE} AS price FROM orders),
after AS (
  SELECT month, priority, price FROM base WHERE o_orderkey % 13 <> 0 AND month <> '1995-03'
  UNION ALL SELECT '1996-01', priority, CASE WHEN o_orderkey % 2 = 0 THEN -price END FROM base WHERE o_orderkey % 17 = 0
  UNION ALL SELECT '2001-01', 'new', price FROM base WHERE o_orderkey % 19 = 0)
SELECT month, priority, COUNT(*) AS n, CAST(SUM(price) AS DOUBLE) AS sum_price, COUNT(price) AS count_price,
  CAST(MIN(price) AS DOUBLE) AS min_price, CAST(MAX(price) AS DOUBLE) AS max_price FROM after GROUP BY month, priority""")
def summary_increment(spark, sf):
    """SNK-14: orders per month and priority kept up through two batches, one that deletes (with a
    whole month) and inserts, one that inserts into a new month; equal to a rebuild."""
    from tessera.operators.summaries import apply_changes, create_summary
    base = read_table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    keys, columns, k = ["month", "priority"], ["month", "priority", "price"], F.col("o_orderkey")
    table = create_summary(spark, base, "order_summary", keys, ["price"], ["month"])
    goes = (k % 13 == 0) | (F.col("month") == "1995-03")
    first = base.filter(k % 17 == 0).select(F.lit("1996-01").alias("month"), "priority",
                                            F.when(k % 2 == 0, -F.col("price")).cast("decimal(18,2)").alias("price"))
    then = base.filter(k % 19 == 0).select(F.lit("2001-01").alias("month"), F.lit("new").alias("priority"), "price")
    now = base.filter(~goes).select(*columns).unionByName(first)
    apply_changes(spark, table, now, first, base.filter(goes).select(*columns), keys, ["price"])
    apply_changes(spark, table, now.unionByName(then), then, then.limit(0), keys, ["price"])
    return spark.table(table).select(*keys, "n", "count_price", *[
        F.col(f"{s}_price").cast("double").alias(f"{s}_price") for s in ("sum", "min", "max")])
