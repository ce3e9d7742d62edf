"""Medallion flow and data-quality queries (DQ-1..7, PRJ-4, SNK-1/3).

The raw customer feed is derived from the driver tables by Spark: one record
per order carrying its customer (so a customer id repeats), with messy text,
four date formats and injected faults (missing ids and names, null and
malformed e-mails, unparsable dates, blank countries).  The flow then runs
exactly as a user would run it: CSV feed → Bronze CSV → Silver parquet →
Gold reports, each layer read back from storage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import sql_percent
from tessera.operators import medallion as M
from tessera.operators.aggregate import layer_count_rows, layer_counts
from tessera.operators.joins import join_dim
from tessera.operators.quality import (REASON, REASONS, apply_rules, check, reconcile, reconcile_counts,
                                       unique_check)
from tessera.plans.facts import plan_facts
from tessera.queries.registry import query
from tessera.session import read_table, tuned, work_path
from tessera.sinks.layout import remove_layers, write_layer


def raw_customer_feed(spark, sf):
    o = read_table(spark, sf, "orders")
    c = read_table(spark, sf, "customer")
    n = read_table(spark, sf, "nation")
    r = read_table(spark, sf, "region")
    j = o.join(c, o.o_custkey == c.c_custkey)
    j = join_dim(j, n, j.c_nationkey == n.n_nationkey)
    j = join_dim(j, r, j.n_regionkey == r.r_regionkey)
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    null = F.lit(None).cast("string")
    return j.select(
        k.alias("Index"),
        F.when(k % 211 == 0, F.lit(None).cast("long")).otherwise(F.col("c_custkey"))
         .alias("Customer Id"),
        F.when(k % 307 == 0, null).when(k % 3 == 0, F.lit("  customer "))
         .when(k % 3 == 1, F.lit("CUSTOMER")).otherwise(F.lit("Customer")).alias("First Name"),
        F.when(k % 401 == 0, null).when(F.col("o_orderstatus") == "F", F.lit("fulfilled"))
         .when(F.col("o_orderstatus") == "O", F.lit("OPEN")).otherwise(F.lit(" Partial "))
         .alias("Last Name"),
        F.col("c_mktsegment").alias("Company"),
        F.lower("n_name").alias("City"),
        F.when(F.col("c_nationkey") == 7, null).otherwise(F.col("r_name")).alias("Country"),
        F.concat(F.lit("+1 ("), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"), F.lit(") "),
                 F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("-"),
                 F.lpad((k % 10000).cast("string"), 4, "0")).alias("Phone 1"),
        F.concat(F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("."),
                 F.lpad((k % 10000).cast("string"), 4, "0")).alias("Phone 2"),
        F.when(k % 97 == 0, null)
         .when(k % 89 == 0, F.concat(F.lit("customer"), F.col("c_custkey").cast("string"),
                                     F.lit(".example.com")))
         .otherwise(F.concat(F.lit(" Customer"), F.col("c_custkey").cast("string"), F.lit("@Mail"),
                             (F.col("c_nationkey") % 4).cast("string"), F.lit(".Example.com")))
         .alias("Email"),
        F.when(k % 173 == 0, F.lit("not a date"))
         .when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd"))
         .when(k % 4 == 1, F.date_format(d, "dd-MM-yyyy"))
         .when(k % 4 == 2, F.date_format(d, "MM/dd/yyyy"))
         .otherwise(F.date_format(d, "dd/MM/yyyy")).alias("Subscription Date"),
        F.concat(F.lit("https://www.example.com/c/"), F.col("c_custkey").cast("string"))
         .alias("Website"))


def run_medallion(spark, sf, gold: bool = False) -> dict[str, str]:
    """Write the feed and the layers a query needs; return their paths."""
    base = work_path(spark, "medallion")
    paths = {name: f"{base}/{name}" for name in ("source", "bronze", "silver", "rejected", "duplicates", "gold")}
    write_layer(raw_customer_feed(spark, sf), paths["source"], "csv")
    M.customer_bronze(spark, paths["source"], paths["bronze"])
    M.customer_silver(spark, paths["bronze"], paths["silver"], paths["rejected"], paths["duplicates"])
    if gold:
        M.customer_gold(spark, paths["silver"], paths["gold"])
    return paths


def _gold(spark, sf, name):
    p = run_medallion(spark, sf, gold=True)
    return spark.read.parquet(f"{p['gold']}/{name}").drop("_gold_processed_timestamp")


_INITCAP_REGION = ("array_to_string(list_transform(string_split(lower(r_name), ' '), "
                   "lambda w: upper(w[1]) || w[2:]), ' ')")
_DATE_TEXT = """CASE WHEN o_orderkey % 173 = 0 THEN 'not a date'
  WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%d-%m-%Y')
  WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%m/%d/%Y')
  ELSE strftime(o_orderdate, '%d/%m/%Y') END"""

SILVER_SQL = f"""
prepared AS (
  SELECT o_orderkey AS idx,
    CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderkey % 307 = 0 THEN NULL ELSE 'Customer' END AS first_name,
    CASE WHEN o_orderkey % 401 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Fulfilled'
         WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Partial' END AS last_name,
    c_mktsegment AS company,
    upper(n_name[1]) || lower(n_name[2:]) AS city,
    CASE WHEN c_nationkey = 7 THEN NULL ELSE {_INITCAP_REGION} END AS country,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 89 = 0 THEN 'customer' || c_custkey || '.example.com'
         ELSE 'customer' || c_custkey || '@mail' || (c_nationkey % 4) || '.example.com' END AS email,
    {_DATE_TEXT} AS date_text
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
parsed AS (
  SELECT *, COALESCE(CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE),
                     CAST(try_strptime(date_text, '%d-%m-%Y') AS DATE),
                     CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE),
                     CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE)) AS subscription_date,
    COALESCE(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}$'), false) AS email_ok
  FROM prepared),
validated AS (
  SELECT *, CASE
    WHEN customer_id IS NULL OR length(customer_id) = 0 THEN 'Missing customer ID'
    WHEN first_name IS NULL OR length(first_name) = 0 THEN 'Missing first name'
    WHEN last_name IS NULL OR length(last_name) = 0 THEN 'Missing last name'
    WHEN NOT email_ok THEN 'Invalid email'
    WHEN subscription_date IS NULL THEN 'Invalid subscription date'
    WHEN country IS NULL OR trim(country) = '' THEN 'Missing country' END AS reason
  FROM parsed),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY subscription_date DESC, idx DESC) AS rn
  FROM validated WHERE reason IS NULL),
silver AS (SELECT *, split_part(email, '@', 2) AS email_domain FROM ranked WHERE rn = 1)"""


_DISTINCT = {n: f"COUNT(DISTINCT {c}) AS {n}" for n, c in M.MEASURED.items()}
_DATES = "MIN(subscription_date) AS joined_first, MAX(subscription_date) AS joined_last"


def _share_sql(key: str, measures: str, where: str = "") -> str:
    return f"""WITH {SILVER_SQL},
r AS (SELECT {key}, {measures} FROM silver {where} GROUP BY {key})
SELECT r.*, {sql_percent("customers", "SUM(customers) OVER ()")} AS customers_pct FROM r"""


@query("medallion_country_report", _share_sql(
    "country", ", ".join([_DISTINCT["customers"], _DISTINCT["cities"], _DISTINCT["companies"], _DATES])))
def medallion_country_report(spark, sf):
    """The Gold report by country after the full Bronze → Silver → Gold flow, read back."""
    return _gold(spark, sf, "by_country")


@query("medallion_kpis", f"WITH {SILVER_SQL} SELECT {', '.join(_DISTINCT.values())}, {_DATES} FROM silver")
def medallion_kpis(spark, sf):
    return _gold(spark, sf, "totals")


@query("medallion_monthly", f"""WITH {SILVER_SQL}
SELECT strftime(subscription_date, '%Y-%m') AS joined_month, {_DISTINCT["customers"]}, {_DISTINCT["countries"]},
  {_DISTINCT["companies"]} FROM silver GROUP BY 1""")
def medallion_monthly(spark, sf):
    return _gold(spark, sf, "by_month")


@query("medallion_email_domains", _share_sql("email_domain", _DISTINCT["customers"], "WHERE trim(email_domain) <> ''"))
def medallion_email_domains(spark, sf):
    return _gold(spark, sf, "by_domain")


@query("dq_rejections", f"""WITH {SILVER_SQL}, g AS (
  SELECT reason, COUNT(*) AS records FROM validated WHERE reason IS NOT NULL GROUP BY reason)
SELECT reason, records, {sql_percent("records", "SUM(records) OVER ()")} AS percentage FROM g""")
def dq_rejections(spark, sf):
    """DQ-2 / DQ-4: rejected rows per first failing reason (from the rejected layer)."""
    p = run_medallion(spark, sf)
    return M.rejection_summary(spark.read.parquet(p["rejected"]))


@query("dq_all_reasons", f"""WITH {SILVER_SQL}, reasons AS (
  SELECT unnest(list_filter([
    CASE WHEN customer_id IS NULL OR length(customer_id) = 0 THEN 'Missing customer ID' END,
    CASE WHEN first_name IS NULL OR length(first_name) = 0 THEN 'Missing first name' END,
    CASE WHEN last_name IS NULL OR length(last_name) = 0 THEN 'Missing last name' END,
    CASE WHEN NOT email_ok THEN 'Invalid email' END,
    CASE WHEN subscription_date IS NULL THEN 'Invalid subscription date' END,
    CASE WHEN country IS NULL OR trim(country) = '' THEN 'Missing country' END], lambda x: x IS NOT NULL)) AS reason
  FROM parsed)
SELECT reason, COUNT(*) AS records FROM reasons GROUP BY reason""")
def dq_all_reasons(spark, sf):
    """DQ-3: every failing rule of every row, counted per rule."""
    p = run_medallion(spark, sf)
    rej = spark.read.parquet(p["rejected"])
    return (rej.select(F.explode(REASONS).alias("reason")).groupBy("reason")
            .agg(F.count(F.lit(1)).alias("records")))


@query("dq_reconcile", f"""WITH {SILVER_SQL}
SELECT (SELECT COUNT(*) FROM validated) AS input_records,
       (SELECT COUNT(*) FROM silver) AS valid_records,
       (SELECT COUNT(*) FROM validated WHERE reason IS NOT NULL) AS rejected_records,
       (SELECT COUNT(*) FROM ranked WHERE rn > 1) AS duplicate_records,
       true AS balanced""")
def dq_reconcile(spark, sf):
    """DQ-6: input = valid + rejected + removed duplicates, from the written layers."""
    p = run_medallion(spark, sf)
    bronze = spark.read.option("header", "true").csv(p["bronze"])
    return reconcile(bronze, spark.read.parquet(p["silver"]), spark.read.parquet(p["rejected"]),
                     spark.read.parquet(p["duplicates"]))


@query("dq_layer_counts", f"""WITH {SILVER_SQL}
SELECT 'bronze' AS layer, COUNT(*) AS records FROM validated
UNION ALL SELECT 'silver', COUNT(*) FROM silver
UNION ALL SELECT 'rejected', COUNT(*) FROM validated WHERE reason IS NOT NULL""")
def dq_layer_counts(spark, sf):
    """AGG-19 / SNK-1: record count per written layer (Bronze re-read from its CSV)."""
    p = run_medallion(spark, sf)
    return layer_counts(bronze=spark.read.option("header", "true").csv(p["bronze"]),
                        silver=spark.read.parquet(p["silver"]),
                        rejected=spark.read.parquet(p["rejected"]))


@query("dq_counted_writes", f"""WITH {SILVER_SQL}
SELECT (SELECT COUNT(*) FROM validated) AS input_records,
       (SELECT COUNT(*) FROM silver) AS valid_records,
       (SELECT COUNT(*) FROM validated WHERE reason IS NOT NULL) AS rejected_records,
       (SELECT COUNT(*) FROM ranked WHERE rn > 1) AS duplicate_records,
       true AS balanced, true AS same_when_read, true AS footers_only""")
def dq_counted_writes(spark, sf):
    """DQ-6 / SNK-1 / AGG-19: counts taken while the layers are written; reading back needs the
    files' footers only, and gives the same."""
    base = work_path(spark, "counted")
    paths = {name: f"{base}/{name}" for name in ("source", "bronze", "valid", "rejected", "duplicates")}
    write_layer(raw_customer_feed(spark, sf), paths["source"], "csv")
    M.customer_bronze(spark, paths["source"], paths["bronze"])
    silver = M.customer_silver(spark, paths["bronze"], paths["valid"], paths["rejected"], paths["duplicates"])
    layers = {name: spark.read.parquet(paths[name]) for name in ("valid", "rejected", "duplicates")}
    read = layer_counts(**layers)
    told = layer_count_rows(spark, {k: n for k, n in silver.counts.items() if k in layers})
    schemas = plan_facts(read).read_schemas
    return reconcile_counts(spark, silver.counts).withColumns({
        "same_when_read": F.lit(read.exceptAll(told).isEmpty() and told.exceptAll(read).isEmpty()),
        "footers_only": F.lit(len(schemas) == 3 and set(schemas) == {"struct<>"})})


@query("dq_checks", f"""WITH {SILVER_SQL},
r AS (SELECT country, COUNT(DISTINCT customer_id) AS customers FROM silver GROUP BY country),
p AS (SELECT {sql_percent("customers", "SUM(customers) OVER ()")} AS pct FROM r)
SELECT (SELECT COUNT(*) = COUNT(DISTINCT customer_id) FROM silver) AS unique_customer_id,
  (SELECT abs(SUM(pct) - 100) <= 0.5 FROM p) AS percentages_sum_to_100,
  (SELECT bool_and(typeof(subscription_date) = 'DATE') FROM silver) AS subscription_date_is_date,
  (SELECT COUNT(*) = COUNT(DISTINCT customer_id) FROM validated) AS unique_in_bronze""")
def dq_checks(spark, sf):
    """DQ-7: release checks over the layers, one boolean per check; the last one fails."""
    p = run_medallion(spark, sf, gold=True)
    silver, bronze = spark.read.parquet(p["silver"]), spark.read.option("header", "true").csv(p["bronze"])
    report = spark.read.parquet(f"{p['gold']}/by_country")
    one = lambda df, name, expr: check(df, {name: expr}).select(name).scalar()
    return check(silver, {"unique_customer_id": unique_check("customer_id")}).select("unique_customer_id").withColumns({
        "percentages_sum_to_100": one(report, "percentages_sum_to_100", F.abs(
            F.sum("customers_pct") - F.lit(100.0)) <= F.lit(0.5)),
        "subscription_date_is_date": F.lit(dict(silver.dtypes)["subscription_date"] == "date"),
        "unique_in_bronze": one(bronze, "unique_in_bronze", unique_check("Customer Id"))})


@query("dq_null_policy", f"""WITH {SILVER_SQL}
SELECT 'reject' AS null_policy, (SELECT COUNT(*) FROM validated WHERE reason IS NULL) AS valid_records,
       (SELECT COUNT(*) FROM validated WHERE reason IS NOT NULL) AS rejected_records
UNION ALL
SELECT 'drop', (SELECT COUNT(*) FROM validated WHERE reason IS NULL),
       (SELECT COUNT(*) FROM validated WHERE reason IS NOT NULL AND (email IS NOT NULL
          OR customer_id IS NULL OR length(customer_id) = 0 OR first_name IS NULL
          OR last_name IS NULL OR subscription_date IS NULL OR country IS NULL OR trim(country) = ''))""")
def dq_null_policy(spark, sf):
    """DQ-4 trap: with the notebook's three-valued rules a null e-mail leaves both
    outputs; the default policy rejects it instead."""
    p = run_medallion(spark, sf)
    bronze = spark.read.option("header", "true").csv(p["bronze"])
    prepared = M.cleaned(bronze)
    rows = []
    for policy in ("reject", "drop"):
        v = apply_rules(prepared, M.silver_rules(), policy)
        rows.append(v.agg(F.count_if(F.col("_is_valid_record") == F.lit(True)).alias("valid_records"),
                          F.count_if(F.col("_is_valid_record") == F.lit(False)).alias("rejected_records"))
                    .withColumn("null_policy", F.lit(policy)))
    return rows[0].unionByName(rows[1]).select("null_policy", "valid_records", "rejected_records")


@query("dq_split", f"""WITH {SILVER_SQL}
SELECT customer_id, first_name, last_name, country, city, company, email, email_domain,
       subscription_date FROM silver""")
def dq_split(spark, sf):
    """DQ-4 / DED-2: the Silver rows themselves (valid, latest per customer), read back."""
    p = run_medallion(spark, sf)
    return spark.read.parquet(p["silver"]).select(
        "customer_id", "first_name", "last_name", "country", "city", "company", "email",
        "email_domain", "subscription_date")


@query("dq_reasons", f"""WITH {SILVER_SQL}
SELECT CAST(idx AS BIGINT) AS index, reason FROM validated WHERE reason IS NOT NULL""")
def dq_reasons(spark, sf):
    """DQ-2: every rejected row with its first failing reason (rejected rows keep ``index``)."""
    p = run_medallion(spark, sf)
    return spark.read.parquet(p["rejected"]).select("index", F.col(REASON).alias("reason"))


#: What stands in the feed's Index column.
_FEEDS = {
    "numbered": lambda: F.col("Index"), "absent": lambda: None, "repeated": lambda: F.col("Index") % 3,
    "not a number": lambda: F.concat(F.lit("no "), F.col("Index").cast("string"))}


@query("silver_any_index", f"""WITH {SILVER_SQL},
valid AS (SELECT * FROM validated WHERE reason IS NULL)
SELECT feed, COUNT(*) AS input_records,
  (SELECT COUNT(DISTINCT customer_id) FROM valid) AS valid_records,
  COUNT(*) FILTER (reason IS NOT NULL) AS rejected_records,
  (SELECT COUNT(*) - COUNT(DISTINCT customer_id) FROM valid) AS duplicate_records, true AS balanced,
  (SELECT SUM(epoch(d) / 86400)::BIGINT FROM (SELECT max(subscription_date) AS d FROM valid GROUP BY customer_id)) AS days_kept
FROM validated, (VALUES {', '.join(f"('{name}')" for name in _FEEDS)}) feeds(feed) GROUP BY feed""")
def silver_any_index(spark, sf):
    """DED-3 / DQ-6: whatever the feed's index is, every row is kept, rejected or a removed copy.

    The feeds go through the layers one after the other; the layers of one are removed when its
    line of the result is written, so that the disk holds one feed's layers at a time, their CSV compressed."""
    spark, out = tuned(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}), []
    for name, make in _FEEDS.items():
        index = make()
        feed = raw_customer_feed(spark, sf)
        feed = feed.drop("Index") if index is None else feed.withColumn("Index", index)
        base = work_path(spark, "any_index")
        paths = {k: f"{base}/{k}" for k in ("source", "bronze", "silver", "rejected", "duplicates", "validated")}
        write_layer(feed, paths["source"], "csv", codec="lz4")
        M.customer_bronze(spark, paths["source"], paths["bronze"], codec="lz4")
        M.customer_silver(spark, paths["bronze"], paths["silver"], paths["rejected"], paths["duplicates"],
                          paths["validated"])
        layers = [spark.read.parquet(paths[k]) for k in ("silver", "rejected", "duplicates")]
        days = layers[0].agg(F.sum(F.unix_date("subscription_date")).cast("long")).scalar()
        line = (reconcile(spark.read.option("header", "true").csv(paths["bronze"]), *layers)
                .withColumns({"feed": F.lit(name), "days_kept": days}))
        out.append(spark.read.parquet(write_layer(line, work_path(spark, "any_index_line"))))
        remove_layers(spark, base)
    return reduce(DataFrame.unionByName, out)
