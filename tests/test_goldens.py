"""Published and hand-derived answers from the course material (see FIXTURES.md)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import text as T
from tessera.functions.names import clean_name, standardize_columns
from tessera.operators import aggregate as A
from tessera.operators import mutation as MU
from tessera.operators import quality as Q
from tessera.operators import wordcount as WC
from tessera.session import work_path
from tessera.sources import files as S

# The inputs behind the answers that the course material publishes (see
# FIXTURES.md), here and in the tests below.  They must be these rows for the answers to hold.
RESTAURANT_CSV = """order_id,table_no,dish,quantity,status
O1001,T01,Vegetable Biryani,2,PAID
O1002,T02,Paneer Butter Masala,1,PAID
O1003,T01,Butter Naan,4,PAID
O1004,T03,Vegetable Biryani,3,PAID
O1005,T04,Masala Dosa,2,CANCELLED
O1006,T02,Butter Naan,3,PAID
O1007,T05,Paneer Butter Masala,2,PAID
O1008,T06,Vegetable Biryani,1,PAID
O1009,T03,Gulab Jamun,4,PAID
O1010,T07,Butter Naan,2,PAID
O1011,T08,Masala Dosa,3,PAID
O1012,T05,Gulab Jamun,2,PAID
O1013,T09,Vegetable Biryani,2,PENDING
O1014,T10,Paneer Butter Masala,1,PAID
O1015,T08,Butter Naan,1,PAID
O1016,T11,Masala Dosa,2,PAID
"""

TRIP_WORDS = """Chennai completed
Bangalore completed
Chennai completed
Hyderabad cancelled
Bangalore completed
Chennai completed
Hyderabad completed
Mumbai completed
Chennai completed
Bangalore cancelled
Mumbai completed
Hyderabad completed
"""


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_restaurant_dish_totals(spark, tmp_path):
    path = _write(tmp_path, "orders.csv", RESTAURANT_CSV + "O1017,T12,Broken line\n")
    good, bad = S.read_delimited(
        spark, path, "order_id STRING, table_no STRING, dish STRING, quantity INT, status STRING")
    assert bad.count() == 1                                    # quarantined, not lost
    out = A.keyed_sum(good, "dish", "quantity", "total_quantity",
                      where=T.text_equals("status", "paid"))
    assert [(r.dish, r.total_quantity) for r in out.collect()] == [
        ("Butter Naan", 10), ("Gulab Jamun", 6), ("Vegetable Biryani", 6),
        ("Masala Dosa", 5), ("Paneer Butter Masala", 4)]


def test_strict_read_fails_on_bad_row(spark, tmp_path):
    path = _write(tmp_path, "orders.csv", RESTAURANT_CSV + "O1017,T12,Broken line\n")
    df = S.read_delimited(spark, path, "order_id STRING, table_no STRING, dish STRING, "
                          "quantity INT, status STRING", on_bad="fail")
    with pytest.raises(Exception):
        df.collect()          # parsing the short row fails the job (a bare count parses nothing)


def test_word_count_goldens(spark, tmp_path):
    lines = S.read_lines(spark, _write(tmp_path, "words.txt", TRIP_WORDS))
    got = {r.word: r["count"] for r in WC.word_count(lines, "value").collect()}
    assert got == {"Chennai": 4, "Bangalore": 3, "Hyderabad": 3, "Mumbai": 2,
                   "completed": 10, "cancelled": 2}
    pairs = lines.select(F.split("value", " ").alias("p")).select(
        F.col("p")[0].alias("city"), F.col("p")[1].alias("status"))
    comp = {r.key: r["count"] for r in A.composite_count(pairs, ["city", "status"]).collect()}
    assert comp == {"Bangalore_cancelled": 1, "Bangalore_completed": 2, "Chennai_completed": 4,
                    "Hyderabad_cancelled": 1, "Hyderabad_completed": 2, "Mumbai_completed": 2}


def test_word_count_two_files(spark, tmp_path):
    d = tmp_path / "wc"
    d.mkdir()
    (d / "file1.txt").write_text("cat dog cat bird dog cat\n")
    (d / "file2.txt").write_text("bird bird fish cat dog\n")
    got = {r.word: r["count"] for r in WC.word_count(S.read_lines(spark, f"{d}/*.txt"),
                                                      "value").collect()}
    assert got == {"bird": 3, "cat": 4, "dog": 3, "fish": 1}


def test_word_count_variants(spark):
    df = spark.createDataFrame([("Data, data!  Spark's   DATA rocks",)], "t string")
    assert {r.word: r["count"] for r in WC.word_count(df, "t", lower=True).collect()} == {
        "data,": 1, "data!": 1, "spark's": 1, "data": 1, "rocks": 1}
    assert {r.word: r["count"] for r in WC.token_word_count(df, "t", 4).collect()} == {
        "data": 3, "sparks": 1, "rocks": 1}


def test_retail_clean(spark):
    data = [(1, "  arun kumar  ", "arun.kumar@gmail.com", "ORD-2026-1001", "mobile,charger,cable", "IN-CHN-001"),
            (2, "PRIYA SHARMA", "priya@company.com", "ORD-2026-1002", "laptop,mouse", "IN-BLR-002"),
            (3, "ravi reddy", "ravi_reddy@yahoo.com", "RET-2026-1003", "shirt,jeans,shoes", "IN-HYD-003"),
            (4, "  meena iyer", "meena@retail.org", "ORD-2026-1004", "tablet,cover", "IN-CBE-004")]
    df = spark.createDataFrame(data, ["CustomerID", "CustomerName", "Email", "OrderCode", "Items",
                                      "StoreCode"])
    out = T.retail_clean(df, "CustomerID", "CustomerName", "Email", "OrderCode", "Items", "StoreCode")
    rows = out.collect()
    assert len(rows) == 10
    by_id = {r.CustomerID: r for r in rows}
    assert {i: by_id[i].TransactionType for i in by_id} == {1: "ORDER", 2: "ORDER", 3: "RETURN",
                                                             4: "ORDER"}
    assert {r.OrderYear for r in rows} == {"2026"}
    assert [by_id[i].CityCode for i in (1, 2, 3, 4)] == ["CHN", "BLR", "HYD", "CBE"]
    assert [by_id[i].PaddedId for i in (1, 2, 3, 4)] == ["00001", "00002", "00003", "00004"]
    assert by_id[1].CustomerName == "Arun Kumar"


def test_scalar_behaviours(spark):
    df = spark.createDataFrame([("02/03/2024", "no-at-sign", "arun-kumar", "+91 (98) 765-4321")],
                               "d string, e string, n string, p string")
    r = df.select(D.parse_date_multi("d").alias("d"), T.email_domain("e").alias("dom"),
                  F.initcap("n").alias("n"), T.clean_phone("p").alias("p"),
                  F.lpad(F.lit("123456"), 4, "0").alias("lp"),
                  F.regexp_extract(F.lit("abc"), r"(\d+)", 1).alias("rx")).first()
    assert r.d == dt.date(2024, 2, 3)            # MM/dd wins: it is tried first
    assert r.dom is None                          # tolerant under ANSI
    assert r.n == "Arun-kumar"                    # initcap splits on spaces only
    assert r.p == "+91987654321"
    assert r.lp == "1234"                         # lpad truncates
    assert r.rx == ""                             # no match: empty string


def test_column_names():
    assert clean_name("Customer Id") == "customer_id"
    assert clean_name("Phone 1") == "phone_1"
    assert clean_name("  Subscription Date ") == "subscription_date"


def test_column_name_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Phone 1` int, `phone-1` int")
    with pytest.raises(ValueError):
        standardize_columns(df)


def test_null_email_trap(spark):
    df = spark.createDataFrame(
        [("1", "a@x.com"), ("2", "b@x.com"), ("3", None), ("4", "bad"), ("5", "c@x.com"),
         ("6", "d@x.com")], "id string, email string")
    rules = [("Missing id", F.col("id").isNotNull()),
             ("Invalid email", F.col("email").rlike(T.EMAIL_PATTERN))]
    v, r = Q.split_valid(Q.apply_rules(df, rules, null_policy="drop"))
    assert (v.count(), r.count()) == (4, 1)          # the notebook's form loses a row
    v, r = Q.split_valid(Q.apply_rules(df, rules))
    assert (v.count(), r.count()) == (4, 2)          # default: nothing is lost
    reasons = {x.id: x[Q.REASON] for x in r.collect()}
    assert reasons == {"3": "Invalid email", "4": "Invalid email"}


EMPLOYEES = [(101, "Asha", "Data Engineering", "75000.00", "2024-02-15", "ACTIVE"),
             (102, "Bharat", "Finance", "62000.00", "2023-08-10", "ACTIVE"),
             (103, "Charan", "Human Resources", "58000.00", "2022-11-01", "ACTIVE"),
             (104, "Divya", "Data Engineering", "81000.00", "2021-06-19", "ACTIVE"),
             (105, "Eshan", "Support", "45000.00", "2025-01-06", "INACTIVE"),
             (106, "Farah", "Finance", "69000.00", "2020-04-27", "ACTIVE")]


def test_employee_table_crud(spark):
    df = spark.createDataFrame(EMPLOYEES, "employee_id int, employee_name string, department string, "
                                          "salary string, joining_date string, employment_status string")
    df = df.withColumns({"salary": F.col("salary").cast("decimal(12,2)"),
                         "joining_date": F.to_date("joining_date")})
    name = "employees_crud"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.option("path", work_path(spark, name)).saveAsTable(name)
    avg = (spark.table(name).groupBy("department")
           .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("salary"), 2).alias("avg")))
    assert {r.department: (r.n, r.avg) for r in avg.collect()} == {
        "Data Engineering": (2, Decimal("78000.00")), "Finance": (2, Decimal("65500.00")),
        "Human Resources": (1, Decimal("58000.00")), "Support": (1, Decimal("45000.00"))}
    MU.update_where(spark, name, F.col("department") == "Data Engineering",
                    {"salary": F.col("salary") * F.lit(1.10).cast("decimal(3,2)")})
    MU.update_where(spark, name, "employee_id = 105", {"employment_status": F.lit("ACTIVE")})
    MU.delete_where(spark, name, "employee_id = 103")
    got = {r.employee_id: (r.salary, r.employment_status) for r in spark.table(name).collect()}
    assert len(got) == 5 and 103 not in got
    assert got[101][0] == Decimal("82500.00") and got[104][0] == Decimal("89100.00")
    assert got[105][1] == "ACTIVE"
    assert dict(spark.table(name).dtypes)["salary"] == "decimal(12,2)"
