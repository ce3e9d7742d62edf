"""The queries on the customer feed where the feed has several files, as it does at any larger size."""

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.queries.medallion_queries import raw_customer_feed
from tessera.session import tuned, work_path
from tessera.sinks.layout import write_layer

from test_entry import _rows

TABLES = {
    "region": "SELECT i::INT AS r_regionkey, ['AFRICA', 'MIDDLE EAST'][i + 1] AS r_name FROM range(2) t(i)",
    "nation": "SELECT i::INT AS n_nationkey, 'NATION' || i AS n_name, (i % 2)::INT AS n_regionkey FROM range(9) t(i)",
    "customer": "SELECT i AS c_custkey, (i % 9)::INT AS c_nationkey, 'SEGMENT' || i % 4 AS c_mktsegment FROM range(60) t(i)",
    "orders": "SELECT i AS o_orderkey, i * 7 % 60 AS o_custkey, ['F', 'O', 'P'][i % 3 + 1] AS o_orderstatus, "
              "TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (i * 11 % 500) AS o_orderdate FROM range(1, 1500) t(i)"}

QUERIES = ["dq_checks", "dq_counted_writes", "dq_layer_counts", "dq_null_policy", "dq_reasons",
           "dq_reconcile", "dq_rejections", "dq_split", "medallion_country_report", "medallion_email_domains",
           "medallion_kpis", "medallion_monthly"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    at, con = tmp_path_factory.mktemp("feed"), duckdb.connect()
    for name, rows in TABLES.items():
        con.execute(f"COPY ({rows}) TO '{at}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{at}/{name}.parquet')")
    return str(at), con


@pytest.fixture(scope="module")
def parted(spark, tables):
    """A session in which the feed's join, and so the feed, has several files."""
    own = tuned(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "3",
                        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    path = write_layer(raw_customer_feed(own, tables[0]), work_path(own, "feed_parts"), "csv")
    assert len(own.read.csv(path).inputFiles()) > 1
    return own


@pytest.mark.parametrize("name", QUERIES)
def test_feed_of_several_files_matches_oracle(parted, tables, name):
    sf, con = tables
    got = entry.queries()[name](parted, sf)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    rows = _rows(columns, want.fetchall())
    assert rows and _rows(got.columns, got.collect()) == rows
