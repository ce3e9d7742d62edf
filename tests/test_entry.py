"""Driver contract: entry runs; every query has an oracle; a sample matches DuckDB."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.session import TABLES

from table_helpers import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["n_name", "people"]


def test_every_query_has_an_oracle():
    from tessera.queries import ORACLES, QUERIES
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


SAMPLE = ["customers_by_nation", "win_running_total", "win_rank_dense", "win_lag_lead",
          "word_count_min_len", "daily_city_category_revenue", "filtered_key_sum", "date_suite",
          "orders_without_items", "company_summary"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, sdf.collect()) == _rows(dcols, res.fetchall())
