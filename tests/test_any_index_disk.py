"""Feeds that go through the layers one after the other leave nothing but their lines."""

import os

import duckdb

import __spark_entry__ as entry
from tessera.session import checkpoint_root

from test_customer_feed import TABLES
from test_entry import _rows


def _bytes(top):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(top) for f in files)


def test_layers_of_a_feed_go_when_its_line_is_written(spark, tmp_path, monkeypatch):
    con = duckdb.connect()
    for name, rows in TABLES.items():
        con.execute(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet')")
    import tessera.queries.medallion_queries as Q
    root, seen = checkpoint_root(spark).removeprefix("file://"), []
    there = set(os.listdir(root))
    mine = lambda: [d for d in os.listdir(root) if d not in there]
    monkeypatch.setattr(Q, "reconcile", lambda *a, f=Q.reconcile: seen.append(
        [d for d in mine() if os.path.isdir(f"{root}/{d}/source")]) or f(*a))
    got = entry.queries()["silver_any_index"](spark, str(tmp_path))
    want = con.execute(entry.oracle_sql()["silver_any_index"])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, want.fetchall())
    # one feed's layers at a time, and none in the end
    assert [len(s) for s in seen] == [1, 1, 1, 1]
    assert sum(_bytes(f"{root}/{d}") for d in mine()) < 50_000
    assert not [d for d in mine() if os.path.isdir(f"{root}/{d}/source")]
