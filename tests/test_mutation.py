"""Copy-on-write changes on partitioned, bucketed and ORC tables, with null partitions and keys."""

import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import mutation as MU
from tessera.session import work_path

from table_helpers import rows

SCHEMA = "id int, v string, p string"
DATA = [(1, "a", "x"), (2, "b", "y"), (3, "c", None), (4, "d", "x"), (None, "e", "o'k")]


@pytest.fixture(params=["parquet", "orc-bucketed", "external-orc"])
def table(spark, request):
    name = f"mut_{uuid.uuid4().hex[:10]}"
    fmt = "orc" if "orc" in request.param else "parquet"
    w = spark.createDataFrame(DATA, SCHEMA).write.format(fmt).partitionBy("p")
    if "external" in request.param:
        w = w.option("path", work_path(spark, name))
    if "bucketed" in request.param:
        w = w.bucketBy(3, "id").sortBy("id").option("compression", "zlib")
    w.saveAsTable(name)
    before = MU.table_layout(spark, name)
    yield name
    after = MU.table_layout(spark, name)
    assert {k: v for k, v in before.items() if k != "location"} == {k: v for k, v in after.items() if k != "location"}
    spark.sql(f"DROP TABLE {name}")


def content(spark, table):
    return sorted(map(tuple, spark.table(table).select("id", "v", "p").collect()), key=repr)


def test_update_moves_rows_between_partitions(spark, table):
    MU.update_where(spark, table, "id = 1 OR p IS NULL", {"p": F.lit("z"), "v": F.upper("v")})
    assert content(spark, table) == sorted(
        [(1, "A", "z"), (2, "b", "y"), (3, "C", "z"), (4, "d", "x"), (None, "e", "o'k")], key=repr)
    assert "p=__HIVE_DEFAULT_PARTITION__" not in {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_update_in_the_null_partition(spark, table):
    MU.update_where(spark, table, F.col("id") == 3, {"v": F.lit("new")})
    assert (3, "new", None) in content(spark, table) and len(content(spark, table)) == 5


def test_delete_empties_partitions(spark, table):
    MU.delete_where(spark, table, "p = 'x' OR p IS NULL OR p = \"o'k\"")
    assert content(spark, table) == [(2, "b", "y")]
    MU.delete_where(spark, table, "true")
    assert content(spark, table) == []
    MU.insert_rows(spark.createDataFrame([(9, "n", "x")], SCHEMA), table)
    assert content(spark, table) == [(9, "n", "x")]


def test_merge_moves_and_inserts(spark, table):
    changes = spark.createDataFrame([(1, "A", "y"), (3, "C", None), (None, "E", "y"), (7, "n", "new")], SCHEMA)
    MU.upsert(spark, table, changes, ["id"])
    assert content(spark, table) == sorted(
        [(1, "A", "y"), (2, "b", "y"), (3, "C", None), (4, "d", "x"), (None, "E", "y"), (7, "n", "new")], key=repr)


def test_merge_with_two_changes_for_a_key(spark, table):
    twice = spark.createDataFrame([(1, "A", "y"), (1, "B", "x")], SCHEMA)
    with pytest.raises(ValueError):
        MU.upsert(spark, table, twice, ["id"])
    MU.upsert(spark, table, twice, ["id"], order=["v"])
    assert (1, "B", "x") in content(spark, table) and len(content(spark, table)) == 5


def test_truncate(spark, table):
    MU.truncate(spark, table)
    assert content(spark, table) == [] and spark.sql(f"SHOW PARTITIONS {table}").count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_unpartitioned_bucketed_table(spark, fmt):
    name = f"mut_flat_{uuid.uuid4().hex[:10]}"
    spark.createDataFrame(DATA, SCHEMA).write.format(fmt).bucketBy(2, "id").sortBy("id").saveAsTable(name)
    MU.update_where(spark, name, "id = 2", {"v": F.lit("B")})
    MU.delete_where(spark, name, "id = 4")
    MU.upsert(spark, name, spark.createDataFrame([(5, "f", None)], SCHEMA), ["id"])
    assert rows(spark.table(name).where("id is not null"), "id", "v") == [(1, "a"), (2, "B"), (3, "c"), (5, "f")]
    assert MU.table_layout(spark, name)["buckets"] == 2
    MU.truncate(spark, name)
    assert spark.table(name).count() == 0
    spark.sql(f"DROP TABLE {name}")


def test_many_emptied_partitions_leave_at_once(spark, monkeypatch):
    import os
    from tessera.sinks.layout import save_partitioned_table
    df = spark.range(600).select("id", F.when(F.col("id") % 200 != 7, F.concat(
        F.lit("p/ '"), F.col("id") % 200)).alias("part"))
    table = save_partitioned_table(spark, df.coalesce(2), "emptied", ["part"])
    said = []
    plain = spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (said.append(q), plain(q, *a, **k))[1])
    MU.delete_where(spark, table, "id % 200 > 3")
    monkeypatch.undo()
    assert sum(q.startswith("ALTER TABLE") for q in said) == 1
    assert not any("INSERT OVERWRITE" in q for q in said)
    assert sorted(r["id"] for r in spark.table(table).collect()) == sorted(
        i for i in range(600) if i % 200 <= 3)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 4
    root = MU.table_layout(spark, table)["location"].removeprefix("file:")
    assert len([d for d in os.listdir(root) if d.startswith("part=")]) == 4
