"""Counts taken while a layer is written."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.quality import reconcile, reconcile_counts
from tessera.session import work_path
from tessera.sinks import layout as L


def test_counts_of_the_written_rows(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3).repartition(7, "k")
    got = L.write_counted(df, work_path(spark, "counted"), {"least": F.min("id"), "odd": F.count_if(F.col("id") % 2 == 1)},
                          partition_by=["k"])
    assert got == {"records": 1000, "least": 0, "odd": 500}
    assert L.write_counted(df.limit(0), work_path(spark, "none"))["records"] == 0


def test_counts_are_those_of_the_files(spark):
    df = spark.range(100).repartition(5).union(spark.range(20))
    path = work_path(spark, "twice")
    assert L.write_counted(df, path)["records"] == spark.read.parquet(path).count() == 120


@pytest.mark.parametrize("duplicates", [0, 4])
def test_reconcile_from_counts_is_the_scanned_one(spark, duplicates):
    frames = [spark.range(n) for n in (10, 3, 3, duplicates)]
    names = ("input", "valid", "rejected", "duplicates")
    counts = {n: f.count() for n, f in zip(names, frames)}
    assert reconcile_counts(spark, counts).collect() == reconcile(*frames).collect()
    assert reconcile_counts(spark, counts).first()["balanced"] == (duplicates == 4)
