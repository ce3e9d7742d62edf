import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import mutation as MU
from tessera.operators.summaries import apply_changes, create_summary, partial_states

DDL = "id int, part string, k string, v decimal(10,2), d int"
KEYS, MEASURES = ["part", "k"], ["v", "d"]


def files(spark, table):
    root = MU.table_layout(spark, table)["location"].removeprefix("file:")
    return {p: sorted(f for f in os.listdir(f"{root}/{p}") if f.endswith(".parquet"))
            for p in os.listdir(root) if p.startswith("part=")}


def test_changes_give_the_rebuilt_summary(spark):
    rng = random.Random(3)
    from decimal import Decimal

    def row(i):
        v = rng.choice([None, Decimal(rng.randint(-900, 900)) / 100])
        return (i, rng.choice(["a", "b", "c", "d/ '", None]), rng.choice(["x", "y", None]), v,
                rng.choice([None, rng.randint(1, 28)]))
    now = [row(i) for i in range(300)]
    table = create_summary(spark, spark.createDataFrame(now, DDL), "s", KEYS, MEASURES, ["part"])
    for turn in range(3):
        gone = [r for r in now if r[1] in ("a", None) and (turn == 1 or rng.random() < 0.4)]
        new = [r for r in (row(1000 * (turn + 1) + i) for i in range(20)) if r[1] in ("a", "b") and turn != 1]
        now = [r for r in now if r not in gone] + new
        before = files(spark, table)
        base = spark.createDataFrame(now, DDL)
        touched = apply_changes(spark, table, base, spark.createDataFrame(new, DDL),
                                spark.createDataFrame(gone, DDL), KEYS, MEASURES)
        want = partial_states(base, KEYS, MEASURES)
        got = spark.table(table).select(*want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        after = files(spark, table)
        assert touched <= {("a",), (None,), ("b",)}
        for p in ("part=c",):
            assert before[p] == after[p]
        if turn == 1:
            assert "part=a" not in after


def test_no_change_and_inexact_sums(spark):
    base = spark.createDataFrame([(1, "a", "x", None, None)], DDL)
    table = create_summary(spark, base, "s", KEYS, MEASURES, ["part"])
    assert apply_changes(spark, table, base, base.limit(0), base.limit(0), KEYS, MEASURES) == set()
    assert spark.table(table).count() == 1
    with pytest.raises(ValueError, match="not exact"):
        partial_states(base.withColumn("v", F.lit(1.5).cast("double")), KEYS, ["v"])
