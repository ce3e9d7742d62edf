"""SNK-14: a summary table kept up to date from the changes of its base table.

The summary is a partitioned table of partial states per group: ``n`` rows, and ``sum_c``,
``count_c``, ``min_c`` and ``max_c`` of every measure.  A batch of inserted and deleted rows
is aggregated first; the partitions it touches follow from it, and only these are read and
rewritten.  Sums and counts are added and subtracted.  An extreme changes with inserts alone;
a deleted row that equals its group's extreme makes that group's extremes be taken from the
base anew, and no other group's.  Groups without rows leave, with them emptied partitions.

Sums must be exact to be subtracted again, so DOUBLE measures are refused: cast money to
DECIMAL.  Null group keys are groups; null values count in ``n`` only.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tessera.operators.mutation import _in_partitions, _partition_values, _swap, partition_columns
from tessera.session import checkpoint_root
from tessera.sinks.layout import save_partitioned_table


def partial_states(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group with the states of its rows."""
    for m in measures:
        if isinstance(df.schema[m].dataType, (DoubleType, FloatType)):
            raise ValueError(f"sums of {m} are not exact; cast it to DECIMAL")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[
        f(F.col(m)).alias(f"{name}_{m}") for m in measures
        for name, f in (("sum", F.sum), ("count", F.count), ("min", F.min), ("max", F.max))])


def create_summary(spark: SparkSession, base: DataFrame, prefix: str, keys: Sequence[str],
                   measures: Sequence[str], partition_by: Sequence[str]) -> str:
    """Build the summary of ``base`` as a table partitioned by some of its keys; its name."""
    if set(partition_by) - set(keys):
        raise ValueError("a summary is partitioned by its keys")
    return save_partitioned_table(spark, partial_states(base, keys, measures), prefix, partition_by)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def apply_changes(spark: SparkSession, table: str, base: DataFrame, inserted: DataFrame,
                  deleted: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> set[tuple]:
    """Bring the summary up to ``base`` (the table after the change); the rewritten partitions."""
    checkpoint_root(spark)
    partitions = partition_columns(spark, table)
    plus = partial_states(inserted, keys, measures).withColumn("_sign", F.lit(1))
    minus = partial_states(deleted, keys, measures).withColumn("_sign", F.lit(-1))
    change = plus.unionByName(minus).checkpoint()  # at most two rows per changed group
    touched = _partition_values(change, partitions)
    if not touched:
        return touched
    here = spark.table(table).filter(_in_partitions(partitions, sorted(touched, key=repr)))
    signed = [F.sum(F.col("n") * F.col("_sign")).alias("n")]
    for m in measures:
        signed += [F.sum(F.col(f"{s}_{m}") * F.col("_sign")).alias(f"{s}_{m}") for s in ("sum", "count")]
        for s, f in (("min", F.min), ("max", F.max)):
            signed += [f(F.when(F.col("_sign") == sign, F.col(f"{s}_{m}"))).alias(f"{s}_{m}_{side}")
                       for sign, side in ((1, "in"), (-1, "out"))]
    moved = change.groupBy(*keys).agg(*signed)
    both = here.alias("o").join(moved.alias("c"), _same("o", "c", keys), "full")
    row = [F.coalesce(F.col(f"o.{k}"), F.col(f"c.{k}")).alias(k) for k in keys]
    total = F.coalesce(F.col("o.n"), F.lit(0)) + F.coalesce(F.col("c.n"), F.lit(0))
    lost = F.lit(False)
    states = [total.alias("n")]
    schema = spark.table(table).schema
    for m in measures:
        count = F.coalesce(F.col(f"o.count_{m}"), F.lit(0)) + F.coalesce(F.col(f"c.count_{m}"), F.lit(0))
        added = (F.coalesce(F.col(f"o.sum_{m}"), F.lit(0)) + F.coalesce(F.col(f"c.sum_{m}"), F.lit(0)))
        states += [F.when(count > 0, added).cast(schema[f"sum_{m}"].dataType).alias(f"sum_{m}"),
                   count.alias(f"count_{m}"),
                   F.least(f"o.min_{m}", f"c.min_{m}_in").alias(f"min_{m}"),
                   F.greatest(f"o.max_{m}", f"c.max_{m}_in").alias(f"max_{m}")]
        lost = (lost | F.coalesce(F.col(f"c.min_{m}_out") <= F.least(f"o.min_{m}", f"c.min_{m}_in"), F.lit(False))
                | F.coalesce(F.col(f"c.max_{m}_out") >= F.greatest(f"o.max_{m}", f"c.max_{m}_in"), F.lit(False)))
    merged = both.select(*row, *states, lost.alias("_lost")).filter("n > 0").checkpoint()
    again = merged.filter("_lost").select(*keys)
    if not again.isEmpty():
        rows = base.filter(_in_partitions(partitions, sorted(touched, key=repr)))
        rows = rows.alias("b").join(again.alias("a"), _same("b", "a", keys), "left_semi")
        merged = merged.filter(~F.col("_lost")).drop("_lost").unionByName(partial_states(rows, keys, measures))
    _swap(spark, table, merged, touched)
    return touched
