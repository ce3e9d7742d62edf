"""Keyed aggregation (AGG-1..19).

All aggregates are partial/final (map-side combined) so a hot key is reduced
inside each map task before the shuffle.  Shares of a total never use
``SUM() OVER ()`` (which funnels every group into one task): the one-row total
is a separate aggregate, broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import percent
from tessera.operators.joins import salt_of
from tessera.session import checkpoint_root


def keyed_sum(df: DataFrame, keys, value: str, name: str, where: Column | None = None,
              order_desc: bool = True) -> DataFrame:
    """AGG-1 / AGG-13: filtered keyed sum, ordered by (-total, key)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if where is not None:
        df = df.filter(where)
    out = df.groupBy(*keys).agg(F.sum(value).alias(name))
    first = F.col(name).desc() if order_desc else F.col(name).asc()
    return out.orderBy(first, *keys)


def group_having(df: DataFrame, keys, aggs: dict[str, Column], having: Column) -> DataFrame:
    """AGG-14: GROUP BY .. HAVING."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]).filter(having)


def conditional_sums(df: DataFrame, keys, value: Column, cases: dict[str, Column]) -> DataFrame:
    """AGG-17: one pass, one sum per named condition."""
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(cond, value)).alias(n) for n, cond in cases.items()])


def share_of_total(grouped: DataFrame, count_col: str, name: str, scale: int = 2,
                   materialize: bool = True) -> DataFrame:
    """AGG-8 / WIN-22: ``ROUND(n * 100.0 / SUM(n) OVER (), scale)`` over grouped rows.

    The grouped rows (one per group) are materialised once with ``checkpoint()``
    in the shared checkpoint folder, so the pipeline that produced them is not
    run a second time for the total; the total is then a scalar subquery over
    the materialised rows.  The rounding is exact.
    """
    if materialize:
        checkpoint_root(grouped.sparkSession)
        grouped = grouped.checkpoint()
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(name, percent(F.col(count_col), total, scale))


def kpis(df: DataFrame, distinct_cols: dict[str, str], range_cols: dict[str, tuple[str, str]],
         approx: bool = False) -> DataFrame:
    """AGG-5 / 6 / 7: several COUNT(DISTINCT) and MIN / MAX in one global aggregate."""
    aggs = []
    for name, c in distinct_cols.items():
        aggs.append((F.approx_count_distinct(c) if approx else F.countDistinct(c)).alias(name))
    for c, (lo, hi) in range_cols.items():
        aggs += [F.min(c).alias(lo), F.max(c).alias(hi)]
    return df.agg(*aggs)


def trend(df: DataFrame, date_col: str, fmt: str, name: str, measures: dict[str, Column]) -> DataFrame:
    """AGG-9: group by a formatted date (e.g. ``yyyy-MM``), ordered by it."""
    return (df.groupBy(F.date_format(date_col, fmt).alias(name))
            .agg(*[m.alias(n) for n, m in measures.items()]).orderBy(name))


def composite_count(df: DataFrame, keys: Sequence[str], name: str = "key", sep: str = "_",
                    count_name: str = "count") -> DataFrame:
    """AGG-11: count per composite key, rendered as ``a_b`` after the grouping, so keys whose
    texts coincide stay apart.  Nulls are rendered as nothing between the separators."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return counted.select(F.concat_ws(sep, *parts).alias(name), F.col("_n").alias(count_name))


def salted_sum(df: DataFrame, keys, value: Column, name: str, salts: int,
               salt_cols: Sequence[str]) -> DataFrame:
    """Skew-proof keyed sum: partial by (key, salt), final by key.

    Only for decomposable aggregates.  The salt is a hash of row content, so it
    is deterministic under recomputation.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    partial = (df.withColumn("_salt", salt_of(salt_cols, salts))
               .groupBy(*keys, "_salt").agg(F.sum(value).alias("_part")))
    return partial.groupBy(*keys).agg(F.sum("_part").alias(name))


def layer_counts(**layers: DataFrame) -> DataFrame:
    """AGG-19: record count per named layer, one row per layer."""
    parts = [d.agg(F.count(F.lit(1)).alias("records")).withColumn("layer", F.lit(n))
             for n, d in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("layer", "records")


def layer_count_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """AGG-19 from counts that the writes of the layers gave: the rows of ``layer_counts``, no scan."""
    return spark.createDataFrame(list(counts.items()), "layer string, records long")


def distinct_states(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """AGG-6: exact distinct counts as states that add up: (keys, bucket, bitmap).

    A bitmap holds 32,768 neighbouring values of an integer column, so a key has as many rows
    as it has such blocks.  States of any keys can be stored, united and counted without
    reading the rows again; nulls are not counted.
    """
    c = F.col(column).cast("long")
    return (df.filter(c.isNotNull()).groupBy(*keys, F.bitmap_bucket_number(c).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("bitmap")))


def count_distinct_states(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Distinct values per ``keys`` (coarser than, or as, the states' own) from stored states."""
    united = states.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("long").alias(name))


def sketch_states(df: DataFrame, keys: Sequence[str], column: str, lg_size: int = 14) -> DataFrame:
    """The approximate form for any type: one HyperLogLog sketch per key, 2**lg_size registers."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, lg_size).alias("sketch"))


def count_sketch_states(states: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return states.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
