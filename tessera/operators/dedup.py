"""Deduplication and top-k (DED-1..3, SRT-1..5, WIN-16)."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.windows import parse_order


def latest_per_key(df: DataFrame, keys, order: Sequence[str]) -> DataFrame:
    """WIN-16 / DED-2: the row with the greatest ``order`` per key.

    ``row_number() = 1`` over the reversed order.  Spark plans it with a partial
    ``WindowGroupLimit``: one candidate per key leaves each map task, so a hot key is never
    gathered in one task.  Descending entries (``-col``) prefer the smallest value; nulls
    lose either way.  ``order`` should end with a unique column for a deterministic result.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first = [F.col(o.name).desc_nulls_last() if o.ascending else F.col(o.name).asc_nulls_last()
             for o in parse_order(order)]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*first))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).select(*df.columns)


def removed_duplicates(df: DataFrame, kept: DataFrame, identity: Sequence[str]) -> DataFrame:
    """DED-3: rows not kept, matched null-safely on columns that identify a row.

    ``identity`` should include a unique column so the join key is never hot.
    """
    names = [f"_k_{c}" for c in identity]
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(identity, names)])
    return df.join(kept.select(*identity).toDF(*names), same, "left_anti")


def drop_duplicates(df: DataFrame, keys) -> DataFrame:
    """DED-1: one arbitrary survivor per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.dropDuplicates(keys)


def top_k(df: DataFrame, order: Sequence[str], k: int, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """SRT-3: ``ORDER BY .. LIMIT k`` with a total order (planned as TakeOrderedAndProject:
    each task keeps its own k best, the driver merges at most k rows per task)."""
    cols = [o.column for o in parse_order(list(order) + list(tie_breaker))]
    return df.orderBy(*cols).limit(k)
