"""Dimensional joins with explicit strategies (JON-1..10).

``auto`` leaves the choice to the planner: it broadcasts a side whose size in bytes is known
to be under ``spark.sql.autoBroadcastJoinThreshold``, and AQE changes a shuffle join to a
broadcast one when a side turns out small.  Nothing is counted while a join is planned.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_root

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df`` in bytes, from file sizes and statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def checked_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` if its planned size is within ``max_bytes``, else ``df`` unchanged."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def _on(on) -> list[str] | Column:
    return [on] if isinstance(on, str) else on


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             strategy: str = "auto", max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Fact ⋈ dimension.

    ``auto``: the planner and AQE choose by bytes.
    ``broadcast``: broadcast the dimension if its planned size is within ``max_bytes``.
    ``merge``: sort-merge join (both sides shuffled on the key).
    ``shuffle_hash``: shuffled hash join.
    ``bucket``: both sides are tables bucketed on the key; a sort-merge join that uses the
    buckets, so no exchange appears.
    """
    on = _on(on)
    if strategy == "broadcast":
        dim = checked_broadcast(dim, max_bytes)
    elif strategy in ("merge", "bucket"):
        dim = dim.hint("merge")
    elif strategy == "shuffle_hash":
        dim = dim.hint("shuffle_hash")
    elif strategy != "auto":
        raise ValueError(f"unknown strategy {strategy}")
    return fact.join(dim, on, how)


def unmatched(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """JON-8: rows of ``left`` with no partner in ``right`` (left anti join)."""
    return left.join(right, _on(on), "left_anti")


def preagg_join(fact: DataFrame, dim: DataFrame, key: str, fact_groups: Sequence[str],
                dim_groups: Sequence[str], measures: dict[str, Column],
                strategy: str = "auto") -> DataFrame:
    """JON-5: aggregate the fact to (key, fact_groups) first, join, then re-aggregate.

    Valid for decomposable measures whose partial results are re-summed
    (sums and counts): ``measures`` maps output names to partial aggregates,
    and each is summed again after the join.
    """
    partial = fact.groupBy(key, *fact_groups).agg(*[m.alias(n) for n, m in measures.items()])
    joined = join_dim(partial, dim, key, "inner", strategy)
    return joined.groupBy(*fact_groups, *dim_groups).agg(
        *[F.sum(n).alias(n) for n in measures])


def salt_of(cols: Sequence[str], salts: int) -> Column:
    """Deterministic salt from row content: the same row always gets the same salt,
    so a recomputed task after an executor loss routes rows identically."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)).cast("int")


#: Joins in which every row of the small side may be repeated without changing the result.
SALTED_KINDS = ("inner", "left", "leftouter", "left_outer", "left_semi", "left_anti")


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], salts: int,
                salt_cols: Sequence[str], how: str = "inner", hot_rows: int = 1_000_000) -> DataFrame:
    """JON-6: split the hot keys of ``big`` over ``salts`` sub-keys.

    Keys with more than ``hot_rows`` rows are found by one partial/final count (at most
    rows / hot_rows of them).  Only these are salted, and only their rows of ``small`` are
    repeated.  Joins that return unmatched rows of ``small`` are refused.
    """
    if how not in SALTED_KINDS:
        raise ValueError(f"a salted join cannot be {how}: it would repeat rows of the small side")
    on = list(on)
    checkpoint_root(big.sparkSession)
    hot = (big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
           .select(*on, F.lit(salts).alias("_salts")).checkpoint())  # counted once for both sides
    one = F.coalesce(F.col("_salts"), F.lit(1))
    b = big.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), one).cast("int"))
    s = small.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
    joined = b.drop("_salts").join(s.drop("_salts").hint("merge"), on + ["_salt"], how)
    return joined.drop("_salt")


#: Items a heavy-hitter sketch tracks per key it may report.
TRACKED = 16


def heavy_keys(df: DataFrame, on: Sequence[str], more_than: int, most: int = 1024) -> list[int]:
    """Hashes of the keys with more than ``more_than`` rows, at most ``most`` of them.

    A frequent-items sketch: one bounded state per task, merged, no shuffle of keys.  Counts
    are never under-estimated by more than rows / (4 * most), so a key can only be missed if
    it has hardly more rows than that.
    """
    top = df.select(F.xxhash64(*on).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {TRACKED * most})").alias("top")).first()["top"]
    return sorted(r["item"] for r in top or [] if r["count"] > more_than)


def hot_path_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner",
                  hot_rows: int = 1_000_000, max_hot_rows: int = 1_000_000) -> DataFrame:
    """JON-6: a path of its own for the hot keys of ``big``; the others are merged.

    The hot keys come from a heavy-hitter sketch.  Their rows of ``small`` are broadcast, so
    their rows of ``big`` are not shuffled at all; should they be more than ``max_hot_rows``,
    the hot keys are salted instead.  Every key takes one path on both sides (null keys too),
    so the parts add up to the join.  Key columns must have equal types on both sides.
    """
    if how not in SALTED_KINDS:
        raise ValueError(f"a hot-path join cannot be {how}")
    on = list(on)
    if any(big.schema[c].dataType != small.schema[c].dataType for c in on):
        raise ValueError(f"the types of {on} differ")
    keys = heavy_keys(big, on, hot_rows)
    if not keys:
        return big.join(small.hint("merge"), on, how)
    hot = F.xxhash64(*on).isin(keys)
    few = small.filter(hot)
    if few.limit(max_hot_rows + 1).count() > max_hot_rows:
        fast = salted_join(big.filter(hot), few, on, 64, big.columns, how, hot_rows)
    else:
        fast = big.filter(hot).join(F.broadcast(few), on, how)
    return fast.unionByName(big.filter(~hot).join(small.filter(~hot).hint("merge"), on, how))


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]],
              strategy: str = "auto") -> DataFrame:
    """JON-9: fact ⋈ dim1 ⋈ dim2 ...; each (dim, key) joined with ``join_dim``."""
    out = fact
    for dim, key in dims:
        out = join_dim(out, dim, key, "inner", strategy)
    return out


def with_config(df: DataFrame, config: DataFrame) -> DataFrame:
    """JON-10 / SRC-8: attach a one-row configuration to every row.

    The configuration must be exactly one row (checked); its fields are attached
    as one scalar subquery, computed once.
    """
    if len(config.take(2)) != 1:
        raise ValueError("configuration must have exactly one row")
    from tessera.operators.windows import with_scalars
    return with_scalars(df, config)
