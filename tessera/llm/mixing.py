"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a target number of words: its weight's part of a total, never above
``cap`` times the words it has, the excess shared again by weight among the others.  A
source first gives as many complete passes over its documents as the target holds; the
fraction that remains is sampled.  Each document draws the exponential key
``-ln(u) / quality``; in key order the documents are taken until their sizes fill the
budget.

No source is sorted as a whole.  Keys fall into ``SLICES`` slices by quantile of the unit
exponential; slice sums give each slice's place in the prefix sum, slices fully inside or
outside the budget are settled by their sums, and only the slice where the budget ends is
ordered by key.

Null sources form a source of their own, which comes last; a null or non-positive quality
counts as 1.  Documents of size 0 are taken with the complete passes only.  ``u`` is a hash
of the key column, so reruns agree; rows with equal keys share their draw, and the text's
hash and size order them.  With no words at all every target is 0.  Only the named columns
are read; added columns are those listed in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut, uniform

SLICES = 4096
WEIGHT_CYCLE = (5.0, 2.0, 1.0)


def cycled_weights(sources: DataFrame, cycle: tuple = WEIGHT_CYCLE) -> DataFrame:
    """(source, weight): the cycle's weights over the sources by code point, null last.

    One row per source comes in.  Places are counted in ranges: each range's size first,
    then the order within a range, so no task holds all sources.
    """
    key = F.col("source").isNull(), F.col("source")
    ranged = cut(sources.select("source").repartitionByRange(*key).withColumn(
        "_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    # one row per shuffle partition
    before = sizes.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*key)) - 1 + F.col("before")
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return (ranged.join(F.broadcast(before), "_range")
            .select("source", weights[(place % len(cycle)).cast("int")].alias("weight")))


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, weight, source_size, target) from (source, weight, source_size).

    Each pass of the loop is one aggregate; it ends when no further source is capped.
    """
    limit = cap * F.col("source_size")
    total = sizes.agg((F.lit(share) * F.sum("source_size")).alias("t")).first()["t"] or 0.0
    level = 0.0
    while True:
        capped = limit <= F.col("weight") * F.lit(level)
        row = sizes.agg(F.sum(F.when(capped, limit)).alias("full"),
                        F.sum(F.when(~capped, F.col("weight"))).alias("w")).first()
        left = total - (row["full"] or 0.0)
        if not row["w"]:
            break
        new = left / row["w"]
        if new <= level:
            break
        level = new
    return sizes.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def text_tie(text: str = "text") -> Column:
    """What tells texts under one key apart."""
    return F.xxhash64(F.col(text))


def mix(docs: DataFrame, size: Column, quality: Column, tie: Column, source: str = "source",
        key: str = "doc_id", share: float = 1.5, cap: float = 2.0,
        cycle: tuple = WEIGHT_CYCLE, seed: int = 17) -> DataFrame:
    """(id, tie, size, source, source_size, target, times): how often each row is taken.

    ``tie`` tells rows of one key apart, as ``text_tie`` does.  The result is narrow: texts
    are not moved.
    """
    rate = F.when(quality > 0, quality).otherwise(F.lit(1.0)).cast("double")
    rows = docs.select(F.col(key).alias("id"), tie.alias("tie"),
                       size.alias("size"), F.col(source).alias("source"),
                       (-F.log(uniform(seed, F.col(key))) / rate).alias("draw"))
    # quantile of the unit exponential: draws fall evenly into the slices
    rows = cut(rows.withColumn("slice", F.floor((1 - F.exp(-F.col("draw"))) * SLICES).cast("int")))
    sums = cut(rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")))
    by_source = sums.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    weighted = _null_safe(by_source, cycled_weights(by_source, cycle))
    plan = cut(targets(weighted, share, cap).withColumn(
        "passes", F.when(F.col("source_size") > 0,
                         F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
        .cast("long")).withColumn(
        "budget", F.col("target") - F.col("passes") * F.col("source_size")))
    # at most SLICES rows for each source
    running = F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice"))
    slices = _null_safe(sums, plan).withColumn("before", running - F.col("slice_size"))
    placed = _null_safe(rows, slices, "slice")
    inside = F.col("before") + F.col("slice_size") <= F.col("budget")
    outside = F.col("before") >= F.col("budget")
    edge = placed.where(~inside & ~outside)
    order = Window.partitionBy("source").orderBy("draw", "id", "tie", "size")
    upto = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the document in which the budget ends is taken if that comes nearer to the target
    edge = edge.withColumn("picked", upto - F.col("size") / 2 <= F.col("budget"))
    done = placed.where(inside | outside).withColumn("picked", inside)
    return done.unionByName(edge).select(
        "id", "tie", "size", "source", "source_size", "target",
        (F.col("passes") + F.when(F.col("picked") & (F.col("size") > 0), 1).otherwise(0))
        .alias("times"))


def _null_safe(left: DataFrame, right: DataFrame, *also: str) -> DataFrame:
    """Join on source (null equals null) and the columns ``also``."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in ("source", *also)})
    on = F.col("source").eqNullSafe(F.col("_r_source"))
    for c in also:
        on = on & (F.col(c) == F.col(f"_r_{c}"))
    keep = [c for c in renamed.columns if c not in left.columns or c.startswith("_r_")]
    return left.join(renamed.select(*keep), on).drop("_r_source", *[f"_r_{c}" for c in also])


def repeat(docs: DataFrame, taken: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every row as often as ``mix`` takes it, columns unchanged.

    Rows that agree in key and text are one entry; their times are dealt out among them, so
    the mix keeps its size.
    """
    # one struct as key (nulls inside are equal), so that the join and the window share a shuffle
    plan = taken.groupBy(F.struct("id", "tie").alias("__mix_key")).agg(
        F.sum("times").alias("__mix_total"), F.count(F.lit(1)).alias("__mix_rows"))
    joined = docs.withColumn("__mix_key", F.struct(
        F.col(key).alias("id"), text_tie(text).alias("tie"))).join(plan, "__mix_key")
    same = Window.partitionBy("__mix_key").orderBy(*[F.col(c) for c in docs.columns if c != text])
    more = F.row_number().over(same) <= F.col("__mix_total") % F.col("__mix_rows")
    times = F.floor(F.col("__mix_total") / F.col("__mix_rows")) + F.when(more, 1).otherwise(0)
    return (joined.withColumn("__mix_times", times.cast("int"))
            .withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), F.col("__mix_times"))))
            .select(*docs.columns))
