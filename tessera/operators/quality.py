"""Rule-based validation, valid / rejected split and reconciliation (DQ-1..7).

Rules are ``(reason, condition)`` pairs where the condition is true for a good
row.  A rule whose condition is NULL (e.g. a regex on a null e-mail) counts as
failed by default (``null_policy="reject"``), so every input row lands in
exactly one output.  ``null_policy="drop"`` reproduces the original notebook,
where such rows fall out of both outputs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Rule = tuple[str, Column]

VALID = "_is_valid_record"
REASON = "_rejection_reason"
REASONS = "_rejection_reasons"


def apply_rules(df: DataFrame, rules: Sequence[Rule], null_policy: str = "reject") -> DataFrame:
    """DQ-1 / 2 / 3: validity flag, first failing reason, all failing reasons."""
    if null_policy not in ("reject", "drop"):
        raise ValueError("null_policy must be 'reject' or 'drop'")
    if null_policy == "reject":
        ok = [(r, F.coalesce(c, F.lit(False))) for r, c in rules]
    else:
        ok = list(rules)
    flag = ok[0][1]
    for _, c in ok[1:]:
        flag = flag & c
    first = None
    for reason, c in ok:
        first = F.when(~c, F.lit(reason)) if first is None else first.when(~c, F.lit(reason))
    all_reasons = F.filter(F.array(*[F.when(~c, F.lit(r)) for r, c in ok]),
                           lambda x: x.isNotNull())
    return df.withColumns({VALID: flag, REASON: first, REASONS: all_reasons})


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DQ-4: (valid, rejected) by the flag; a NULL flag (``null_policy="drop"``) is in neither."""
    return (validated.filter(F.col(VALID) == F.lit(True)),
            validated.filter(F.col(VALID) == F.lit(False)))


def reconcile(input_df: DataFrame, valid: DataFrame, rejected: DataFrame,
              duplicates: DataFrame | None = None) -> DataFrame:
    """DQ-6: one row of counts and whether input = valid + rejected + duplicates.

    Each count is its own aggregate (one pass over each frame), attached to the
    first as scalar subqueries.
    """
    def cnt(df):
        return df.agg(F.count(F.lit(1))).scalar()
    out = input_df.agg(F.count(F.lit(1)).alias("input_records")).withColumns({
        "valid_records": cnt(valid), "rejected_records": cnt(rejected),
        "duplicate_records": cnt(duplicates) if duplicates is not None
        else F.lit(0).cast("long")})
    return out.withColumn("balanced", F.col("input_records") == F.col("valid_records")
                          + F.col("rejected_records") + F.col("duplicate_records"))


def reconcile_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """DQ-6 from counts taken while the layers were written: the row of ``reconcile`` without
    a scan.  ``counts`` has input, valid, rejected and, if kept apart, duplicates."""
    parts = {name: F.lit(counts.get(name, 0)).cast("long")
             for name in ("input", "valid", "rejected", "duplicates")}
    out = spark.range(1).select(*[c.alias(n) for n, c in parts.items()])
    return out.select(
        F.col("input").alias("input_records"), F.col("valid").alias("valid_records"),
        F.col("rejected").alias("rejected_records"), F.col("duplicates").alias("duplicate_records"),
        (F.col("input") == F.col("valid") + F.col("rejected") + F.col("duplicates")).alias("balanced"))


def check(df: DataFrame, assertions: dict[str, Column]) -> DataFrame:
    """DQ-7: named boolean checks over the whole frame; one row, one column per check.

    Each assertion is an aggregate expression that is true when the check passes,
    e.g. ``F.count("id") == F.countDistinct("id")`` for uniqueness.
    """
    return df.agg(*[a.alias(n) for n, a in assertions.items()])


def unique_check(c: str) -> Column:
    return F.count(F.col(c)) == F.countDistinct(F.col(c))
