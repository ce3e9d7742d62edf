"""Exact money and rounding helpers.

Money columns arrive as DOUBLE. Sums are taken over DECIMAL so that they do not
depend on the order in which partitions are combined, and ``round(x, n)`` of a
ratio is done in integer arithmetic (half away from zero, like SQL ROUND on a
decimal), so the same answer comes out of every engine and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
WIDE = DecimalType(38, 0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, scale: int = 2) -> Column:
    """DOUBLE money → DECIMAL(18, scale)."""
    return _col(c).cast(DecimalType(18, scale))


def cents(c, scale: int = 2) -> Column:
    """Money as an exact integer number of the smallest unit (DECIMAL(38,0))."""
    return (money(c, scale) * F.lit(10 ** scale)).cast(WIDE)


def exact_sum(c, scale: int = 2) -> Column:
    """Order-independent sum of a money column, returned as DOUBLE."""
    return F.sum(money(c, scale)).cast("double")


def round_ratio(num, den, scale: int = 2) -> Column:
    """ROUND(num / den, scale) for integer-valued num, den; half away from zero; DOUBLE.

    Integer division is written as (a - a % b) / b on DECIMAL(38,0), which is
    exact, so no binary floating point enters before the final scaling.
    """
    n = _col(num).cast(WIDE)
    d = _col(den).cast(WIDE)
    a = F.abs(n) * F.lit(2 * 10 ** scale) + F.abs(d)
    b = F.abs(d) * F.lit(2)
    q = ((a - a % b) / b).cast(WIDE)
    sign = F.signum(n) * F.signum(d)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(
        (q * sign.cast(WIDE)).cast("double") / F.lit(10 ** scale))


def percent(part, whole, scale: int = 2) -> Column:
    """ROUND(part * 100.0 / whole, scale) on integer-valued inputs."""
    return round_ratio(_col(part).cast(WIDE) * F.lit(100), whole, scale)


def round_money_avg(c, scale: int = 2) -> Column:
    """ROUND(AVG(money), scale) computed exactly: an aggregate expression."""
    total = F.sum(cents(c, scale))
    return round_ratio(total, F.count(_col(c)) * F.lit(10 ** scale), scale)


# ---- DuckDB twins used by the oracle SQL -------------------------------------------------

def sql_money(expr: str, scale: int = 2) -> str:
    return f"CAST({expr} AS DECIMAL(18,{scale}))"


def sql_cents(expr: str, scale: int = 2) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,{scale})) * {10 ** scale} AS HUGEINT)"


def sql_exact_sum(expr: str, scale: int = 2) -> str:
    return f"CAST(SUM({sql_money(expr, scale)}) AS DOUBLE)"


def sql_round_ratio(num: str, den: str, scale: int = 2) -> str:
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    q = f"((abs({n}) * {2 * 10 ** scale} + abs({d})) // (2 * abs({d})))"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE "
            f"CAST({q} * sign({n}) * sign({d}) AS DOUBLE) / {10 ** scale} END)")


def sql_percent(part: str, whole: str, scale: int = 2) -> str:
    return sql_round_ratio(f"CAST({part} AS HUGEINT) * 100", whole, scale)


def sql_round_money_avg(expr: str, scale: int = 2) -> str:
    return sql_round_ratio(f"SUM({sql_cents(expr, scale)})", f"COUNT({expr}) * {10 ** scale}", scale)
