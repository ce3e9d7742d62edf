"""Sums of DOUBLE columns that do not depend on the order of the additions.

Every finite double is cut, without error, into limbs: whole multiples of powers of 2**24
(``x % 2**(24 (b + 1)) / 2**(24 b)``, truncated).  Limbs are summed as LONG, which is exact
and associative, so partial sums of any split add up to the same state; up to 2**39 values
fit.  ``result`` turns a state into the double nearest to the exact sum (ties to even), so
it is one number whatever the ranges, tasks or retries were.

One aggregate over the column finds which limbs occur; further columns count infinities and
NaN only where the column has any.  The sum of no values is null, as in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

BITS = 24
#: Significant bits that settle the rounding; what lies below only tells whether it is zero.
ENOUGH = 80
#: States of more limbs than this are rounded by ``result`` alone; ``attach`` has steps for each.
MOST_STEPS = 12
_INF = float("inf")


def _power(e: int) -> list[float]:
    """Factors whose product is 2**e, each a normal double."""
    half = e // 2
    return [math.ldexp(1.0, half), math.ldexp(1.0, e - half)]


def is_double(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (DoubleType, FloatType))


class DoubleSum:
    """The state of an exact sum over a DOUBLE column: ``size`` LONG sums."""

    def __init__(self, df: DataFrame, column: str):
        x = F.col(column).cast("double")
        finite = F.abs(x) < _INF
        row = df.agg(F.max(F.when(finite, F.abs(x))).alias("most"),
                     F.min(F.when(finite & (x != 0), F.abs(x))).alias("least"),
                     F.max(F.coalesce(~finite, F.lit(False))).alias("odd")).first()
        most, least = row["most"] or 0.0, row["least"]
        low = max(math.frexp(least)[1] - 53, -1074) if least else 0
        high = math.frexp(most)[1] - 1 if least else 0
        self.low, self.limbs = low // BITS, high // BITS - low // BITS + 1
        self.odd = bool(row["odd"])
        self.size = self.limbs + 3 * self.odd

    def pieces(self, column: str) -> list[Column]:
        """What is summed: the limbs of a value, then its part in the three odd counts."""
        x = F.col(column).cast("double")
        finite = F.abs(x) < _INF
        out = []
        for b in range(self.low, self.low + self.limbs):
            top = BITS * (b + 1)
            rest = x % F.lit(math.ldexp(1.0, top) if top < 1024 else _INF)
            for factor in _power(-BITS * b):
                rest = rest * F.lit(factor)
            # null stays null, infinities and NaN have no limbs
            out.append(F.when(finite, rest).when(x.isNotNull(), F.lit(0.0)).cast("long"))
        if self.odd:
            out += [F.when(x.isNotNull(), test.cast("long"))
                    for test in (F.isnan(x), x == _INF, x == -_INF)]
        return out

    def result(self, sums: Sequence[Column]) -> Column:
        """The double nearest to the sum whose state is ``sums``."""
        limbs, odd = list(sums[:self.limbs]), list(sums[self.limbs:])
        wide = "decimal(38,0)"
        none = F.struct(F.lit(0).cast("long").alias("carry"),
                        F.array().cast("array<long>").alias("digits"))
        # carries upwards: digits from 0 to 2**24 - 1, the highest first, under a signed carry
        carried = F.aggregate(F.array(*limbs), none, lambda s, limb: F.struct(
            F.shiftright(s["carry"] + limb, BITS).alias("carry"),
            F.concat(F.array((s["carry"] + limb).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))),
                     s["digits"]).alias("digits")))
        start = F.struct(carried["carry"].cast(wide).alias("head"), F.lit(0).alias("left"),
                         F.lit(False).alias("more"))

        def take(s: Column, digit: Column) -> Column:
            full = F.abs(s["head"]) >= F.lit(str(1 << ENOUGH)).cast(wide)
            return F.struct(
                F.when(full, s["head"]).otherwise(
                    (s["head"] * F.lit(1 << BITS) + digit).cast(wide)).alias("head"),
                (s["left"] + full.cast("int")).alias("left"),
                (s["more"] | (full & (digit != 0))).alias("more"))

        read = F.aggregate(carried["digits"], start, take)
        e = read["left"] * BITS + F.lit(BITS * self.low - 1)
        half = F.floor(e / 2).cast("int")
        head = (read["head"] * 2 + read["more"].cast("int")).cast("double")
        value = head * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), e - half)
        if odd:
            nan, up, down = odd
            value = (F.when((nan > 0) | ((up > 0) & (down > 0)), F.lit(float("nan")))
                     .when(up > 0, F.lit(_INF)).when(down > 0, F.lit(-_INF)).otherwise(value))
        return F.when(limbs[0].isNotNull(), value)

    def attach(self, df: DataFrame, name: str, sums: Sequence[Column]) -> DataFrame:
        """``df`` with ``result(sums)`` as column ``name``, in plain arithmetic of a few steps:
        for results of many rows.

        The state is carried into digits from -2**23 to 2**23 of base 2**24.  What follows the
        leading digit is about half of its unit at most, so the four digits from there on hold
        over 70 bits of the sum, and of the rest only the sign matters: one addition of two
        exact doubles rounds.
        """
        if self.limbs > MOST_STEPS:
            return df.withColumn(name, self.result(sums))
        n, half = self.limbs, F.lit(1 << (BITS - 1)).cast("long")
        carry = lambda c: F.shiftright(c + half, BITS)
        carried = [F.coalesce(c, F.lit(0).cast("long")) for c in sums[:n]]
        for i in range(1, n + 2):
            carried[i:i + 1] = [carried[i] + carry(carried[i - 1]) if i < n else carry(carried[i - 1])]
        at, digit, sign = ([f"_{kind}{i}_{name}" for i in range(n + 2)] for kind in ("at", "digit", "sign"))
        odd = [f"_odd{i}_{name}" for i in range(3)] if self.odd else []
        out = df.withColumns({f"_some_{name}": sums[0].isNotNull(), **dict(zip(at, carried)),
                              **dict(zip(odd, sums[n:]))})
        out = out.withColumns({digit[i]: F.col(at[i]) - (F.shiftleft(carry(F.col(at[i])), BITS) if i <= n else F.lit(0))
                               for i in range(n + 2)})
        # of the number that digit i ends
        below = F.lit(0.0)
        signs = {}
        for i in range(n - 1):
            below = F.signum(F.col(digit[i]) * 2 + below)
            signs[sign[i]] = below
        out = out.withColumns(signs)
        d = lambda i: F.col(digit[i]) if i >= 0 else F.lit(0).cast("long")
        value = None
        for k in reversed(range(n + 2)):
            high = (d(k) * (1 << BITS) + d(k - 1)).cast("double") * math.ldexp(1.0, 2 * BITS + 1)
            rest = ((d(k - 2) * (1 << BITS) + d(k - 3)) * 2).cast("double")
            part = high + (rest + F.col(sign[k - 4]) if k >= 4 else rest)
            for factor in _power(BITS * (k - 3 + self.low) - 1):
                part = part * F.lit(factor)
            value = F.when(d(k) != 0, part) if value is None else value.when(d(k) != 0, part)
        value = value.otherwise(0.0)
        if odd:
            nan, up, down = (F.col(c) for c in odd)
            value = (F.when((nan > 0) | ((up > 0) & (down > 0)), F.lit(float("nan")))
                     .when(up > 0, F.lit(_INF)).when(down > 0, F.lit(-_INF)).otherwise(value))
        return (out.withColumn(name, F.when(F.col(f"_some_{name}"), value))
                .drop(f"_some_{name}", *at, *digit, *signs, *odd))


class PlainSum:
    """Sums of types whose addition is exact, and DOUBLE money as decimals of ``scale`` digits."""

    size = 1

    def __init__(self, scale: int | None):
        self.scale = scale

    def pieces(self, column: str) -> list[Column]:
        from tessera.functions.numeric import money
        return [F.col(column) if self.scale is None else money(column, self.scale)]

    def result(self, sums: Sequence[Column]) -> Column:
        return sums[0] if self.scale is None else sums[0].cast("double")

    def attach(self, df: DataFrame, name: str, sums: Sequence[Column]) -> DataFrame:
        return df.withColumn(name, self.result(sums))


def summing(df: DataFrame, column: str, scale: int | None = None) -> DoubleSum | PlainSum:
    """How to sum a column so that every split of its rows gives the same result."""
    return DoubleSum(df, column) if scale is None and is_double(df, column) else PlainSum(scale)
