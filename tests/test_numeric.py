"""Exact rounding helpers agree with decimal HALF_UP arithmetic (property test)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.numeric import percent, round_ratio


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**9)),
                min_size=50, max_size=50))
def test_round_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs + [(5, 1000), (-5, 1000), (1, 8), (125, 1000)], "n long, d long")
    got = df.select("n", "d", round_ratio("n", "d", 2).alias("r"),
                    percent("n", "d", 2).alias("p")).collect()
    for r in got:
        q = (Decimal(r.n) / Decimal(r.d))
        exp = float((abs(q)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) * (1 if q >= 0 else -1))
        assert r.r == exp, (r.n, r.d, r.r, exp)
        q2 = Decimal(r.n) * 100 / Decimal(r.d)
        exp2 = float((abs(q2)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP) * (1 if q2 >= 0 else -1))
        assert r.p == exp2


def test_zero_denominator_is_null(spark):
    r = spark.createDataFrame([(1, 0)], "n long, d long").select(round_ratio("n", "d").alias("r")).first()
    assert r.r is None
