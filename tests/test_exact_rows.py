"""Exact sums of many rows: rounded in plain arithmetic, to the nearest double."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.exact import MOST_STEPS, DoubleSum
from tessera.operators import windows as W


def attached(df):
    how = DoubleSum(df, "x")
    parts = {f"p{i}": F.sum(p) for i, p in enumerate(how.pieces("x"))}
    sums = df.groupBy("k").agg(*[p.alias(n) for n, p in parts.items()])
    return how, how.attach(sums, "s", [F.col(n) for n in parts]).select("k", "s")


@pytest.mark.parametrize("low, high", [(0, 0), (-30, 60), (-1070, -1000), (900, 1010), (-60, 50), (-300, 300)])
def test_rows_get_the_double_nearest_to_the_exact_sum(spark, low, high):
    rng, groups = random.Random(low), {}
    for k in range(150):
        xs = [math.ldexp(rng.uniform(-1, 1), rng.randint(low, high)) for _ in range(rng.choice([1, 2, 3, 30]))]
        if k % 2:                                   # most of it cancels
            xs += [-x for x in xs[:rng.randint(0, len(xs))]]
        if k % 3 == 0:                              # ties, and bits far below them
            xs += [math.ldexp(1.0, high), math.ldexp(1.0, max(high - 53, -1074)),
                   rng.choice([-1, 0, 1]) * math.ldexp(1.0, max(low - 2, -1074))]
        groups[k] = xs + [None]
    groups |= {200: [None], 201: [0.0, -0.0]}
    how, out = attached(spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k int, x double"))
    assert (how.limbs > MOST_STEPS) == (low == -300)
    want = {k: [x for x in xs if x is not None] for k, xs in groups.items()}
    assert dict(map(tuple, out.collect())) == {k: math.fsum(xs) if xs else None for k, xs in want.items()}


def test_rows_of_infinities_and_nan(spark):
    inf, nan = math.inf, math.nan
    groups = {0: [1.0, inf], 1: [-inf, 2.0], 2: [inf, -inf], 3: [nan, inf], 4: [1.5, None], 5: [None]}
    got = dict(map(tuple, attached(spark.createDataFrame(
        [(k, x) for k, xs in groups.items() for x in xs], "k int, x double"))[1].collect()))
    assert got[0] == inf and got[1] == -inf and math.isnan(got[2]) and math.isnan(got[3])
    assert got[4] == 1.5 and got[5] is None


@pytest.mark.parametrize("hot_rows", [None, 40])
@pytest.mark.parametrize("call", ["running sum", "moving average"])
def test_windows_round_rows_without_lambdas(spark, call, hot_rows):
    """A lambda over arrays and 38-digit decimals took over 100 microseconds a row."""
    rng = random.Random(3)
    rows = [(i, i % 2, None if i % 7 == 0 else rng.uniform(-1, 1) * 10.0 ** rng.randint(-6, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k int, x double")
    args = (df, "k", ["id"], "x")
    out = (W.with_running_sum(*args, "s", hot_rows=hot_rows) if call == "running sum"
           else W.with_moving_avg(*args, 2, "s", hot_rows=hot_rows))
    assert out.columns == ["id", "k", "x", "s"]
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for k in (0, 1):
        mine = [(i, x) for i, j, x in rows if j == k]
        for n, (i, _) in enumerate(mine):
            frame = [x for _, x in (mine[:n + 1] if call == "running sum" else mine[max(0, n - 2):n + 1]) if x is not None]
            want[i] = math.fsum(frame) / (1 if call == "running sum" else len(frame)) if frame else None
    assert {r.id: r.s for r in out.collect()} == want
