import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.exact import DoubleSum
from tessera.operators import windows as W


@pytest.mark.parametrize("low, high", [(0, 0), (-30, 60), (-1070, -1000), (900, 1020), (-300, 300)])
def test_nearest_to_the_exact_sum(spark, low, high):
    rng = random.Random(low)
    xs = [math.ldexp(rng.uniform(-1, 1), rng.randint(low, high)) for _ in range(300)]
    rows = [(i % 3, x) for i, x in enumerate(xs)] + [(7, None), (0, 0.0), (1, -0.0), (8, None)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(7)
    how = DoubleSum(df, "x")
    got = dict(map(tuple, df.groupBy("k").agg(how.result([F.sum(p) for p in how.pieces("x")])).collect()))
    assert got == {**{k: math.fsum(xs[k::3]) for k in range(3)}, 7: None, 8: None}


def test_ties_go_to_even(spark):
    for extra, want in ((0.0, 2.0 ** 53), (2.0 ** -500, 2.0 ** 53 + 2), (-2.0 ** -500, 2.0 ** 53)):
        df = spark.createDataFrame([(2.0 ** 53,), (1.0,), (extra,)], "x double")
        how = DoubleSum(df, "x")
        assert df.agg(how.result([F.sum(p) for p in how.pieces("x")])).first()[0] == want


def test_infinities_and_nan(spark):
    inf, nan = math.inf, math.nan
    groups = {0: [1.0, inf], 1: [-inf, 2.0], 2: [inf, -inf], 3: [nan, inf], 4: [1.5, None]}
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k int, x double")
    how = DoubleSum(df, "x")
    got = dict(map(tuple, df.groupBy("k").agg(how.result([F.sum(p) for p in how.pieces("x")])).collect()))
    assert got[0] == inf and got[1] == -inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] == 1.5


def test_no_split_changes_a_bit(spark):
    rng = random.Random(5)
    rows = [(i, i % 3, rng.choice([None, rng.uniform(-1, 1) * 10.0 ** rng.randint(-8, 12)])) for i in range(1200)]
    df = spark.createDataFrame(rows, "id int, k int, x double").repartition(5)
    whole, seen, back = 0.0, [], []
    for _, _, x in rows:
        seen += [] if x is None else [x]
        back.append(math.fsum(seen) if seen else None)
    for keys in ([], ["k"]):
        results = []
        for kw in ({"strategy": "literal"}, {}, {"hot_rows": 60}, {"hot_rows": 200}):
            out = W.with_running_sum(df, keys, ["id"], "x", "s", **kw)
            out = W.with_moving_avg(out, keys, ["id"], "x", 4, "m", **kw)
            assert out.columns == ["id", "k", "x", "s", "m"]
            results.append([tuple(r) for r in out.orderBy("id").select("s", "m").collect()])
        assert all(r == results[0] for r in results[1:])
        if not keys:
            assert [s for s, _ in results[0]] == back
