"""Randomised frames with heavy ties, nulls and a dominant key: the split forms
equal the stock Window forms, amounts and order values null or NaN included, for every ordinal window function."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import windows as W

ROWS = st.lists(
    st.tuples(st.sampled_from(["a", "a", "a", "b", "c"]),          # one dominant key
              st.one_of(st.none(), st.integers(0, 6), st.just("nan")),              # few distinct, some null
              st.one_of(st.none(), st.none(), st.integers(-500, 500), st.just("nan"))),
    min_size=30, max_size=120)


def _frame(spark, rows):
    amount = lambda a: None if a is None else float(a) / 4  # noqa: E731  binary fractions add exactly
    data = [(i, k, float(v) if v is not None else None, amount(a)) for i, (k, v, a) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, k string, v double, amt double")


def _same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, keyed=st.booleans())
def test_split_equals_literal(spark, rows, keyed):
    df = _frame(spark, rows)
    keys = ["k"] if keyed else []
    kw = dict(hot_rows=8)          # split everything
    order = ["-v", "id"]
    checks = [
        (lambda s: W.with_rank_columns(df, keys, order, "rn", "rk", "drk", rank_order=["-v"],
                                       strategy=s, **kw), ["id", "rn", "rk", "drk"]),
        (lambda s: W.with_running_sum(df, keys, ["v", "id"], "amt", "rt", strategy=s, **kw),
         ["id", "rt"]),
        (lambda s: W.with_ntile(df, keys, order, 3, "nt", strategy=s, **kw), ["id", "nt"]),
        (lambda s: W.with_lag_lead(df, keys, ["v", "id"], "amt", "lg", "ld", offset=2,
                                   strategy=s, **kw), ["id", "lg", "ld"]),
        (lambda s: W.with_moving_avg(df, keys, order, "amt", 3, "ma", strategy=s, **kw),
         ["id", "ma"]),
    ]
    for fn, cols in checks:
        assert _same(fn("literal"), fn("segmented"), cols)
