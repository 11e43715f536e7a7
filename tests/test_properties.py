"""Property tests: random series against pandas."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candela.operators.returns import returns
from candela.operators.scan import add_blocks, block_rows, ewm_adjust_false, ewm_complete
from conftest import make_bars

prices = st.floats(min_value=0.01, max_value=1e5, allow_nan=False).map(lambda v: round(v, 2))
series = st.lists(st.one_of(prices, st.none()), min_size=1, max_size=400)
complete_series = st.lists(prices, min_size=1, max_size=400)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _check(got, ref):
    got = np.asarray(got, dtype=float)
    assert (np.isnan(got) == np.isnan(ref)).all()
    m = ~np.isnan(ref)
    np.testing.assert_allclose(got[m], ref[m], rtol=1e-9, atol=1e-9)


@SETTINGS
@given(xs=series, span=st.sampled_from([3, 9, 12, 20, 26]))
def test_gap_aware_average_matches_pandas(spark, xs, span):
    df = spark.createDataFrame([("P", i, x) for i, x in enumerate(xs)], "ticker string, date int, x double")
    got = [r.y for r in ewm_adjust_false(df, ["ticker"], "date", "x", span, "y").orderBy("date").collect()]
    _check(got, pd.Series(xs, dtype=float).ewm(span=span, adjust=False).mean().to_numpy())


@SETTINGS
@given(xs=complete_series, lead=st.integers(min_value=0, max_value=5))
def test_shared_block_averages_match_pandas(spark, xs, lead):
    full = [None] * lead + xs
    df = spark.createDataFrame([("P", i, x) for i, x in enumerate(full)], "ticker string, date int, x double")
    spans = {"e9": 9, "e12": 12, "e26": 26}
    b = block_rows(list(spans.values()))
    out = ewm_complete(add_blocks(df, ["ticker"], "date", "x", b, "_b"), ["ticker"], "date", "x", spans, "_b", b)
    rows = out.orderBy("date").collect()
    for name, span in spans.items():
        _check([r[name] for r in rows], pd.Series(full, dtype=float).ewm(span=span, adjust=False).mean().to_numpy())


@SETTINGS
@given(xs=series)
def test_returns_match_pandas(spark, xs):
    if all(x is None for x in xs):
        return
    got = returns(make_bars(spark, {"P": xs})).orderBy("date").collect()
    s = pd.Series(xs, dtype=float).ffill()
    for name, k in [("daily", 1), ("weekly", 5), ("monthly", 21)]:
        base = s.shift(k)
        ref = (s / base.where(base != 0) - 1).round(4).to_numpy()
        a = np.array([r[f"var_{name}"] for r in got], dtype=float)
        assert (np.isnan(a) == np.isnan(ref)).all()
        np.testing.assert_array_equal(a[~np.isnan(a)], ref[~np.isnan(ref)])
