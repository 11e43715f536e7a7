"""Indicators and returns against an independent pandas computation of the
same definitions (rolling means and deviations, ewm adjust=False, simple-mean
RSI, true-range ATR, OBV, Fibonacci levels, pct_change)."""

import numpy as np
import pandas as pd
import pytest

from candela.operators.returns import returns
from candela.operators.technical import technical_indicators
from candela.sources.bars import supplier_bars
from conftest import SF001


def pandas_indicators(g: pd.DataFrame) -> pd.DataFrame:
    g = g.sort_values("date").copy()
    c = g["close"]
    out = pd.DataFrame({"date": g["date"], "ticker": g["ticker"]})
    out["sma_20"] = c.rolling(20).mean()
    out["sma_50"] = c.rolling(50).mean()
    out["ema_20"] = c.ewm(span=20, adjust=False).mean()
    d = c.diff()
    gain, loss = d.clip(lower=0), -d.clip(upper=0)
    out["rsi_14"] = 100 - 100 / (1 + gain.rolling(14).mean() / loss.rolling(14).mean())
    e12, e26 = c.ewm(span=12, adjust=False).mean(), c.ewm(span=26, adjust=False).mean()
    out["macd"] = e12 - e26
    out["macd_signal"] = out["macd"].ewm(span=9, adjust=False).mean()
    tr = pd.concat([g["high"] - g["low"], (g["high"] - c.shift()).abs(), (g["low"] - c.shift()).abs()], axis=1).max(axis=1)
    out["atr_14"] = tr.rolling(14).mean()
    out["obv"] = (np.sign(d) * g["volume"]).fillna(0).cumsum()
    out["volatility_20"] = c.rolling(20).std()
    out["bb_upper"] = out["sma_20"] + 2 * out["volatility_20"]
    hi, lo = c.max(), c.min()
    out["fib_38_2"] = hi - (hi - lo) * 0.382
    return out


@pytest.mark.parametrize("complete", [True, False])
def test_indicators_match_pandas(spark, complete):
    bars = supplier_bars(spark, SF001)
    got = technical_indicators(bars, complete=complete).toPandas().sort_values(["ticker", "date"])
    ref = pd.concat([pandas_indicators(g) for _, g in bars.toPandas().groupby("ticker")]).sort_values(["ticker", "date"])
    assert len(got) == len(ref)
    for col in ["sma_20", "sma_50", "ema_20", "rsi_14", "macd", "macd_signal", "atr_14", "obv",
                "volatility_20", "bb_upper", "fib_38_2"]:
        a, b = got[col].to_numpy(dtype=float), ref[col].to_numpy(dtype=float)
        assert (np.isnan(a) == np.isnan(b)).all(), col
        m = ~np.isnan(a)
        np.testing.assert_allclose(a[m], b[m], rtol=1e-9, atol=1e-7, err_msg=col)


def test_returns_match_pandas(spark):
    bars = supplier_bars(spark, SF001)
    got = returns(bars).toPandas().sort_values(["ticker", "date"])
    pdf = bars.toPandas().sort_values(["ticker", "date"])
    for name, k in [("daily", 1), ("weekly", 5), ("monthly", 21), ("annual", 252)]:
        ref = pdf.groupby("ticker")["close"].pct_change(periods=k).round(4).to_numpy()
        a = got[f"var_{name}"].to_numpy(dtype=float)
        assert (np.isnan(a) == np.isnan(ref)).all()
        m = ~np.isnan(a)
        np.testing.assert_array_equal(a[m], ref[m])
