"""The column helpers with windows of any length, against pandas."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candela.functions import indicators
from candela.functions.rolling import series_window
from conftest import make_bars


@pytest.mark.parametrize("n", [3, 14])
def test_helpers_of_other_windows(spark, n):
    rng = random.Random(n)
    closes = [round(10 + rng.random() * 5, 3) for _ in range(40)]
    bars = make_bars(spark, {"A": closes}, high_low=lambda i, c: (c + i % 3, c - 1 - i % 2))
    w = series_window()
    mid, up, low = indicators.bollinger(w, F.col("close"), n, 1.5)
    got = bars.select("date", indicators.sma(w, F.col("close"), n).alias("sma"), mid.alias("mid"), up.alias("up"), low.alias("low"),
                      indicators.rsi(w, F.col("close"), n).alias("rsi"),
                      indicators.atr(w, F.col("high"), F.col("low"), F.col("close"), n).alias("atr"),
                      indicators.obv(w, F.col("close"), F.col("volume")).alias("obv")).orderBy("date").toPandas()
    c = pd.Series(closes)
    high, below = (pd.Series([f(i, x) for i, x in enumerate(closes)]) for f in (lambda i, x: x + i % 3, lambda i, x: x - 1 - i % 2))
    d, mean, dev = c.diff(), c.rolling(n).mean(), c.rolling(n).std()
    ranges = pd.concat([high - below, (high - c.shift()).abs(), (below - c.shift()).abs()], axis=1).max(axis=1)
    gain, loss = d.clip(lower=0).rolling(n).mean(), (-d.clip(upper=0)).rolling(n).mean()
    want = {"sma": mean, "mid": mean, "up": mean + 1.5 * dev, "low": mean - 1.5 * dev, "rsi": 100 - 100 / (1 + gain / loss),
            "atr": ranges.rolling(n).mean(), "obv": ((d > 0) * 100 - (d < 0) * 100).cumsum()}
    for name, series in want.items():
        pd.testing.assert_series_equal(got[name].astype(float), series.astype(float), check_names=False, rtol=1e-9, atol=1e-9)
