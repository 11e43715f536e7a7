"""Indicator formulas as ``Column`` builders over a per-ticker date window.

All take the window ``w = Window.partitionBy(ticker).orderBy(date)``.
Prices go through :func:`thousandths` so sums are exact integers.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from candela.functions.rolling import (
    clip_lower_zero, gated, rolling_mean_exact, rolling_std_exact, running, thousandths, trailing,
)


def sma(w: WindowSpec, close: Column, n: int) -> Column:
    """Simple moving average, null until ``n`` closes are in the window."""
    return rolling_mean_exact(w, thousandths(close), n)


def rolling_std(w: WindowSpec, close: Column, n: int) -> Column:
    """Rolling sample standard deviation (ddof=1), gated like :func:`sma`."""
    return rolling_std_exact(w, thousandths(close), n)


def bollinger(w: WindowSpec, close: Column, n: int = 20, k: float = 2.0) -> tuple[Column, Column, Column]:
    """(middle, upper, lower): SMA n and SMA +/- k deviations."""
    mid = sma(w, close, n)
    dev = rolling_std(w, close, n)
    return mid, mid + F.lit(k) * dev, mid - F.lit(k) * dev


def rsi(w: WindowSpec, close: Column, window: int = 14) -> Column:
    """Relative strength index with simple (not Wilder) averages.

    gain = max(diff, 0), loss = max(-diff, 0), averaged over ``window``
    differences; first value on row ``window + 1``.  Loss 0 and gain > 0 give
    100, both 0 give null, gain 0 and loss > 0 give 0."""
    px = thousandths(close)
    d = px - F.lag(px).over(w)
    gain = clip_lower_zero(d)
    loss = clip_lower_zero(-d)
    sg = F.sum(gain).over(trailing(w, window)).cast("double")
    sl = F.sum(loss).over(trailing(w, window)).cast("double")
    value = (F.when(sl == F.lit(0.0), F.when(sg > F.lit(0.0), F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + sg / sl)))
    return gated(w, d, window, value)


def true_range_units(w: WindowSpec, high: Column, low: Column, close: Column) -> Column:
    """max(h - l, |h - c_prev|, |l - c_prev|) in thousandths; nulls skipped,
    so the first row is h - l."""
    h, lo, c = thousandths(high), thousandths(low), thousandths(close)
    cp = F.lag(c).over(w)
    return F.greatest(h - lo, F.abs(h - cp), F.abs(lo - cp))


def atr(w: WindowSpec, high: Column, low: Column, close: Column, window: int = 14) -> Column:
    """Average true range: simple mean of ``window`` true ranges."""
    return rolling_mean_exact(w, true_range_units(w, high, low, close), window)


def obv(w: WindowSpec, close: Column, volume: Column) -> Column:
    """On-balance volume: running sum of sign(close diff) * volume, a missing
    term counting as 0."""
    d = close - F.lag(close).over(w)
    step = (F.when(d > F.lit(0), volume).when(d < F.lit(0), -volume).when(d == F.lit(0), F.lit(0)))
    return F.sum(F.coalesce(step.cast("bigint"), F.lit(0).cast("bigint"))).over(running(w))
