"""Gated rolling statistics over a per-ticker, date-ordered window.

pandas ``rolling(n)`` yields a value only once ``n`` non-missing values sit in
the window.  Prices carry at most three decimals, so sums run over the exact
integer ``thousandths`` of a price: integer window sums are exact in any
order and on any engine, and every statistic is then one or two IEEE
operations.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"


def series_window(keys: list[str] | str = "ticker", order: str = "date") -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return Window.partitionBy(*keys).orderBy(order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def thousandths(c: Column) -> Column:
    """Price as an exact integer count of 0.001 units."""
    return F.round(c * F.lit(1000.0)).cast("bigint")


def gated(w: WindowSpec, x: Column, n: int, value: Column) -> Column:
    """``value`` where the trailing window holds ``n`` non-null ``x``, else null."""
    return F.when(F.count(x).over(trailing(w, n)) == F.lit(n), value)


def rolling_mean_exact(w: WindowSpec, units: Column, n: int, scale: float = 1000.0) -> Column:
    """Mean of the last ``n`` integer ``units`` divided by ``scale``."""
    total = F.sum(units).over(trailing(w, n)).cast("double")
    return gated(w, units, n, total / F.lit(scale * n))


def rolling_std_exact(w: WindowSpec, units: Column, n: int, scale: float = 1000.0) -> Column:
    """Sample deviation (ddof=1) of the last ``n`` integer ``units``.

    ``sqrt((n*S2 - S1^2) / (n*(n-1)))`` with S1, S2 exact integers."""
    u = units.cast(EXACT)
    s1 = F.sum(u).over(trailing(w, n))
    s2 = F.sum(u * u).over(trailing(w, n))
    numer = (F.lit(n).cast(EXACT) * s2 - s1 * s1).cast("double")
    return gated(w, units, n, F.sqrt(numer / F.lit(float(n * (n - 1)))) / F.lit(scale))


def clip_lower_zero(x: Column) -> Column:
    """max(x, 0) that keeps null as null (bare ``greatest`` would not)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0)))
