"""The per-ticker technical indicator table (24 columns) and its pieces.

One hash exchange on ``ticker`` feeds every window below: rolling windows,
whole-series windows and the block-scanned exponential averages all
partition by ``ticker`` (the scan adds its block to the key, which the
existing ``hashpartitioning(ticker)`` already satisfies, so it only re-sorts).
A ticker's series holds one row per trading date, so a window partition is
bounded by the calendar, whatever the size of the raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.rolling import EXACT, clip_lower_zero, series_window, thousandths
from candela.operators.scan import (
    add_blocks, block_rows, drop_blocks, ewm_adjust_false, ewm_complete, ewm_gap_aware,
)

# Columns of the indicator table.
INDICATOR_COLUMNS = [
    "date", "ticker", "close",
    "sma_20", "sma_50", "ema_20",
    "rsi_14", "macd", "macd_signal", "macd_hist",
    "atr_14", "obv",
    "bb_middle", "bb_upper", "bb_lower",
    "volatility_20",
    "fib_0_0", "fib_23_6", "fib_38_2", "fib_50_0", "fib_61_8", "fib_100",
    "nivel_fib_cercano", "estado_fibonacci",
]

# Fibonacci retracement ratios, level labels and level states.
FIB_LEVELS = [
    ("fib_0_0", "0.0%", 0.0),
    ("fib_23_6", "23.6%", 0.236),
    ("fib_38_2", "38.2%", 0.382),
    ("fib_50_0", "50.0%", 0.50),
    ("fib_61_8", "61.8%", 0.618),
    ("fib_100", "100%", 1.0),
]
SUPPORT_LEVELS = ["38.2%", "50.0%", "61.8%"]
RESISTANCE_LEVELS = ["0.0%", "23.6%"]


def ema(df: DataFrame, value: str = "close", span: int = 20, out: str | None = None,
        keys: list[str] | None = None, order: str = "date", complete: bool = False) -> DataFrame:
    """Exponential moving average (``adjust=False``), no warm-up gate."""
    keys = keys or ["ticker"]
    out = out or f"ema_{span}"
    if not complete:
        return ewm_adjust_false(df, keys, order, value, span, out)
    b = block_rows([span])
    df = add_blocks(df, keys, order, value, b, "_eb")
    return drop_blocks(ewm_complete(df, keys, order, value, {out: span}, "_eb", b), "_eb")


def macd(df: DataFrame, value: str = "close", short: int = 12, long: int = 26, signal: int = 9,
         keys: list[str] | None = None, order: str = "date", complete: bool = False) -> DataFrame:
    """MACD line (EMA short - EMA long), its signal EMA and the histogram."""
    keys = keys or ["ticker"]
    if complete:
        df = _macd_complete(df, keys, order, value, short, long, signal)
    else:
        df = ewm_gap_aware(df, keys, order, value, {"_ema_short": short, "_ema_long": long})
        df = df.withColumn("macd", F.col("_ema_short") - F.col("_ema_long"))
        df = ewm_adjust_false(df, keys, order, "macd", signal, "macd_signal")
    return (df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
              .drop("_ema_short", "_ema_long"))


def _macd_complete(df: DataFrame, keys: list[str], order: str, value: str, short: int, long: int,
                   signal: int, extra: dict[str, float] | None = None, rn: str | None = None,
                   first: str | None = None) -> DataFrame:
    """MACD line and signal (and any ``extra`` spans of ``value``) on one
    shared block layout: one sort for all of them."""
    b = block_rows([short, long, signal, *(extra or {}).values()])
    df = add_blocks(df, keys, order, value, b, "_eb", rn=rn, first=first)
    df = ewm_complete(df, keys, order, value, {"_ema_short": short, "_ema_long": long, **(extra or {})},
                      "_eb", b)
    df = df.withColumn("macd", F.col("_ema_short") - F.col("_ema_long"))
    df = ewm_complete(df, keys, order, "macd", {"macd_signal": signal}, "_eb", b)
    return drop_blocks(df, "_eb").drop("_ema_short", "_ema_long")


def _fib_from(hi: Column, lo: Column, last_close: Column) -> dict[str, Column]:
    span = hi - lo
    levels = {}
    for name, _label, ratio in FIB_LEVELS:
        if ratio == 0.0:
            levels[name] = hi
        elif ratio == 1.0:
            levels[name] = lo
        else:
            levels[name] = hi - span * F.lit(ratio)
    candidates = F.array(*[
        F.struct(F.abs(last_close - levels[name]).alias("dist"), F.lit(i).alias("pos"),
                 F.lit(label).alias("label"))
        for i, (name, label, _r) in enumerate(FIB_LEVELS)
    ])
    return {**levels, "nivel_fib_cercano": F.array_min(candidates).getField("label")}


def with_fibonacci(df: DataFrame, keys: list[str], order: str, close: str = "close",
                   extra: dict[str, Column] | None = None) -> DataFrame:
    """Add the six levels, the nearest level and its state.

    The three whole-series values use the series' date order with a full
    frame (``last`` over it is the last close), i.e. the same window spec as
    the rolling pass, so Spark evaluates them in that pass's Window operator.
    ``extra`` columns over the same full frame join them."""
    full = (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    c = F.col(close)
    df = df.withColumns({"_fhi": F.max(c).over(full), "_flo": F.min(c).over(full),
                         "_flast": F.last(c).over(full), **(extra or {})})
    df = df.withColumns(_fib_from(F.col("_fhi"), F.col("_flo"), F.col("_flast")))
    return (df.withColumn("estado_fibonacci", fib_state(F.col("nivel_fib_cercano")))
              .drop("_fhi", "_flo", "_flast"))


def fib_state(level: Column) -> Column:
    return (F.when(level.isin(SUPPORT_LEVELS), F.lit("SOPORTE"))
            .when(level.isin(RESISTANCE_LEVELS), F.lit("RESISTENCIA"))
            .when(level.isNotNull(), F.lit("NEUTRO")))


def fibonacci(bars: DataFrame, keys: list[str] | None = None, order: str = "date") -> DataFrame:
    keys = keys or ["ticker"]
    return with_fibonacci(bars.select(order, *keys, "close"), keys, order)


def rolling_block(df: DataFrame, keys: list[str], order: str, complete: bool = False,
                  keep_rn: bool = False, prev_close: str | None = None) -> DataFrame:
    """SMA 20/50, RSI 14, ATR 14, OBV, Bollinger 20 and the 20-row deviation
    in three window passes over one sort.

    Trailing sums are exact integer running sums minus the running sum
    ``n`` rows back (``lag`` with a constant offset): O(rows) per series,
    where a sliding frame would re-aggregate every frame."""
    w = series_window(keys, order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cu, hu, lu = thousandths(F.col("close")), thousandths(F.col("high")), thousandths(F.col("low"))
    df = df.withColumns({"_cu": cu, "_hu": hu, "_lu": lu,
                         "_pc": F.col(prev_close) if prev_close else F.lag("close").over(w)})
    prev_cu = thousandths(F.col("_pc"))
    d_close = F.col("close") - F.col("_pc")
    hu, lu = F.col("_hu"), F.col("_lu")
    df = df.withColumns({
        "_dcu": F.col("_cu") - prev_cu,
        "_tr": F.greatest(hu - lu, F.abs(hu - prev_cu), F.abs(lu - prev_cu)),
        "_obv": (F.when(d_close > F.lit(0), F.col("volume")).when(d_close < F.lit(0), -F.col("volume"))
                 .when(d_close == F.lit(0), F.lit(0))).cast("bigint"),
    })
    dcu, cu_c = F.col("_dcu"), F.col("_cu")
    sums = {
        "_r_cu": F.sum(cu_c).over(run),
        "_r_cu2": F.sum(cu_c.cast(EXACT) * cu_c.cast(EXACT)).over(run),
        "_r_g": F.sum(clip_lower_zero(dcu)).over(run),
        "_r_l": F.sum(clip_lower_zero(-dcu)).over(run),
        "_r_tr": F.sum("_tr").over(run),
        "obv": F.sum(F.coalesce(F.col("_obv"), F.lit(0).cast("bigint"))).over(run),
    }
    if complete:
        # No missing close: the number of values in a trailing window follows
        # from the row number alone.
        sums["_rn"] = F.row_number().over(w)
    else:
        sums.update({"_n_cu": F.count(cu_c).over(run), "_n_d": F.count(dcu).over(run),
                     "_n_tr": F.count("_tr").over(run)})
    df = df.withColumns(sums)

    def last_n(col: str, n: int) -> Column:
        return F.col(col) - F.coalesce(F.lag(col, n).over(w), F.lit(0))

    trailing = {"_s20": last_n("_r_cu", 20), "_q20": last_n("_r_cu2", 20), "_s50": last_n("_r_cu", 50),
                "_sg": last_n("_r_g", 14), "_sl": last_n("_r_l", 14), "_str": last_n("_r_tr", 14)}
    if complete:
        rn = F.col("_rn")
        trailing.update({"_c20": F.least(rn, F.lit(20)), "_c50": F.least(rn, F.lit(50)),
                         "_cd": F.least(rn - F.lit(1), F.lit(14)), "_ctr": F.least(rn, F.lit(14))})
    else:
        trailing.update({"_c20": last_n("_n_cu", 20), "_c50": last_n("_n_cu", 50),
                         "_cd": last_n("_n_d", 14), "_ctr": last_n("_n_tr", 14)})
    df = df.withColumns(trailing)
    s20, s50 = F.col("_s20").cast("double"), F.col("_s50").cast("double")
    sma20 = F.when(F.col("_c20") == F.lit(20), s20 / F.lit(20000.0))
    numer = (F.lit(20).cast(EXACT) * F.col("_q20") - F.col("_s20").cast(EXACT) * F.col("_s20").cast(EXACT))
    dev20 = F.when(F.col("_c20") == F.lit(20),
                   F.sqrt(numer.cast("double") / F.lit(380.0)) / F.lit(1000.0))
    sg, sl = F.col("_sg").cast("double"), F.col("_sl").cast("double")
    rsi = F.when(F.col("_cd") == F.lit(14),
                 F.when(sl == F.lit(0.0), F.when(sg > F.lit(0.0), F.lit(100.0)))
                 .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + sg / sl)))
    df = df.withColumns({
        "sma_20": sma20,
        "sma_50": F.when(F.col("_c50") == F.lit(50), s50 / F.lit(50000.0)),
        "rsi_14": rsi,
        "atr_14": F.when(F.col("_ctr") == F.lit(14), F.col("_str").cast("double") / F.lit(14000.0)),
        "bb_middle": sma20,
        "bb_upper": sma20 + F.lit(2.0) * dev20,
        "bb_lower": sma20 - F.lit(2.0) * dev20,
        "volatility_20": dev20,
    })
    return df.drop("_cu", "_hu", "_lu", "_pc", "_dcu", "_tr", "_obv", "_r_cu", "_r_cu2", "_n_cu", "_r_g",
                   "_r_l", "_n_d", "_r_tr", "_n_tr", "_s20", "_c20", "_q20", "_s50", "_c50", "_sg", "_sl",
                   "_cd", "_str", "_ctr", *([] if keep_rn and complete else ["_rn"]))


def technical_indicators(bars: DataFrame, keys: list[str] | None = None, order: str = "date",
                         complete: bool = False) -> DataFrame:
    """All indicators of one daily bar table (``date, ticker, high, low,
    close, volume``), one output row per input row.

    ``complete=True`` declares that no close is missing after a series'
    first one (true of bars built by aggregation); the exponential averages
    then share one block layout and one extra sort (``ewm_complete``), and a
    violating row raises an error.  The default handles gaps exactly, at the
    cost of a few more sorts."""
    keys = keys or ["ticker"]
    df = bars.select(order, *keys, "close", "high", "low", "volume")
    full = (Window.partitionBy(*keys).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = {"_first": F.min(F.when(F.col("close").isNotNull(), F.col(order))).over(full)} if complete else {}
    # whole-series values and the previous close in one window pass
    prev = {"_prev_close": F.lag("close").over(Window.partitionBy(*keys).orderBy(order))}
    df = with_fibonacci(df, keys, order, extra={**first, **prev})
    df = rolling_block(df, keys, order, complete, keep_rn=complete, prev_close="_prev_close")
    df = df.drop("_prev_close")
    if complete:
        # the row number of the rolling pass and the first-date column feed the
        # block layout of the averages
        df = _ema_family_complete(df, keys, order, rn="_rn", first="_first").drop("_rn", "_first")
    else:
        df = ewm_gap_aware(df, keys, order, "close", {"ema_20": 20, "_ema_short": 12, "_ema_long": 26})
        df = df.withColumn("macd", F.col("_ema_short") - F.col("_ema_long"))
        df = ewm_adjust_false(df, keys, order, "macd", 9, "macd_signal")
    df = df.withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
    return df.select(*[c if c not in ("date", "ticker") else
                       (order if c == "date" else keys[0]) for c in INDICATOR_COLUMNS])


def _ema_family_complete(df: DataFrame, keys: list[str], order: str, rn: str | None = None,
                         first: str | None = None) -> DataFrame:
    """ema_20, macd (12 - 26) and its 9-row signal on one shared block layout."""
    return _macd_complete(df, keys, order, "close", 12, 26, 9, {"ema_20": 20}, rn=rn, first=first)
