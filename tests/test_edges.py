"""Hand-made edge series (FIXTURES section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.functions.tickers import normalize_ticker
from candela.operators.returns import returns
from candela.operators.scan import ewm_adjust_false
from candela.operators.signals import investment_summary
from candela.operators.technical import technical_indicators
from candela.plans.tables import clean_companies, rank_fundamentals
from conftest import make_bars


def ind(spark, series, complete=True):
    df = technical_indicators(make_bars(spark, series), complete=complete)
    out = {t: [] for t in series}
    for r in df.orderBy("ticker", "date").collect():
        out[r.ticker].append(r.asDict())
    return out


def first_present(rows, col):
    return next((i for i, r in enumerate(rows) if r[col] is not None), None)


@pytest.mark.parametrize("complete", [True, False])
def test_warm_up_rows(spark, complete):
    series = {f"T{n}": [100.0 + (i * 7) % 11 for i in range(n)] for n in (13, 14, 15, 19, 20, 49, 50)}
    out = ind(spark, series, complete)
    r50 = out["T50"]
    assert first_present(r50, "atr_14") == 13
    assert first_present(r50, "rsi_14") == 14
    assert first_present(r50, "sma_20") == 19
    assert first_present(r50, "bb_upper") == 19
    assert first_present(r50, "sma_50") == 49
    assert first_present(r50, "ema_20") == 0
    assert first_present(out["T13"], "atr_14") is None
    assert first_present(out["T14"], "rsi_14") is None
    assert first_present(out["T15"], "rsi_14") == 14
    assert first_present(out["T19"], "sma_20") is None
    assert first_present(out["T49"], "sma_50") is None


def test_rising_falling_rsi(spark):
    out = ind(spark, {"UP": [float(i) for i in range(1, 31)], "DN": [float(i) for i in range(30, 0, -1)]})
    assert {r["rsi_14"] for r in out["UP"][14:]} == {100.0}
    assert {r["rsi_14"] for r in out["DN"][14:]} == {0.0}


def test_flat_series(spark):
    bars = make_bars(spark, {"FL": [10.0] * 60}, high_low=lambda i, c: (c, c))
    rows = technical_indicators(bars, complete=True).orderBy("date").collect()
    last = rows[-1]
    assert last.rsi_14 is None
    assert last.bb_upper == last.bb_lower == last.close == 10.0
    assert last.nivel_fib_cercano == "0.0%" and last.estado_fibonacci == "RESISTENCIA"
    fund = bars.sparkSession.createDataFrame(
        [("FL", None, None, None, None)], "ticker string, per double, roe double, eps_growth_yoy double, deuda_patrimonio double")
    s = investment_summary(technical_indicators(bars, complete=True), fund).collect()[0]
    assert s.estado_bollingerbands == "Normal"
    assert s.sma_vs_ema == "VENDER" and s.macd == "VENDER"
    assert s.pct_fundamental_buy is None


def test_null_close_in_the_middle(spark):
    closes = [100.0 + i for i in range(40)]
    closes[25] = None
    bars = make_bars(spark, {"G": closes})
    rows = technical_indicators(bars, complete=False).orderBy("date").collect()
    # the trailing 20-row window holds the gap for rows 25..44 -> null
    assert all(r.sma_20 is None for r in rows[25:40])
    assert rows[24].sma_20 is not None
    # OBV adds 0 on the gap row and the row after it
    assert rows[25].obv == rows[24].obv and rows[26].obv == rows[25].obv
    # the average carries over the gap
    assert rows[25].ema_20 == rows[24].ema_20
    r = returns(bars).orderBy("date").collect()
    assert r[26].var_daily == round(126.0 / 124.0 - 1, 4)  # pct change over the filled value
    with pytest.raises(Exception):
        technical_indicators(bars, complete=True).collect()


def test_null_close_on_last_row(spark):
    rows = ind(spark, {"L": [10.0, 20.0, 15.0, None]}, complete=False)["L"]
    assert rows[-1]["nivel_fib_cercano"] == "0.0%" and rows[-1]["estado_fibonacci"] == "RESISTENCIA"


def test_ewm_gap_example(spark):
    df = spark.createDataFrame([("A", i, x) for i, x in enumerate([1.0, None, 4.0, 5.0])],
                               "ticker string, date int, x double")
    got = [r.y for r in ewm_adjust_false(df, ["ticker"], "date", "x", 3, "y").orderBy("date").collect()]
    assert got == pytest.approx([1.0, 1.0, 3.0, 4.0], rel=1e-12)


def test_zero_base_price(spark):
    r = returns(make_bars(spark, {"Z": [0.0, 5.0, 6.0]})).orderBy("date").collect()
    assert r[1].var_daily is None and r[2].var_daily == 0.2


def test_equal_distance_takes_earlier_level(spark):
    rows = ind(spark, {"E": [0.0, 1000.0, 441.0]})["E"]
    assert rows[-1]["fib_50_0"] == 500.0 and rows[-1]["fib_61_8"] == 382.0
    assert rows[-1]["nivel_fib_cercano"] == "50.0%" and rows[-1]["estado_fibonacci"] == "SOPORTE"


def test_market_cap_ranking_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("B", 10), ("A", 10), ("C", 30), ("D", None), ("E", 5)], "ticker string, market_cap bigint")
    for c in ["name", "per", "roe", "eps_growth_yoy", "deuda_patrimonio", "margen_neto", "dividend_yield"]:
        df = df.withColumn(c, F.lit(None).cast("string" if c == "name" else "double"))
    df = df.withColumn("acciones_circulacion", F.lit(1).cast("bigint"))
    ranks = {r.ticker: r.ranking_marketcap for r in rank_fundamentals(df).collect()}
    assert ranks == {"C": 1, "A": 2, "B": 3, "E": 4, "D": None}


def test_buys_equal_sells_is_hold(spark):
    bars = make_bars(spark, {"H": [10.0 + (i % 5) for i in range(60)]})
    fund = spark.createDataFrame([("H", 10.0, 0.01, None, None)],
                                 "ticker string, per double, roe double, eps_growth_yoy double, deuda_patrimonio double")
    s = investment_summary(technical_indicators(bars, complete=True), fund).collect()[0].asDict()
    labels = [s[k] for k in ("sma_vs_ema", "macd", "rsi", "per", "roe", "eps_growth_yoy", "deuda_patrimonio")]
    fib = {"SOPORTE": "COMPRAR", "RESISTENCIA": "VENDER"}.get(s["estado_fibonacci"], "MANTENER")
    buys = labels.count("COMPRAR") + (fib == "COMPRAR")
    sells = labels.count("VENDER") + (fib == "VENDER")
    expected = "COMPRAR" if buys > sells else "VENDER" if sells > buys else "MANTENER"
    assert s["decision_final"] == expected


def test_hold_on_tie_direct(spark):
    from candela.operators.signals import decision
    df = spark.createDataFrame([("COMPRAR", "VENDER", None)], "a string, b string, c string")
    assert df.select(decision([F.col("a"), F.col("b"), F.col("c")]).alias("d")).first().d == "MANTENER"


def test_ticker_normalised(spark):
    df = spark.createDataFrame([("BRK.B", "n", "s", "i")], "Ticker string, Name string, Sector string, Industry string")
    assert clean_companies(df).first().ticker == "BRK-B"
    assert spark.range(1).select(normalize_ticker(F.lit("BF.B")).alias("t")).first().t == "BF-B"


def test_row_order_irrelevant(spark):
    series = {"A": [50.0 + (i * 13) % 17 for i in range(80)], "B": [20.0 + (i * 5) % 7 for i in range(80)]}
    bars = make_bars(spark, series)
    shuffled = bars.orderBy(F.rand(3)).repartition(5)
    a = technical_indicators(bars, complete=True).orderBy("ticker", "date").collect()
    b = technical_indicators(shuffled, complete=True).orderBy("ticker", "date").collect()
    assert a == b


def test_properties(spark):
    series = {"P": [50.0 + ((i * 37) % 23) - (i % 4) for i in range(120)]}
    for r in ind(spark, series)["P"]:
        assert r["fib_100"] <= r["close"] <= r["fib_0_0"]
        if r["bb_upper"] is not None:
            assert r["bb_lower"] <= r["bb_middle"] <= r["bb_upper"]
        if r["rsi_14"] is not None:
            assert 0.0 <= r["rsi_14"] <= 100.0
        assert abs(r["macd_hist"] - (r["macd"] - r["macd_signal"])) < 1e-12


def test_returns_unaffected_by_other_tickers(spark):
    a = make_bars(spark, {"A": [10.0, 11.0, 12.5, 12.0]})
    ab = make_bars(spark, {"A": [10.0, 11.0, 12.5, 12.0], "B": [1.0, 2.0, 3.0, 4.0]})
    ra = returns(a).orderBy("date").collect()
    rab = returns(ab).filter(F.col("ticker") == "A").orderBy("date").collect()
    assert ra == rab


def test_dates_are_dates(spark):
    r = returns(make_bars(spark, {"A": [1.0, 2.0]}, start=dt.date(2001, 1, 1))).first()
    assert r.date == dt.date(2001, 1, 1)


@pytest.mark.parametrize("span", [3, 9, 26])
def test_gap_aware_average_with_long_gaps(spark, span):
    """Runs of missing values make short, uneven decay blocks, where the
    carry from two blocks back matters; compare with pandas."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(span)
    xs = []
    while len(xs) < 2500:
        xs += [float(v) for v in rng.uniform(10, 90, int(rng.integers(1, 30)))]
        xs += [None] * int(rng.integers(0, 60))
    df = spark.createDataFrame([("G", i, x) for i, x in enumerate(xs)], "ticker string, date int, x double")
    got = np.array([r.y for r in ewm_adjust_false(df, ["ticker"], "date", "x", span, "y").orderBy("date").collect()],
                   dtype=float)
    ref = pd.Series(xs, dtype=float).ewm(span=span, adjust=False).mean().to_numpy()
    assert (np.isnan(got) == np.isnan(ref)).all()
    m = ~np.isnan(ref)
    np.testing.assert_allclose(got[m], ref[m], rtol=1e-10)
