"""Tickers and ties: rules that must not change with the size of a key or a price."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candela.operators.signals import macd_signal_rule, sma_vs_ema_signal
from candela.operators.technical import technical_indicators
from candela.plans import analyst
from candela.sources.bars import supplier_ticker, suppkeys_from_tickers
from candela.sources import wide
from candela.sources.wide import read_wide_csv, write_wide_csv
from conftest import make_bars


def test_tickers_of_long_keys_stay_apart(spark):
    keys = [1, 999999, 1000000, 1000001, 12345678901]
    got = [r.t for r in spark.createDataFrame([(k,) for k in keys], "k long").select(supplier_ticker("k").alias("t")).collect()]
    assert got == ["S000001", "S999999", "S1000000", "S1000001", "S12345678901"]
    assert suppkeys_from_tickers(got) == keys


@pytest.mark.parametrize("price", [10.0, 95000.37, 700000.13])
def test_flat_series_are_ties_at_any_price(spark, price):
    bars = make_bars(spark, {"A": [price] * 900})
    ind = technical_indicators(bars, complete=True)
    labels = ind.filter("sma_20 IS NOT NULL").select(
        sma_vs_ema_signal(F.col("sma_20"), F.col("ema_20"), F.col("close")).alias("s"),
        macd_signal_rule(F.col("macd"), F.col("macd_signal"), F.col("close")).alias("m")).distinct().collect()
    assert [(r.s, r.m) for r in labels] == [("VENDER", "VENDER")]
    prices = bars.select("date", "ticker", "close")
    alerts = analyst.q10_trading_alert(ind, prices, "A").select("decision_trading").distinct().collect()
    assert [r[0] for r in alerts] == ["NEUTRO"]
    states = analyst.q12_dashboard(ind, prices, "A").select("estado_macd").distinct().collect()
    assert [r[0] for r in states] == ["MACD: Neutro"]
    assert analyst.q08_macd_above_signal(ind, "A").count() == 0


def test_averages_of_long_series_do_not_drift(spark):
    import pandas as pd

    values = [90000 + (i * 7919 % 1000) + i % 7 / 8 for i in range(3000)]
    got = [r.ema_20 for r in technical_indicators(make_bars(spark, {"A": values}), complete=True).orderBy("date").collect()]
    want = pd.Series(values).ewm(span=20, adjust=False).mean()
    assert max(abs(a - b) for a, b in zip(got, want, strict=True)) < 1e-9


def _long(df):
    return sorted(((r.ticker, r.date, r.open, r.high, r.low, r.close, r.volume) for r in df.collect()), key=str)


def test_wide_files_of_any_width(spark, monkeypatch):
    path = os.path.join(tempfile.mkdtemp(prefix="candela-test-", dir="/tmp"), "wide")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    bars = spark.range(10_000).select(F.concat(F.lit("T"), F.col("id")).alias("ticker"), "id").withColumn(
        "date", F.explode(F.array(*map(F.lit, days)))).where("id % 7 <> day(date)").select(
        "date", "ticker", *[(F.col("id") + k + 0.125).alias(c) for k, c in enumerate(("open", "high", "low", "close"))], "id").withColumn(
        "volume", F.when(F.col("id") % 5 > 0, F.col("id"))).drop("id").withColumn("close", F.when(F.col("close") % 3 > 1, F.col("close")))
    write_wide_csv(bars, path, files=2)
    back = read_wide_csv(spark, path)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 60_000 and "T123" not in plan  # it does not grow with the tickers
    want = _long(bars.withColumn("volume", F.col("volume").cast("double")))
    assert _long(back) == want
    assert {r.date for r in read_wide_csv(spark, path, days[1], days[2]).select("date").distinct().collect()} == {days[1]}
    monkeypatch.setattr(wide, "BROADCAST_CHARS", 10)  # headers by a shuffle
    assert _long(read_wide_csv(spark, path)) == want


def test_wide_files_with_headers_of_their_own(spark):
    d = tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")
    files = {"a.csv": 'Date,"AA|Open",AA|Close,note\n2024-01-01,1,2,x\n2024-01-02,,,x\nbad,1,1,x\n',
             "b.csv": "DATE,BB|close,AA|close,AA|Adj Close\n2024-01-03,5,oops,9\n2024-01-04,6\n", "c.csv": ""}
    for name, text in files.items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    got = sorted(((r.ticker, r.date.day if r.date else None, r.open, r.close) for r in read_wide_csv(spark, d).collect()), key=str)
    assert got == [("AA", 1, 1.0, 2.0), ("AA", None, 1.0, 1.0), ("BB", 3, None, 5.0), ("BB", 4, None, 6.0)]
    empty = spark.createDataFrame([], "date date, ticker string, open double, high double, low double, close double, volume double")
    write_wide_csv(empty, os.path.join(d, "none"))
    assert read_wide_csv(spark, os.path.join(d, "none")).count() == 0


def test_rank_of_one_ticker_is_the_rank_among_all(spark):
    from candela.operators.ranking import rank_desc_nulls_null

    df = spark.createDataFrame([("A", 5), ("B", 9), ("C", 5), ("D", None), ("E", 1)], "ticker string, market_cap long")
    ranks = {r.ticker: r.rk for r in rank_desc_nulls_null(df, "market_cap", "ticker", "rk").collect()}
    assert ranks == {"B": 1, "A": 2, "C": 3, "E": 4, "D": None}
    for t, k in ranks.items():
        assert analyst.ranked_fundamentals(df, t).first().ranking_marketcap == k
