"""Landed-file sources and the bootstrap / universe / snapshot stages."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candela.operators.merge import refresh_history
from candela.plans.tables import (
    bootstrap_history, build_universe, clean_prices, fundamentals_from_quotes, rank_fundamentals,
)
from candela.sources.landed import read_prices_csv
from candela.sources.reshape import long_to_wide
from conftest import make_bars


def test_price_csv_half_open_range(spark):
    d = tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")
    path = os.path.join(d, "prices.csv")
    with open(path, "w") as fh:
        fh.write("Date,Ticker,Open,High,Low,Close,Volume\n")
        for day in range(1, 6):
            fh.write(f"2024-01-0{day},AAA,1.23456,2,1,1.5,{day}00\n")
        fh.write("2024-01-03,,1,1,1,1,1\n")  # no ticker: dropped by the cleaning step
    raw = read_prices_csv(spark, path, start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 5))
    got = clean_prices(raw).orderBy("date").collect()
    assert [r.date.day for r in got] == [2, 3, 4]
    assert got[0].open == 1.235 and got[0].volume == 200 and got[0].ticker == "AAA"


def _csv(text):
    d = tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")
    path = os.path.join(d, "file.csv")
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_columns_are_found_by_name(spark):
    path = _csv("DATE,ticker,Adj Close,Close,High,Low,Open,volume\n2024-01-02,AAA,9.5,4,3,2,1,NaN\nbad,BBB,x,x,x,x,x,x\n")
    r = read_prices_csv(spark, path).orderBy("Ticker").collect()
    assert (r[0].Open, r[0].High, r[0].Low, r[0].Close) == (1.0, 3.0, 2.0, 4.0)
    assert r[1].Date is None and r[1].Close is None  # unreadable values are missing
    clean = clean_prices(read_prices_csv(spark, path)).filter("ticker = 'AAA'").first()
    assert clean.volume is None and clean.close == 4.0
    with pytest.raises(ValueError, match="Volume"):
        read_prices_csv(spark, _csv("Date,Ticker,Open,High,Low,Close\n"))


def test_constituents_in_a_later_column(spark):
    from candela.sources.landed import read_constituents
    got = read_constituents(spark, _csv("Security,Symbol\nBerkshire,BRK.B\nAlpha,AAA\nNone,\n")).collect()
    assert sorted(r.ticker for r in got) == ["AAA", "BRK-B"]


def test_rows_arrive_in_file_order(spark):
    path = _csv("Date,Ticker,Open,High,Low,Close,Volume\n" + "".join(f"2024-01-02,A,1,1,1,{i},1\n" for i in range(50)))
    df = read_prices_csv(spark, path, arrival=True)
    assert [r.Close for r in df.orderBy("arrival").collect()] == [float(i) for i in range(50)]


def test_wide_file_with_a_date_range(spark):
    from candela.sources.landed import read_wide_prices_csv
    path = _csv("Date,AA|Open,AA|Close,BB|Close,BB|Open,note\n2024-01-01,1,2,3,4,x\n2024-01-02,5,6,,,x\n2024-01-03,7,8,9,10,x\n")
    wide = read_wide_prices_csv(spark, path, start=dt.date(2024, 1, 1), end=dt.date(2024, 1, 3))
    from candela.sources.reshape import wide_to_long
    got = sorted((r.ticker, r.date.day, r.open, r.close) for r in wide_to_long(wide).collect())
    assert got == [("AA", 1, 1.0, 2.0), ("AA", 2, 5.0, 6.0), ("BB", 1, 4.0, 3.0)]


def test_numbers_in_quotes_of_any_spelling(spark):
    q = spark.createDataFrame([("A", '{"marketCap": 2500000000.0}'), ("B", '{"marketCap": 2.5e9}'), ("C", '{"marketCap": 7}')],
                              "symbol string, quote string")
    assert [(r.ticker, r.market_cap) for r in build_universe(q).collect()] == [("A", 2500000000), ("B", 2500000000), ("C", 7)]


def test_nan_is_missing_from_the_cleaning_on(spark):
    from candela.operators.technical import technical_indicators
    bars = make_bars(spark, {"A": [1.0] * 30 + [float("nan")] + [2.0] * 30})
    clean = clean_prices(bars)
    assert clean.filter("isnan(close)").count() == 0 and clean.filter("close IS NULL").count() == 1
    out = technical_indicators(clean).orderBy("date").collect()
    assert out[30].sma_20 is None and out[30].close is None and out[55].sma_20 is not None
    assert not any(isinstance(v, float) and v != v for r in out for v in r)


def test_universe_top_k(spark):
    q = spark.createDataFrame(
        [(f"T.{i}", f'{{"marketCap": {i % 7}, "shortName": "n{i}"}}') for i in range(20)] + [("Z", "{}")],
        "symbol string, quote string")
    top = build_universe(q, k=5).collect()
    assert [(r.ticker, r.market_cap) for r in top] == [("T-13", 6), ("T-6", 6), ("T-12", 5), ("T-19", 5), ("T-5", 5)]
    assert len(build_universe(q, k=500).collect()) == 21


def test_fundamentals_snapshot_from_quotes(spark):
    q = spark.createDataFrame(
        [("A", '{"trailingPE": 12.5, "marketCap": 10, "sharesOutstanding": 3}', False),
         ("B", "garbage", False), ("C", '{"marketCap": 99}', True)],
        "ticker string, quote string, failed boolean")
    snap = fundamentals_from_quotes(q, failed="failed")
    rows = {r.ticker: r for r in snap.collect()}
    assert set(rows) == {"A", "B"}  # the failed fetch is dropped
    assert rows["A"].per == 12.5 and rows["A"].acciones_circulacion == 3
    assert rows["B"].per is None and rows["B"].market_cap is None  # unreadable -> all null
    ranked = {r.ticker: r.ranking_marketcap for r in rank_fundamentals(snap).collect()}
    assert ranked == {"A": 1, "B": None}


def test_bootstrap_from_wide(spark):
    bars = make_bars(spark, {"AA": [1.0, 2.0, 3.0], "BB": [4.0, 5.0, 6.0]})
    wide = long_to_wide(bars, ["AA", "BB"])
    back = bootstrap_history(wide)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in clean_prices(bars).collect())


def test_refresh_nothing_when_start_after_end(spark):
    hist = make_bars(spark, {"A": [1.0, 2.0]}, start=dt.date(2024, 1, 1))
    fetched = make_bars(spark, {"A": [9.0, 9.0, 9.0]}, start=dt.date(2024, 1, 2))
    # as_of before last + 1: no new rows
    same = refresh_history(hist, fetched, ["date", "ticker"], "date", F.lit(dt.date(2024, 1, 1)))
    assert sorted(tuple(r) for r in same.collect()) == sorted(tuple(r) for r in hist.collect())
    # as_of later: only the day after the history's end and onwards are added
    more = refresh_history(hist, fetched, ["date", "ticker"], "date", F.lit(dt.date(2024, 1, 3)))
    assert sorted(r.date.day for r in more.collect()) == [1, 2, 3]


def test_universe_from_landed_files(spark):
    from candela.plans.tables import universe_from_files
    from candela.sources.landed import read_constituents
    d = tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")
    path = os.path.join(d, "constituents.csv")
    with open(path, "w") as fh:
        fh.write("Symbol\nBRK.B\nAAA\nBBB\n\nAAA\n")
    cons = read_constituents(spark, path)
    assert sorted(r.ticker for r in cons.collect()) == ["AAA", "BBB", "BRK-B"]
    quotes = spark.createDataFrame([("BRK-B", '{"marketCap": 900, "shortName": "B"}'), ("AAA", '{"marketCap": 5}')],
                                   "ticker string, quote string")
    got = [(r.ticker, r.name, r.market_cap) for r in universe_from_files(cons, quotes, k=2).collect()]
    assert got == [("BRK-B", "B", 900), ("AAA", "", 5)]
    assert len(universe_from_files(cons, quotes).collect()) == 3  # BBB keeps the defaults


def test_files_of_several_layouts_in_one_folder(spark):
    d = tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")
    files = {"a.csv": "Date,Ticker,Open,High,Low,Close,Volume\n2024-01-02,A,1,4,0,2,10\n",
             "b [1] %20.csv": "volume,CLOSE,Low,High,Open,Ticker,Date\n20,2.5,0,4,1,B,2024-01-02\n21,2.6,0,4,1,B,2024-01-03\n",
             "c.csv": "﻿Date,Adj Close,Ticker,Open,High,Low,Close,Volume\n2024-01-02,99,C,1,4,0,3,30\n",
             "d.csv": "Date,Ticker,Open,High,Low,Close,Volume\r\n2024-01-03,A,1,4,0,7,11\r\n",
             "e.csv": "Date,Ticker,Open,High,Low,Close,Volume\n", "f.csv": ""}
    for name, text in files.items():
        with open(os.path.join(d, name), "w", newline="") as fh:
            fh.write(text)
    got = sorted((r.Ticker, r.Date.day, r.Close, r.Volume) for r in read_prices_csv(spark, d, arrival=True).collect())
    assert got == [("A", 2, 2.0, 10.0), ("A", 3, 7.0, 11.0), ("B", 2, 2.5, 20.0), ("B", 3, 2.6, 21.0), ("C", 2, 3.0, 30.0)]
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert int(str(split).rstrip("b")) < 1 << 40  # the caller's session keeps its settings
    with open(os.path.join(d, "g.csv"), "w") as fh:
        fh.write("Date,Ticker\n2024-01-02,A\n")
    with pytest.raises(ValueError, match="g.csv has no column Open"):
        read_prices_csv(spark, d)
