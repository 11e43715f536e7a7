"""Named queries over a scale-factor folder: ``name -> f(spark, sf_dir)``.

Every entry reads the whole driver tables (a ticker parameter narrows only
the analyst queries, as in the shipped SQL).  Values computed from exact
integer sums are returned as they are; the exponential-average family, whose
block-scanned values carry ~1e-13 relative noise, is returned at 3 decimals,
the scale the indicator table stores ``ema_20`` at.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators import merge
from candela.operators.integrity import duplicate_keys, orphans
from candela.operators.ranking import top_k
from candela.operators.returns import returns
from candela.operators.signals import investment_summary
from candela.operators.technical import ema, fibonacci, macd, rolling_block, technical_indicators
from candela.plans import analyst, stored
from candela.plans import tables as tb
from candela.sources.bars import LINE_ORDER, brand_bars, supplier_bars, supplier_ticker
from candela.sources.landed import parse_quote, quote_columns
from candela.sources.reference import FUNDAMENTAL_COLUMNS, companies, fundamentals
from candela.sources.tables import read_table

TICKER = "S000001"
BATCH1_END = dt.date(1999, 12, 31)
BATCH2_START = dt.date(1999, 6, 1)
REFETCH_START = dt.date(2000, 6, 1)
SECOND_CUT = dt.date(2000, 6, 1)
LANDED_FROM, LANDED_TO = dt.date(1995, 1, 1), dt.date(2000, 1, 1)
LAST_DAY = dt.date(2100, 1, 1)  # after all data
BUCKETS = 8
TOP_K = 40
OVERBOUGHT = 60.0  # the prices are independent draws: no RSI among them passes 70
EMA_FAMILY = ("ema_20", "macd", "macd_signal", "macd_hist")
CHECK_DECIMALS = 3

Query = Callable[[SparkSession, str], DataFrame]


def at_check_precision(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, CHECK_DECIMALS) for c in EMA_FAMILY if c in df.columns})


def last_bar_date(spark: SparkSession, sf_dir: str) -> Column:
    """max(date) over all bars, as a scalar subquery (the data ends in 2001,
    so this stands in for CURRENT_DATE)."""
    return read_table(spark, sf_dir, "lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).scalar()


def _prices(spark, sf, tickers=None):
    return tb.precios_historicos(spark, sf, tickers)


def _rolling(*columns: str) -> Query:
    """Columns of the rolling pass that the indicator table runs."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rolling_block(tb.price_series(spark, sf), ["ticker"], "date").select("date", "ticker", "close", *columns)
    return run


def _long_prices(spark, sf):
    """Brand bars: series of 1,277 rows and more, over several blocks of the averages."""
    return tb.clean_prices(brand_bars(spark, sf))


def _batches(spark, sf):
    p = _prices(spark, sf)
    b1 = p.filter(F.col("date") <= F.lit(BATCH1_END))
    b2 = p.filter(F.col("date") >= F.lit(BATCH2_START)).withColumn("close", F.col("close") + F.lit(1.0))
    return b1, b2


def _quote_map_defaults(spark, sf):
    ev = read_table(spark, sf, "events").select("event_id", "props")
    q = parse_quote(F.col("props"))
    cols = quote_columns(q, with_defaults=True)
    return ev.select("event_id", *cols.values(),
                     F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def _wide_to_long(spark, sf):
    """All brand bars through a folder of wide files and back."""
    return stored.wide_round_trip(spark, _long_prices(spark, sf))


def _top_market_cap(spark, sf):
    f = fundamentals(spark, sf).select("ticker", "market_cap")
    uni = (companies(spark, sf).join(f, "ticker", "left")
           .select("ticker", "name", "sector", "industry",
                   F.coalesce(F.col("market_cap"), F.lit(0).cast("bigint")).alias("market_cap")))
    return top_k(uni, [F.col("market_cap").desc(), F.col("ticker").asc()], TOP_K)


def _daily_refresh(spark, sf):
    """The history to 1999, then two overlapping fetches: of rows in both the
    second, later one counts."""
    b1, b2 = _batches(spark, sf)
    again = (b2.filter(F.col("date") >= F.lit(REFETCH_START)).withColumn("close", F.col("close") + F.lit(1.0))
             .withColumn("seq", F.lit(2)))
    return merge.refresh_history(b1, b2.withColumn("seq", F.lit(1)).unionByName(again), ["date", "ticker"], "date",
                                 last_bar_date(spark, sf), seq="seq")


def _clean_messy(spark, sf):
    """Cleaning of prices with many decimals, missing tickers and NaN."""
    k = F.substring("ticker", 2, 20).cast("bigint")
    raw = supplier_bars(spark, sf)
    thirds = {c: F.col(c) / F.lit(7.0) for c in ("open", "high", "low")}
    return tb.clean_prices(raw.withColumns(thirds).withColumn(
        "close", F.when(k % 9 == 0, F.lit(float("nan"))).otherwise(F.col("close") / F.lit(7.0))).withColumn(
        "ticker", F.when(k % 10 != 0, F.col("ticker"))))


def _quotes(spark, sf):
    """(symbol, quote JSON) per supplier: share-class symbols with a dot, keys
    present and absent, whole, decimal and exponent numbers, broken documents."""
    k = F.col("s_suppkey")
    cap = (F.when(k % 3 == 0, F.concat(k * 1000, F.lit("")))
           .when(k % 3 == 1, F.concat(k * 1000 + 7, F.lit(".0"))).otherwise(F.concat(k, F.lit(".5e6"))))
    full = F.concat(F.lit('{"shortName": "'), "s_name", F.lit('", "marketCap": '), cap,
                    F.lit(', "trailingPE": '), k % 45, F.lit(', "sharesOutstanding": '), k, F.lit(".0}"))
    quote = (F.when(k % 7 == 0, F.lit("not json")).when(k % 5 == 0, F.lit("{}"))
             .when(k % 11 == 0, F.concat(F.lit('{"sector": "x", "shortName": "'), "s_name", F.lit('"}'))).otherwise(full))
    symbol = F.when(k % 2 == 0, F.concat(supplier_ticker(k), F.lit(".B"))).otherwise(supplier_ticker(k))
    return read_table(spark, sf, "supplier").select(symbol.alias("symbol"), quote.alias("quote"),
                                                    (k % 13 == 0).alias("failed"))


def _ticks(spark, sf):
    """Line items as arrivals for (date, ticker): many share a key, in line order."""
    return read_table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"), supplier_ticker("l_suppkey").alias("ticker"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").cast("bigint").alias("volume"),
        F.struct(*LINE_ORDER).alias("seq"))


def _tick_target(spark, sf):
    return _prices(spark, sf).filter(F.col("date") <= F.lit(BATCH1_END)).select(
        "date", "ticker", (F.col("close") + F.lit(5.0)).alias("close"), F.lit(-1).cast("bigint").alias("volume"))


def _stream_refresh(spark, sf):
    """Two landed batches before the second cut, then one that overlaps them."""
    b1, b2 = _batches(spark, sf)
    early = F.col("date") < F.lit(BATCH2_START)
    return stored.stream_refresh(spark, sf, [b1.where(early), b1.where(~early), b2])


def _load_rejects(spark, sf):
    """Line items as arrivals: orphans are tickers without fundamentals, and
    arrivals of a multiple of 1000 have lost their ticker."""
    ticks = _ticks(spark, sf).withColumn("ticker", F.when(F.col("seq.l_partkey") % 1000 != 0, F.col("ticker")))
    return stored.load_rejects(spark, sf, ticks, fundamentals(spark, sf))


def _ticker_prices(spark, sf):
    """Prices of the analyst queries' ticker; the ticker reaches the scan."""
    return _prices(spark, sf, [TICKER])


def _ticker_indicators(spark, sf):
    """Indicators of the analyst queries' ticker over its whole history."""
    return tb.indicadores_tecnicos(spark, sf, [TICKER])


def registry() -> dict[str, Query]:
    return {
        "bars": lambda s, sf: supplier_bars(s, sf),
        "clean_companies": lambda s, sf: tb.empresas(s, sf),
        "clean_prices": lambda s, sf: _prices(s, sf),
        "quote_map_defaults": _quote_map_defaults,
        "wide_to_long": _wide_to_long,
        "daily_refresh": _daily_refresh,
        "distinct_tickers": lambda s, sf: _prices(s, sf).select("ticker").filter(F.col("ticker").isNotNull()).distinct(),
        "top_market_cap": _top_market_cap,
        "fundamentals_ranked": lambda s, sf: tb.indicadores_fundamentales(s, sf),
        "clean_prices_messy": _clean_messy,
        "universe_from_quotes": lambda s, sf: tb.build_universe(_quotes(s, sf), TOP_K),
        "fundamentals_from_quotes": lambda s, sf: tb.fundamentals_from_quotes(_quotes(s, sf), "symbol", failed="failed"),
        "sma": _rolling("sma_20", "sma_50"),
        "bollinger": _rolling("bb_middle", "bb_upper", "bb_lower"),
        "volatility": _rolling("volatility_20"),
        "ema": lambda s, sf: at_check_precision(ema(tb.price_series(s, sf), "close", 20, complete=True).select("date", "ticker", "close", "ema_20")),
        "macd": lambda s, sf: at_check_precision(macd(tb.price_series(s, sf), complete=True).select(
            "date", "ticker", "close", "macd", "macd_signal", "macd_hist")),
        "ema_long": lambda s, sf: at_check_precision(ema(_long_prices(s, sf), "close", 20, complete=True).select(
            "date", "ticker", "close", "ema_20")),
        "macd_long": lambda s, sf: at_check_precision(macd(_long_prices(s, sf), complete=True).select(
            "date", "ticker", "close", "macd", "macd_signal", "macd_hist")),
        "technical_indicators_long": lambda s, sf: at_check_precision(
            technical_indicators(_long_prices(s, sf), complete=True)),
        "rsi": _rolling("rsi_14"),
        "atr": _rolling("atr_14"),
        "obv": _rolling("obv"),
        "fibonacci": lambda s, sf: fibonacci(tb.price_series(s, sf)),
        "technical_indicators": lambda s, sf: at_check_precision(technical_indicators(tb.price_series(s, sf), complete=True)),
        "returns": lambda s, sf: returns(tb.clean_prices(brand_bars(s, sf))),
        "investment_summary": lambda s, sf: investment_summary(
            technical_indicators(tb.price_series(s, sf), complete=True), fundamentals(s, sf)),
        "q01": lambda s, sf: analyst.q01_company(tb.empresas(s, sf), TICKER),
        # q02, q06 and q07 get the whole tables, the others the scan that the ticker narrows
        "q02": lambda s, sf: analyst.q02_price_history(_prices(s, sf), TICKER),
        "q03": lambda s, sf: analyst.ranked_fundamentals(fundamentals(s, sf), TICKER).select(
            *FUNDAMENTAL_COLUMNS[:-1], "ranking_marketcap", "acciones_circulacion"),
        "q04": lambda s, sf: at_check_precision(analyst.q04_recent_indicators(
            _ticker_indicators(s, sf), TICKER, last_bar_date(s, sf), 30)),
        "q05": lambda s, sf: at_check_precision(analyst.q05_price_sma_ema(
            _ticker_prices(s, sf), _ticker_indicators(s, sf), TICKER, last_bar_date(s, sf), 60)),
        "q06": lambda s, sf: analyst.q06_volatility_days(tb.indicadores_tecnicos(s, sf), TICKER),
        "q07": lambda s, sf: analyst.q07_overbought(tb.indicadores_tecnicos(s, sf), None, OVERBOUGHT),
        "q08": lambda s, sf: at_check_precision(analyst.q08_macd_above_signal(_ticker_indicators(s, sf), TICKER)),
        "q09": lambda s, sf: analyst.q09_yearly_performance(_ticker_prices(s, sf), TICKER),
        "q10": lambda s, sf: at_check_precision(analyst.q10_trading_alert(_ticker_indicators(s, sf), _ticker_prices(s, sf), TICKER)),
        "q11": lambda s, sf: analyst.q11_latest_vs_bollinger(_ticker_prices(s, sf), _ticker_indicators(s, sf), TICKER),
        "q12": lambda s, sf: analyst.q12_dashboard(_ticker_indicators(s, sf), _ticker_prices(s, sf), TICKER),
        # the batches are bars: one row per (date, ticker) by construction
        "upsert_update": lambda s, sf: merge.merge_update(*_batches(s, sf), ["date", "ticker"],
                                                          unique_source=True),
        "upsert_ignore": lambda s, sf: merge.merge_ignore(*_batches(s, sf), ["date", "ticker"],
                                                          unique_source=True),
        "upsert_incremental": lambda s, sf: merge.merge_incremental(*_batches(s, sf), ["date", "ticker"],
                                                                    unique_source=True),
        # duplicates inside one load: the first or the last arrival counts
        "upsert_first_wins": lambda s, sf: merge.merge_ignore(_tick_target(s, sf), _ticks(s, sf), ["date", "ticker"], "seq"),
        "upsert_last_wins": lambda s, sf: merge.merge_update(_tick_target(s, sf), _ticks(s, sf), ["date", "ticker"], "seq"),
        "upsert_preserve": lambda s, sf: merge.merge_update(_tick_target(s, sf), _ticks(s, sf), ["date", "ticker"], "seq",
                                                            preserve=["volume"]),
        "indicators_incremental": lambda s, sf: at_check_precision(stored.indicators_by_days(s, sf, [BATCH1_END, SECOND_CUT])),
        "stream_refresh": _stream_refresh,
        "stored_daily": lambda s, sf: stored.stored_daily(s, sf, [BATCH1_END, LAST_DAY, LAST_DAY]),
        "stored_indicators": lambda s, sf: stored.as_doubles(at_check_precision(
            stored.stored_indicators(s, sf, [BATCH1_END, LAST_DAY]))),
        "landed_daily": lambda s, sf: stored.landed_daily(s, sf, [BATCH1_END, LAST_DAY]),
        "landed_prices": lambda s, sf: stored.landed_prices(s, sf, LANDED_FROM, LANDED_TO),
        "csv_round_trip": stored.csv_round_trip,
        "stored_alerts": lambda s, sf: at_check_precision(stored.stored_alerts(s, sf, BUCKETS)),
        "load_rejects": _load_rejects,
        "orphans": lambda s, sf: orphans(_prices(s, sf), fundamentals(s, sf)),
        "duplicate_keys": lambda s, sf: duplicate_keys(read_table(s, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
    }
