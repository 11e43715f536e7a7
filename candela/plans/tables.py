"""The six result tables, built from the driver tables.

empresas, precios_historicos, indicadores_fundamentales,
indicadores_tecnicos, resumen_inversion, precios_variaciones.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.tickers import normalize_ticker
from candela.operators.ranking import rank_desc_nulls_null
from candela.operators.returns import returns
from candela.operators.signals import investment_summary
from candela.operators.technical import technical_indicators
from candela.session import dealt
from candela.sources.bars import BAR_COLUMNS, supplier_bars
from candela.sources.reference import FUNDAMENTAL_COLUMNS, companies, fundamentals
from candela.sources.tables import read_table

# Landed column names and their table names.
RAW_TO_TABLE = {"Date": "date", "Ticker": "ticker", "Open": "open", "High": "high", "Low": "low",
                "Close": "close", "Volume": "volume", "Name": "name", "Sector": "sector",
                "Industry": "industry", "PER": "per", "ROE": "roe", "EPS Growth YoY": "eps_growth_yoy",
                "Deuda/Patrimonio": "deuda_patrimonio", "Margen Neto": "margen_neto",
                "Dividend Yield": "dividend_yield", "Market Cap": "market_cap",
                "Acciones en Circulación": "acciones_circulacion"}


def no_nan(c: Column) -> Column:
    """A missing number is null, never NaN, from the cleaning step on."""
    return F.nanvl(c, F.lit(None).cast("double"))


def to_table_names(df: DataFrame) -> DataFrame:
    """Rename landed headers to table names; absent names are ignored."""
    return df.withColumnsRenamed({k: v for k, v in RAW_TO_TABLE.items() if k in df.columns})


def clean_companies(df: DataFrame) -> DataFrame:
    """ticker, name, sector, industry; ticker symbols normalised."""
    df = to_table_names(df)
    return df.select(normalize_ticker(F.col("ticker")).alias("ticker"), "name", "sector", "industry")


def clean_prices(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The seven price columns, dates as dates, prices rounded to 3 places
    half to even, NaN as null, rows without a ticker dropped; ``keep`` names
    further columns to carry along (an order of arrival)."""
    df = to_table_names(df)
    return df.filter(F.col("ticker").isNotNull()).select(
        F.to_date("date").alias("date"), "ticker",
        *[F.bround(no_nan(F.col(c).cast("double")), 3).alias(c) for c in ("open", "high", "low", "close")],
        no_nan(F.col("volume").cast("double")).cast("bigint").alias("volume")
        if dict(df.dtypes)["volume"] in ("float", "double") else F.col("volume").cast("bigint").alias("volume"), *(keep or []))


def rank_fundamentals(df: DataFrame) -> DataFrame:
    """Fundamentals with ``ranking_marketcap`` (1 = largest, ties by ticker,
    null market cap -> null rank)."""
    df = to_table_names(df).select(*FUNDAMENTAL_COLUMNS)
    return rank_desc_nulls_null(df, "market_cap", "ticker", "ranking_marketcap").select(
        *FUNDAMENTAL_COLUMNS[:-1], "ranking_marketcap", "acciones_circulacion")


def empresas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_companies(companies(spark, sf_dir))


def precios_historicos(spark: SparkSession, sf_dir: str, tickers: Iterable[str] | None = None) -> DataFrame:
    return clean_prices(supplier_bars(spark, sf_dir, tickers)).select(*BAR_COLUMNS)


def price_series(spark: SparkSession, sf_dir: str, tickers: Iterable[str] | None = None) -> DataFrame:
    """The prices by ticker, for windows over the series: dealt by the number
    of line items (from the files' footers), which that of bars never passes."""
    prices = precios_historicos(spark, sf_dir, tickers)
    return prices if tickers is not None else dealt(prices, read_table(spark, sf_dir, "lineitem").count(), "ticker")


def indicadores_fundamentales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_fundamentals(fundamentals(spark, sf_dir))


def indicadores_tecnicos(spark: SparkSession, sf_dir: str, tickers: Iterable[str] | None = None) -> DataFrame:
    # Bars come from an aggregation: a close is present on every row.
    return technical_indicators(price_series(spark, sf_dir, tickers), complete=True)


def resumen_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return investment_summary(indicadores_tecnicos(spark, sf_dir), fundamentals(spark, sf_dir))


def precios_variaciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns(price_series(spark, sf_dir))


def build_universe(quotes: DataFrame, k: int = 500) -> DataFrame:
    """Listing of the ``k`` largest companies by market cap (ties by
    ticker) from (symbol, quote JSON) rows: normalised tickers, missing
    name/sector/industry as '', missing market cap as 0."""
    from candela.operators.ranking import top_k
    from candela.sources.landed import universe_from_quotes
    uni = universe_from_quotes(quotes)
    return top_k(uni, [F.col("market_cap").desc(), F.col("ticker").asc()], k)


def fundamentals_from_quotes(quotes: DataFrame, symbol: str = "ticker", payload: str = "quote",
                             failed: str | None = None) -> DataFrame:
    """Fundamentals snapshot from (ticker, quote JSON): the eleven keys
    renamed to columns, a missing key -> null, an unreadable document -> an
    all-null row; rows flagged in ``failed`` (a fetch that errored) are
    dropped."""
    from candela.sources.landed import parse_quote, quote_columns
    df = quotes.filter(~F.col(failed)) if failed else quotes
    cols = quote_columns(parse_quote(F.col(payload)), with_defaults=False)
    return df.select(F.col(symbol).alias("ticker"), *cols.values())


def bootstrap_history(wide: DataFrame, sep: str = "|", date: str = "date") -> DataFrame:
    """Long price history from a landed wide file (one column per
    ticker and field; ``read_wide_prices_csv`` cuts the date range)."""
    from candela.sources.reshape import wide_to_long
    return clean_prices(wide_to_long(wide, sep=sep, date=date))


def bootstrap_from_files(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Long price history of landed wide files of any width over a half-open
    date range."""
    from candela.sources.wide import read_wide_csv
    return clean_prices(read_wide_csv(spark, path, start, end))


def universe_from_files(constituents: DataFrame, quotes: DataFrame, k: int = 500) -> DataFrame:
    """The ``k`` largest constituents by market cap: every listed ticker
    (``read_constituents``) with its landed quote map (ticker, quote JSON), a
    ticker without a quote keeping the listing defaults."""
    q = quotes.select(normalize_ticker(F.col("ticker")).alias("symbol"), F.col("quote"))
    joined = constituents.join(q, constituents.ticker == q.symbol, "left").select(
        F.col("ticker").alias("symbol"), F.coalesce(F.col("quote"), F.lit("{}")).alias("quote"))
    return build_universe(joined, k)
