"""The twelve analyst queries, parameterised by ticker and reference date.

Each takes the stored tables as DataFrames.  ``as_of`` stands for
``CURRENT_DATE`` (the default): a Column (for instance a scalar subquery over
the prices) or a date.  Descending orders put nulls first, as the database they were
written for does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.rounding import exceeds


def _lit(x) -> Column:
    if x is None:
        return F.current_date()
    return x if isinstance(x, Column) else F.lit(x)


def _since(as_of, days: int) -> Column:
    return F.date_sub(_lit(as_of), days)


def q01_company(empresas: DataFrame, ticker: str) -> DataFrame:
    return empresas.filter(F.col("ticker") == ticker)


def q02_price_history(precios: DataFrame, ticker: str) -> DataFrame:
    return precios.filter(F.col("ticker") == ticker).orderBy(F.col("date").desc_nulls_first())


def ranked_fundamentals(snapshot: DataFrame, ticker: str) -> DataFrame:
    """One ticker's fundamentals with its rank by market cap, counted from the
    larger caps (ties: the smaller ticker first) instead of ranking them all."""
    one = snapshot.filter(F.col("ticker") == ticker)
    cap = one.agg(F.max("market_cap")).scalar()
    ahead = (snapshot.filter((F.col("market_cap") > cap) | ((F.col("market_cap") == cap) & (F.col("ticker") < ticker)))
             .agg(F.count("*")).scalar())
    return one.withColumn("ranking_marketcap", F.when(F.col("market_cap").isNotNull(), (ahead + 1).cast("int")))


def q04_recent_indicators(tecnicos: DataFrame, ticker: str, as_of=None, days: int = 30) -> DataFrame:
    return (tecnicos.filter((F.col("ticker") == ticker) & (F.col("date") >= _since(as_of, days)))
            .orderBy(F.col("date").desc_nulls_first()))


def q05_price_sma_ema(precios: DataFrame, tecnicos: DataFrame, ticker: str, as_of=None,
                      days: int = 60) -> DataFrame:
    ph = precios.filter((F.col("ticker") == ticker) & (F.col("date") >= _since(as_of, days)))
    it = tecnicos.select("ticker", "date", "sma_20", "ema_20")
    return (ph.join(it, ["ticker", "date"], "left").select("date", "close", "sma_20", "ema_20")
            .orderBy(F.col("date").desc_nulls_first()))


def q06_volatility_days(tecnicos: DataFrame, ticker: str, limit: int | None = None) -> DataFrame:
    """Days by 20-day volatility, highest first (the shipped query has no
    limit despite its "top 10" title; pass ``limit`` to cut)."""
    df = (tecnicos.filter((F.col("ticker") == ticker) & F.col("volatility_20").isNotNull())
          .select("date", "ticker", "volatility_20").orderBy(F.col("volatility_20").desc_nulls_first()))
    return df.limit(limit) if limit else df


def q07_overbought(tecnicos: DataFrame, ticker: str | None, threshold: float = 70.0) -> DataFrame:
    """Days with RSI above ``threshold``; ``ticker=None`` scans every ticker."""
    cond = (F.col("rsi_14") > threshold) & F.col("rsi_14").isNotNull()
    if ticker is not None:
        cond = (F.col("ticker") == ticker) & cond
    return (tecnicos.filter(cond).select("date", "ticker", "rsi_14")
            .orderBy(F.col("date").desc_nulls_first()))


def q08_macd_above_signal(tecnicos: DataFrame, ticker: str) -> DataFrame:
    return (tecnicos.filter((F.col("ticker") == ticker)
                             & exceeds(F.col("macd"), F.col("macd_signal"), F.col("close")))
            .select("date", "ticker", "macd", "macd_signal").orderBy(F.col("date").desc_nulls_first()))


def q09_yearly_performance(precios: DataFrame, ticker: str) -> DataFrame:
    """Min / max / mean close per calendar year, newest year first.  The mean
    is taken over exact thousandths, so it is independent of summation order."""
    units = F.round(F.col("close") * F.lit(1000.0)).cast("bigint")
    return (precios.filter(F.col("ticker") == ticker)
            .groupBy(F.year("date").alias("anio"))
            .agg(F.min("close").alias("min_close"), F.max("close").alias("max_close"),
                 (F.sum(units).cast("double") / (F.lit(1000.0) * F.count("close").cast("double"))).alias("avg_close"))
            .orderBy(F.col("anio").desc_nulls_first()))


# State and alert texts, here and in q11 and q12.
def _trading_alert(sma: Column, ema: Column, price: Column) -> Column:
    return (F.when(exceeds(ema, sma, price), F.lit("POSIBLE VENTA")).when(exceeds(sma, ema, price), F.lit("POSIBLE COMPRA"))
            .otherwise(F.lit("NEUTRO")))


def q10_trading_alert(tecnicos: DataFrame, precios: DataFrame, ticker: str) -> DataFrame:
    return trading_alerts(tecnicos.filter(F.col("ticker") == ticker), precios).orderBy(F.col("date").desc_nulls_first())


def trading_alerts(tecnicos: DataFrame, precios: DataFrame) -> DataFrame:
    """The alerts of every ticker, in no order."""
    it = tecnicos.filter(F.col("sma_20").isNotNull() & F.col("ema_20").isNotNull()).select(
        "date", "ticker", "sma_20", "ema_20", F.col("close").alias("_price"))
    ph = precios.select("ticker", "date", "close")
    return it.join(ph, ["ticker", "date"], "left").select(
        "date", "ticker", "close", "sma_20", "ema_20",
        _trading_alert(F.col("sma_20"), F.col("ema_20"), F.col("_price")).alias("decision_trading"))


def q11_latest_vs_bollinger(precios: DataFrame, tecnicos: DataFrame, ticker: str) -> DataFrame:
    ph = precios.filter(F.col("ticker") == ticker).select("ticker", "date", "close")
    it = tecnicos.select("ticker", "date", "bb_upper", "bb_lower")
    state = (F.when(F.col("close") > F.col("bb_upper"), F.lit("Sobrecomprado"))
             .when(F.col("close") < F.col("bb_lower"), F.lit("Sobrevendido")).otherwise(F.lit("Neutral")))
    return (ph.join(it, ["ticker", "date"], "left")
            .select("date", "close", "bb_upper", "bb_lower", state.alias("estado_bollinger"))
            .orderBy(F.col("date").desc_nulls_first()).limit(1))


def q12_dashboard(tecnicos: DataFrame, precios: DataFrame, ticker: str, limit: int = 20) -> DataFrame:
    it = tecnicos.filter(F.col("ticker") == ticker)
    ph = precios.select("ticker", "date", F.col("close").alias("precio_actual"))
    m, s, price = F.col("macd"), F.col("macd_signal"), F.col("close")
    macd_state = (F.when(exceeds(m, s, price), F.lit("MACD: Señal de COMPRA"))
                  .when(exceeds(s, m, price), F.lit("MACD: Señal de VENTA"))
                  .otherwise(F.lit("MACD: Neutro")))
    bb_state = (F.when(F.col("precio_actual") > F.col("bb_upper"), F.lit("Precio FUERA de Bandas: Sobrecompra"))
                .when(F.col("precio_actual") < F.col("bb_lower"), F.lit("Precio FUERA de Bandas: Sobreventa"))
                .otherwise(F.lit("Precio dentro de Bandas")))
    return (it.join(ph, ["ticker", "date"], "left")
            .select("date", "ticker", "precio_actual",
                    F.round("rsi_14", 2).alias("rsi_14"),
                    F.round("volatility_20", 2).alias("volatilidad_20"),
                    F.round("macd", 4).alias("macd"),
                    F.round("macd_signal", 4).alias("macd_signal"),
                    macd_state.alias("estado_macd"), bb_state.alias("estado_bollinger"))
            .orderBy(F.col("date").desc_nulls_first()).limit(limit))
