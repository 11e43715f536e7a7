"""Daily OHLCV bars derived from the driver tables.

Two instruments:

* supplier bars: one ticker per ``l_suppkey`` (``S000001`` ...), one bar per
  (supplier, ship date);
* brand bars: one ticker per ``p_brand`` (few, long series), used for returns.

Plan shape: one hash exchange on (ticker, date) with map-side partial
aggregation.  A supplier that holds a third of all line items still spreads
over every (ticker, date) hash bucket, and the map-side combine collapses its
rows before the shuffle; the per-ticker series that later windows see is
bounded by the number of calendar dates, not by the number of line items.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.sources.tables import read_table

BAR_COLUMNS = ["date", "ticker", "open", "high", "low", "close", "volume"]


def supplier_ticker(suppkey: Column | str) -> Column:
    """``S`` + the supplier key, zero-padded to six digits; longer keys keep
    all their digits (``lpad`` alone would cut them)."""
    key = (F.col(suppkey) if isinstance(suppkey, str) else suppkey).cast("string")
    return F.concat(F.lit("S"), F.lpad(key, F.greatest(F.lit(6), F.length(key)), F.lit("0")))


def suppkeys_from_tickers(tickers: Iterable[str]) -> list[int]:
    """Inverse of :func:`supplier_ticker`, used to push a ticker filter down to
    the ``l_suppkey`` column of the parquet scan."""
    return [int(t[1:]) for t in tickers]


# The line fields that totally order the lines of one day:
# (l_orderkey, l_linenumber) repeats in the data, so the whole line is used.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


def line_order() -> Column:
    """Struct key of the line order.  ``min`` / ``max`` of a struct run as a
    sort-based aggregate (map-side partial aggregation is kept); packing
    the key into one decimal(38,0) to get a hash aggregate was measured
    slower (decimal arithmetic per line) and limits the key ranges."""
    return F.struct(*LINE_ORDER)


def _bars_from_lines(lines: DataFrame, key: Column, ticker: Column) -> DataFrame:
    """Aggregate on the raw (numeric where possible) key; the ticker text is
    built once per bar, after the aggregation.  The line order holds the price,
    so the first and last lines themselves give it."""
    order = line_order()
    return (
        lines.groupBy(key.alias("_key"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.min(order)["l_extendedprice"].alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max(order)["l_extendedprice"].alias("close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
        .withColumn("ticker", ticker)
        .select(*BAR_COLUMNS)
    )


def supplier_bars(spark: SparkSession, sf_dir: str, tickers: Iterable[str] | None = None) -> DataFrame:
    """Bars per supplier.  ``tickers`` narrows the scan with a pushed-down
    ``l_suppkey IN (...)`` filter."""
    lines = read_table(spark, sf_dir, "lineitem")
    if tickers is not None:
        lines = lines.filter(F.col("l_suppkey").isin(suppkeys_from_tickers(tickers)))
    return _bars_from_lines(lines, F.col("l_suppkey"), supplier_ticker("_key"))


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per part brand.  ``part`` is joined on its key; AQE turns the join
    into a broadcast only when the measured part side is small."""
    lines = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = lines.join(part, lines.l_partkey == part.p_partkey, "inner")
    return _bars_from_lines(joined, F.col("p_brand"), F.col("_key"))
