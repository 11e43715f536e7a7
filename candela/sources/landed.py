"""Landed files: the raw inputs the extraction step leaves on disk.

Network fetches (quote service, index page) are outside Spark; their output
lands as CSV / JSON files, read here with explicit schemas (no inference).
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.functions.tickers import normalize_ticker

RAW_PRICES = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Ticker", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
])

# Quote-map keys and the column each one feeds.
QUOTE_FIELDS = [
    ("shortName", "name", T.StringType()),
    ("sector", "sector", T.StringType()),
    ("industry", "industry", T.StringType()),
    ("marketCap", "market_cap", T.LongType()),
    ("trailingPE", "per", T.DoubleType()),
    ("returnOnEquity", "roe", T.DoubleType()),
    ("earningsQuarterlyGrowth", "eps_growth_yoy", T.DoubleType()),
    ("debtToEquity", "deuda_patrimonio", T.DoubleType()),
    ("profitMargins", "margen_neto", T.DoubleType()),
    ("dividendYield", "dividend_yield", T.DoubleType()),
    ("sharesOutstanding", "acciones_circulacion", T.LongType()),
]
# Defaults of the universe listing (missing name/sector/industry
# become '', missing market cap 0).
UNIVERSE_DEFAULTS = {"name": "", "sector": "", "industry": "", "market_cap": 0}

# Whole numbers may come with a decimal point or an exponent: every number is
# parsed as a double and cast.
QUOTE_SCHEMA = T.StructType([T.StructField(k, t if t == T.StringType() else T.DoubleType()) for k, _c, t in QUOTE_FIELDS])

ARRIVAL = "arrival"


def first_lines(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(first line, files) of the CSV files under ``path``: a row a layout.

    One task a file that stops after its first line.  A session of its own
    (the caller's settings stay) gives every file a partition, unsplit, and
    Arrow batches of one row, so hardly more than a buffer of a file is read."""
    own = spark.newSession()
    for key, value in {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40),
                       "spark.sql.files.minPartitionNum": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}.items():
        own.conf.set(key, value)

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = own.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    header = F.regexp_replace(F.col("value"), "^\ufeff|\r$", "")
    groups = lines.mapInArrow(first, "value string, file string").groupBy(header.alias("header")).agg(
        F.sort_array(F.collect_list("file")).alias("files")).collect()  # a row a layout, the paths of its files
    return sorted((r["header"], r["files"]) for r in groups)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, arrival: bool = False) -> DataFrame:
    """The columns of ``schema`` from CSV files with a header: found by name
    (exactly, else in any case), cast, in the schema's order; other columns
    are ignored, a missing one is an error.  ``arrival`` adds the rows' order of
    arrival: file time, file, place in the file.

    The files of a folder may have different layouts: those with the same
    header are read together, each group by its own names, and united.  Files
    without a line have no rows."""
    layouts = first_lines(spark, path)
    if len(layouts) <= 1:
        return _read_layout(spark, path, path, schema, arrival)
    parts = [_read_layout(spark, [_escaped(f) for f in files], files[0], schema, arrival) for _, files in layouts]
    return reduce(DataFrame.unionByName, parts)


def _escaped(path: str) -> str:
    """A file's path as a path to read: no pattern characters."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(path))


def _read_layout(spark: SparkSession, paths: str | list[str], named: str, schema: T.StructType, arrival: bool) -> DataFrame:
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(paths)
    names = [c.removeprefix("\ufeff") for c in raw.columns]
    exact = {c: i for i, c in reversed(list(enumerate(names)))}
    lower = {c.lower(): i for i, c in reversed(list(enumerate(names)))}
    missing = [f.name for f in schema.fields if f.name.lower() not in lower]
    if missing:
        raise ValueError(f"{named} has no column {', '.join(missing)}")
    columns = [F.col(f"`{raw.columns[exact.get(f.name, lower[f.name.lower()])]}`").try_cast(f.dataType).alias(f.name)
               for f in schema.fields]
    if arrival:
        columns.append(F.struct(F.col("_metadata.file_modification_time").alias("at"),
                                F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("block"),
                                F.monotonically_increasing_id().alias("row")).alias(ARRIVAL))
    return raw.select(*columns)


CONSTITUENTS = T.StructType([T.StructField("Symbol", T.StringType())])


def read_constituents(spark: SparkSession, path: str) -> DataFrame:
    """Landed index constituents (a CSV with a ``Symbol`` column; the page
    fetch that produced it is outside Spark): distinct normalised tickers,
    missing symbols dropped."""
    return (read_csv(spark, path, CONSTITUENTS).filter(F.col("Symbol").isNotNull())
            .select(normalize_ticker(F.col("Symbol")).alias("ticker")).distinct())


def read_prices_csv(spark: SparkSession, path: str, start=None, end=None, arrival: bool = False) -> DataFrame:
    """Long price file; optional half-open date range ``[start, end)``."""
    df = read_csv(spark, path, RAW_PRICES, arrival)
    if start is not None:
        df = df.filter(F.col("Date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("Date") < F.lit(end))
    return df


def read_wide_prices_csv(spark: SparkSession, path: str, start=None, end=None, sep: str = "|") -> DataFrame:
    """Landed wide file: a date column, then ``ticker|field`` columns, all
    numbers; optional half-open date range ``[start, end)``."""
    raw = spark.read.option("header", True).csv(path)
    date = next((c for c in raw.columns if c.lower() == "date"), None)
    if date is None:
        raise ValueError(f"{path} has no date column")
    df = raw.select(F.col(f"`{date}`").try_cast("date").alias("date"), *[
        F.col(f"`{c}`").try_cast("double").alias(c if sep not in c else f"{c.split(sep, 1)[0]}{sep}{c.split(sep, 1)[1].lower()}")
        for c in raw.columns if sep in c])
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("date") < F.lit(end))
    return df


def read_quotes_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed quotes: one JSON object a line with ``ticker`` and ``quote`` (an
    object, kept as text for ``parse_quote``) and, for a failed fetch, ``failed`` true."""
    schema = "ticker string, quote string, failed boolean"
    return spark.read.schema(schema).json(path).withColumn("failed", F.coalesce("failed", F.lit(False)))


def parse_quote(json_col: Column) -> Column:
    """A quote map (JSON text) as a struct of the known keys; a missing key
    or an unreadable document gives nulls."""
    return F.from_json(json_col, QUOTE_SCHEMA, {"mode": "PERMISSIVE"})


def quote_columns(quote: Column, with_defaults: bool) -> dict[str, Column]:
    """Column name -> value of its quote key (with the listing defaults)."""
    out = {}
    for key, name, kind in QUOTE_FIELDS:
        c = quote.getField(key)
        if kind != T.StringType():
            c = F.nanvl(c, F.lit(None).cast("double")).cast(kind)
        if with_defaults and name in UNIVERSE_DEFAULTS:
            c = F.coalesce(c, F.lit(UNIVERSE_DEFAULTS[name]))
        out[name] = c.alias(name)
    return out


def universe_from_quotes(quotes: DataFrame, symbol: str = "symbol", payload: str = "quote") -> DataFrame:
    """Listing rows from (symbol, quote JSON): normalised ticker, name,
    sector, industry, market cap with their defaults."""
    q = parse_quote(F.col(payload))
    cols = quote_columns(q, True)
    return quotes.select(normalize_ticker(F.col(symbol)).alias("ticker"),
                         cols["name"], cols["sector"], cols["industry"], cols["market_cap"])
