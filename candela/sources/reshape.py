"""Wide <-> long price layouts.

The wide layout has one row per date and one column per (ticker, field),
named ``{ticker}{sep}{field}``.  Going long needs no shuffle: each wide row
explodes into one struct per ticker, and rows whose fields are all missing
are dropped.  (A frame has a column for each cell, so this is for a few hundred
tickers; files of any width are read and written by ``sources/wide.py``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ["open", "high", "low", "close", "volume"]


def long_to_wide(df: DataFrame, tickers: list[str], fields: list[str] | None = None,
                 sep: str = "|", date: str = "date") -> DataFrame:
    """Pivot long bars to one row per date (fixed ticker list, so the pivot
    needs no extra pass to discover values)."""
    fields = fields or FIELDS
    aggs = [F.first(F.col(f).cast("double"), ignorenulls=True).alias(f) for f in fields]
    wide = df.where(F.col("ticker").isin(tickers)).groupBy(date).pivot("ticker", tickers).agg(*aggs)
    return wide.select(date, *[F.col(f"{t}_{f}").alias(f"{t}{sep}{f}") for t in tickers for f in fields])


def wide_to_long(wide: DataFrame, sep: str = "|", date: str = "date",
                 fields: list[str] | None = None) -> DataFrame:
    """(date, ticker) rows with one column per field; all-missing rows dropped."""
    pairs = [c.split(sep, 1) for c in wide.columns if sep in c]
    tickers = list(dict.fromkeys(t for t, _ in pairs))
    fields = fields or list(dict.fromkeys(f for _, f in pairs))
    present = {(t, f) for t, f in pairs}
    structs = [
        F.struct(F.lit(t).alias("ticker"),
                 *[(F.col(f"`{t}{sep}{f}`") if (t, f) in present else F.lit(None).cast("double")).alias(f)
                   for f in fields])
        for t in tickers
    ]
    out = wide.select(date, F.explode(F.array(*structs)).alias("_r")).select(date, "_r.*")
    return out.dropna(how="all", subset=fields)
