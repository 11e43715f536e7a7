"""One day's run over landed files: refresh, clean, indicators, summary, loads.

Landing folder::

    constituents.csv   a Symbol column
    quotes.json        one {"ticker", "quote", "failed"} object a line
    prices/*.csv       long price files (Date, Ticker, Open, ... Volume)

The run takes the landed bars after the stored history's last date up to
``as_of``, for tickers of the universe, the last arrival of each key, and
appends them.  Their indicators and returns are carried forward from the stored
state row of their ticker, so a day costs what it brings, however long the
history is; the summary is made over every ticker's last row.  Series may have
gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators import carried
from candela.operators.merge import keep_last, newer_than
from candela.operators.signals import investment_summary
from candela.plans import tables as tb
from candela.plans.daily import LoadResult, carried_sources, load_all
from candela.schemas import STATE_TABLE
from candela.session import ensure_checkpoint_dir, passing, staged
from candela.sinks import TableStore
from candela.sources.landed import ARRIVAL, read_constituents, read_prices_csv, read_quotes_json


def new_bars(store: TableStore, landed: DataFrame, universe: DataFrame, version: int, as_of) -> DataFrame:
    """The landed bars after the stored history's last date, one a key."""
    fetched = tb.clean_prices(landed, keep=[ARRIVAL]).join(universe.select("ticker"), "ticker", "left_semi")
    fetched = newer_than(fetched, store.mark("precios_historicos", before=version)).where(F.col("date") <= F.lit(as_of).cast("date"))
    return keep_last(fetched, ["date", "ticker"], ARRIVAL).drop(ARRIVAL)


def landed_run(spark: SparkSession, landing: str, store_base: str, version: int, as_of) -> list[LoadResult]:
    ensure_checkpoint_dir(spark)
    store = TableStore(spark, store_base)
    quotes = read_quotes_json(spark, f"{landing}/quotes.json").filter(~F.col("failed"))
    universe = tb.universe_from_files(read_constituents(spark, f"{landing}/constituents.csv"), quotes)
    landed = read_prices_csv(spark, f"{landing}/prices", arrival=True)
    with passing():
        # shared by several of the loads: computed once, kept in the shared folder
        prices = staged(new_bars(store, landed, universe, version, as_of), "prices")
        made = carried_sources(store, prices, version)
        snapshot = tb.fundamentals_from_quotes(quotes)
        sources = {
            "empresas": tb.clean_companies(universe),
            "precios_historicos": prices,
            "indicadores_fundamentales": tb.rank_fundamentals(snapshot),
            "resumen_inversion": investment_summary(carried.latest_rows(made[STATE_TABLE]), snapshot),
            **made,
        }
        return load_all(store, sources, version, repeated=("indicadores_fundamentales",))
