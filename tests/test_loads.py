"""Keyed loads, the daily run, sinks and the streaming refresh."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candela.operators import merge
from candela.plans.catalog import BATCH1_END, BATCH2_START
from candela.plans.daily import daily_run, load_table
from candela.plans.tables import precios_historicos
from candela.schemas import conform
from candela.sinks import TableStore
from candela.sources.landed import universe_from_quotes
from candela.sources.reshape import long_to_wide, wide_to_long
from candela.streaming.refresh import start_price_refresh
from conftest import SF001, make_bars


def scratch():
    return tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_update_is_idempotent(spark):
    p = precios_historicos(spark, SF001)
    b1 = p.filter(F.col("date") <= F.lit(BATCH1_END))
    b2 = p.filter(F.col("date") >= F.lit(BATCH2_START)).withColumn("close", F.col("close") + 1)
    once = merge.merge_update(b1, b2, ["date", "ticker"])
    twice = merge.merge_update(once, b2, ["date", "ticker"])
    assert rows(once) == rows(twice)
    # equals "last batch wins" deduplication
    both = b1.withColumn("_b", F.lit(0)).unionByName(b2.withColumn("_b", F.lit(1)))
    assert rows(once) == rows(merge.keep_last(both, ["date", "ticker"], "_b").drop("_b"))


def test_incremental_drops_late_rows_and_old_new_tickers(spark):
    old = make_bars(spark, {"A": [1.0, 2.0, 3.0]})
    late = make_bars(spark, {"NEW": [5.0, 6.0]})  # dates at or below the table's maximum
    fresh = make_bars(spark, {"A": [1.0, 2.0, 3.0, 4.0]}).filter(F.col("date") == dt.date(2020, 1, 4))
    out = merge.merge_incremental(old, late.unionByName(fresh), ["date", "ticker"], on_conflict="ignore")
    assert sorted((r.ticker, r.date.day) for r in out.collect()) == [("A", 1), ("A", 2), ("A", 3), ("A", 4)]


def test_merge_preserve_and_first_wins(spark):
    t = spark.createDataFrame([("A", "keep", 1.0)], "ticker string, name string, per double")
    s = spark.createDataFrame([("A", "new", 2.0), ("B", "b", 3.0)], "ticker string, name string, per double")
    out = {r.ticker: (r.name, r.per) for r in merge.merge_update(t, s, ["ticker"], preserve=["name"]).collect()}
    assert out == {"A": ("keep", 2.0), "B": (None, 3.0)}
    dup = spark.createDataFrame([("C", "x", 1.0, 1), ("C", "y", 2.0, 2)], "ticker string, name string, per double, seq int")
    first = merge.merge_ignore(t, dup, ["ticker"], seq="seq").filter("ticker = 'C'").first()
    assert first.name == "x"


def test_daily_run_twice_changes_nothing(spark):
    base = scratch()
    first = {r.table: r for r in daily_run(spark, SF001, base, 1)}
    assert all(r.written for r in first.values())
    second = {r.table: r for r in daily_run(spark, SF001, base, 2)}
    for t in ("precios_historicos", "indicadores_tecnicos", "precios_variaciones"):
        assert not second[t].written  # nothing after the watermark
    store = TableStore(spark, base)
    assert rows(store.read("empresas", 1)) == rows(store.read("empresas", 2))
    assert rows(store.read("resumen_inversion", 1)) == rows(store.read("resumen_inversion", 2))
    tec = store.read("indicadores_tecnicos")
    assert dict(tec.dtypes)["rsi_14"] == "decimal(6,2)"


def test_sink_overflow_is_an_error(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A", 1.0, 12345.0)],
                               "date date, ticker string, close double, var_daily double")
    with pytest.raises(Exception):
        conform(df, "precios_variaciones").collect()
    ok = spark.createDataFrame([(dt.date(2020, 1, 1), "A", 1.0005, 0.00005)],
                               "date date, ticker string, close double, var_daily double")
    r = conform(ok, "precios_variaciones").first()
    assert str(r.close) == "1.001" and str(r.var_daily) == "0.0001"  # half away from zero


def test_streaming_refresh(spark):
    land, base, ck = scratch(), scratch(), scratch()
    p = precios_historicos(spark, SF001)
    p.filter(F.col("date") <= F.lit(BATCH1_END)).write.parquet(os.path.join(land, "b1"))
    q = start_price_refresh(spark, os.path.join(land, "*"), base, checkpoint_location=ck)
    q.awaitTermination()
    p.filter(F.col("date") >= F.lit(BATCH2_START)).write.parquet(os.path.join(land, "b2"))
    q = start_price_refresh(spark, os.path.join(land, "*"), base, checkpoint_location=ck)
    q.awaitTermination()
    store = TableStore(spark, base)
    got = store.read("precios_historicos").select("date", "ticker", F.col("close").cast("double"))
    assert rows(got) == rows(p.select("date", "ticker", "close"))
    before = store.versions("precios_historicos")
    q = start_price_refresh(spark, os.path.join(land, "*"), base, checkpoint_location=ck)
    q.awaitTermination()
    assert store.versions("precios_historicos") == before  # empty rerun writes nothing


def test_stream_with_a_new_checkpoint_reads_on(spark):
    land, base = scratch(), scratch()
    p = precios_historicos(spark, SF001)
    cuts = [dt.date(1998, 6, 30), dt.date(1999, 12, 31), dt.date(2030, 1, 1)]
    low = dt.date(1900, 1, 1)
    for i, (hi, ck) in enumerate(zip(cuts, [scratch()] * 2 + [scratch()], strict=True)):
        p.filter((F.col("date") > F.lit(low)) & (F.col("date") <= F.lit(hi))).write.parquet(os.path.join(land, f"b{i}"))
        low = hi
        start_price_refresh(spark, os.path.join(land, "*"), base, ck).awaitTermination()
    store = TableStore(spark, base)
    assert store.versions("precios_historicos") == [1, 2, 3]
    got = store.read("precios_historicos").select("date", "ticker", F.col("close").cast("double"))
    assert rows(got) == rows(p.select("date", "ticker", "close"))
    batch = store.manifest("precios_historicos", 3)["batch"]
    assert store.loaded("precios_historicos", batch) and not store.loaded("precios_historicos", batch + "0")


def test_landed_run_over_two_days(spark):
    from candela.plans.landed_run import landed_run
    from candela.sources.landed import read_prices_csv
    land, base, whole = scratch(), scratch(), scratch()
    os.makedirs(os.path.join(land, "prices"))
    with open(os.path.join(land, "constituents.csv"), "w") as fh:
        fh.write("Name,Symbol\nOne,AA\nTwo,BRK.B\n")
    with open(os.path.join(land, "quotes.json"), "w") as fh:
        fh.write('{"ticker": "AA", "quote": {"shortName": "One", "marketCap": 2.5e9, "trailingPE": 12}}\n')
        fh.write('{"ticker": "BRK-B", "quote": {"shortName": "Two"}}\n{"ticker": "CC", "quote": {}, "failed": true}\n')

    def day(name, lines):
        with open(os.path.join(land, "prices", name), "w") as fh:
            fh.write("Ticker,Date,Adj Close,Close,Open,High,Low,Volume\n")
            fh.writelines(f"{t},{d},0,{c},{c},{c + 1},{c - 1},100\n" for t, d, c in lines)

    first = dt.date(2024, 1, 1)
    days = [first + dt.timedelta(days=i) for i in range(60)]
    day("a.csv", [(t, d, 100.1 + i + k) for i, d in enumerate(days[:-1]) for k, t in enumerate(["AA", "BRK-B", "ZZ"])])
    one = {r.table: r for r in landed_run(spark, land, base, 1, days[-2])}
    assert one["precios_historicos"].rows == 2 * 59 and one["indicadores_tecnicos"].rows == 2 * 59
    # the next day: a first and a corrected bar, and a late one that the watermark drops
    day("b.csv", [("AA", days[-1], 500.0), ("AA", days[-1], 400.0), ("BRK-B", days[-1], 300.0), ("AA", days[3], 1.0)])
    two = {r.table: r for r in landed_run(spark, land, base, 2, days[-1])}
    assert two["precios_historicos"].rows == 2 and two["precios_variaciones"].rows == 2
    again = {r.table: r for r in landed_run(spark, land, base, 3, days[-1])}
    assert again["precios_historicos"].rows == 0
    store = TableStore(spark, base)
    assert {r.ticker: float(r.close) for r in store.read("precios_historicos", since=str(days[-1])).collect()
            } == {"AA": 400.0, "BRK-B": 300.0}
    # a build from scratch of the same bars gives the same tables
    os.remove(os.path.join(land, "prices", "b.csv"))
    day("c.csv", [("AA", days[-1], 400.0), ("BRK-B", days[-1], 300.0)])
    landed_run(spark, land, whole, 1, days[-1])
    for t in ("empresas", "precios_historicos", "precios_variaciones", "resumen_inversion"):
        assert rows(TableStore(spark, whole).read(t)) == rows(store.read(t)), t
    # whole-series levels of stored days stay as they were loaded: the watermark rule
    last = lambda base: rows(TableStore(spark, base).read("indicadores_tecnicos", since=str(days[-1])))
    assert last(whole) == last(base) and len(last(base)) == 2
    assert read_prices_csv(spark, os.path.join(land, "prices")).count() == 3 * 59 + 2


def test_wide_long_round_trip(spark):
    bars = make_bars(spark, {"A": [1.0, 2.0, None], "B": [3.0, 4.0, 5.0]})
    bars = bars.withColumn("volume", F.when(F.col("close").isNotNull(), F.col("volume")))
    wide = long_to_wide(bars, ["A", "B"])
    back = wide_to_long(wide).select("date", "ticker", "close")
    # the all-missing row of A is dropped
    assert sorted((r.ticker, r.date.day, r.close) for r in back.collect()) == [
        ("A", 1, 1.0), ("A", 2, 2.0), ("B", 1, 3.0), ("B", 2, 4.0), ("B", 3, 5.0)]


def test_quote_defaults(spark):
    q = spark.createDataFrame([("BRK.B", '{"shortName": "X", "marketCap": 5}'), ("Y", "not json")],
                              "symbol string, quote string")
    got = {r.ticker: (r.name, r.sector, r.market_cap) for r in universe_from_quotes(q).collect()}
    assert got == {"BRK-B": ("X", "", 5), "Y": ("", "", 0)}


def test_appending_load_leaves_the_rest_alone(spark):
    store = TableStore(spark, scratch())
    load_table(store, "precios_historicos", make_bars(spark, {"A": [1.0, 2.0]}), 1)
    old = store.manifest("precios_historicos", 1)["folders"]
    files = {f: os.stat(f).st_mtime_ns for f in _files(store)}
    r = load_table(store, "precios_historicos", make_bars(spark, {"A": [9.0, 9.0, 3.0], "B": [7.0]}), 2)
    assert r.rows == 1  # only A's third day is after the watermark
    new = store.manifest("precios_historicos", 2)["folders"]
    assert new[:-1] == old and len(new) == 2
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    got = {(x.ticker, x.date.day): float(x.close) for x in store.read("precios_historicos").collect()}
    assert got == {("A", 1): 1.0, ("A", 2): 2.0, ("A", 3): 3.0}
    assert store.read("precios_historicos", version=1).count() == 2
    late = store.read("precios_historicos", since="2020-01-03")
    assert late.count() == 1 and len(late.inputFiles()) < len(store.read("precios_historicos").inputFiles())
    plan = merge.newer_than(late, "2020-01-02")._jdf.queryExecution().toString()
    assert "Join" not in plan


def _files(store):
    return [os.path.join(d, f) for d, _, fs in os.walk(store.base) for f in fs if f.endswith(".parquet")]


def test_duplicates_inside_a_load_go_by_arrival(spark):
    days = [dt.date(2020, 1, 1)] * 2 + [dt.date(2020, 1, 2)]
    rows_ = [(d, "C", 1.0, v, i) for i, (d, v) in enumerate(zip(days, [5.0, 4.0, 6.0], strict=True))]
    src = spark.createDataFrame(rows_, "date date, ticker string, open double, close double, seq int")
    for table, expected in (("precios_historicos", 5.0), ("indicadores_tecnicos", 4.0)):
        store = TableStore(spark, scratch())
        load_table(store, table, src, 1, seq="seq")
        got = {r.date.day: float(r.close) for r in store.read(table).collect()}
        assert got == {1: expected, 2: 6.0}
    store = TableStore(spark, scratch())
    names = spark.createDataFrame([("C", "zfirst", 1), ("C", "alast", 2)], "ticker string, name string, seq int")
    load_table(store, "empresas", names, 1, seq="seq")
    assert store.read("empresas").first().name == "alast"


def test_load_table_empty_delta(spark):
    store = TableStore(spark, scratch())
    p = make_bars(spark, {"A": [1.0, 2.0]})
    assert load_table(store, "precios_historicos", p, 1).written
    assert not load_table(store, "precios_historicos", p, 2).written


def test_file_sinks_overwrite(spark):
    from candela.sinks import write_csv, write_parquet
    d = scratch()
    bars = make_bars(spark, {"A": [1.0, 2.0], "B": [3.0, 4.0]})
    for _ in range(2):  # a rerun overwrites instead of appending
        write_csv(bars, os.path.join(d, "csv"))
        write_parquet(bars, os.path.join(d, "pq"), partition_by=["ticker"])
    back = spark.read.option("header", True).csv(os.path.join(d, "csv"))
    assert back.count() == 4 and back.columns[:2] == ["date", "ticker"]
    pq = spark.read.parquet(os.path.join(d, "pq"))
    assert pq.count() == 4 and sorted(r.ticker for r in pq.select("ticker").distinct().collect()) == ["A", "B"]
