"""Windows over series stand in tasks of a bounded number of rows, on few sorts."""

from pyspark.sql import functions as F

from candela import session
from candela.operators import carried
from candela.plans import daily
from candela.plans import tables as tb
from candela.sinks import TableStore
from candela.sources.tables import read_table
from conftest import make_bars


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_carried_rows_are_dealt_by_their_number(spark, monkeypatch):
    bars = make_bars(spark, {f"T{i}": [1.0 + i + j for j in range(40)] for i in range(20)}).cache()
    empty = carried.empty_state(spark)
    want = sorted(map(tuple, carried.indicator_rows(carried.carry(empty, bars)).collect()), key=str)
    monkeypatch.setattr(session, "SERIES_ROWS", 40)
    frame = carried.carry(empty, bars)
    assert frame.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, carried.indicator_rows(frame).collect()), key=str) == want


def test_series_without_gaps_take_few_sorts(spark):
    whole, holes = ([1.0, 2.0, 4.0, x, 5.0] for x in (3.0, None))
    empty = carried.empty_state(spark)
    frame = carried.carry(empty, make_bars(spark, {"A": whole, "B": [2.0, 3.0, 4.0]}))
    assert 1 <= _plan(frame).count("Sort [") <= 4  # two of the join with the state
    assert carried.carry(empty, make_bars(spark, {"A": holes, "B": [2.0, 3.0, 4.0]})).where("_new").count() == 8


def test_price_series_are_dealt_by_the_line_items(spark, tmp_path, monkeypatch):
    lines = spark.range(300).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 30).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), (F.col("id") + 1.0).alias("l_extendedprice"),
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 30).cast("int")).cast("timestamp").alias("l_shipdate"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert read_table(spark, str(tmp_path), "lineitem").count() == 300
    monkeypatch.setattr(session, "SERIES_ROWS", 10)
    ind = tb.indicadores_tecnicos(spark, str(tmp_path))
    assert ind.rdd.getNumPartitions() == 30
    assert ind.count() == 300


def test_load_with_repeats_takes_one_exchange(spark, tmp_path, monkeypatch):
    seen = []
    commit = TableStore.commit

    def spied(self, df, *args, **more):
        seen.append(_plan(df))
        return commit(self, df, *args, **more)

    monkeypatch.setattr(TableStore, "commit", spied)
    day = F.date_add(F.lit("2000-01-03").cast("date"), (F.col("id") % 5 % 2).cast("int"))
    src = spark.range(20).select(day.alias("date"), F.concat(F.lit("S"), F.col("id") % 5).alias("ticker"),
                                 *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")],
                                 F.col("id").alias("volume"), F.col("id").alias("seq"))
    store = TableStore(spark, str(tmp_path))
    result = daily.load_table(store, "precios_historicos", src, 1, seq="seq")
    assert result.rows == 5
    assert "rangepartitioning(date" in seen[0] and "hashpartitioning(date" not in seen[0]
    assert {r["volume"] for r in store.read("precios_historicos").collect()} == set(range(5))
