"""Stored layouts: bucketed tables, rejects, the store's commits."""

import datetime as dt
import os
import tempfile
import time

from pyspark.sql import functions as F

from candela.operators.integrity import split_rejects
from candela.plans import analyst, stored
from candela.plans.daily import load_table
from candela.session import discard, passing, staged
from candela.sinks import TableStore
from conftest import SF001, make_bars


def scratch():
    return tempfile.mkdtemp(prefix="candela-test-", dir="/tmp")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_of_bucketed_tables_need_no_exchange(spark):
    bars = make_bars(spark, {f"T{i}": [float(i + k % 3) for k in range(30)] for i in range(12)})
    ind = bars.select("date", "ticker", "close", F.col("close").alias("sma_20"), (F.col("close") + 1).alias("ema_20"))
    names = {"test_prices": bars, "test_indicators": ind}
    for name, df in names.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        stored.save_bucketed(df, name, os.path.join(scratch(), name), 4)
    own = stored.co_located(spark)
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    own.conf.set("spark.sql.adaptive.enabled", "false")
    alerts = analyst.trading_alerts(own.table("test_indicators"), own.table("test_prices"))
    assert "Exchange" not in _plan(alerts) and "SortMergeJoin" in _plan(alerts)
    assert {r.decision_trading for r in alerts.collect()} == {"POSIBLE VENTA"} and alerts.count() == 12 * 30
    one = own.table("test_prices").where("ticker = 'T3'")
    assert one.count() == 30
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_rejects_carry_their_reason(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, "A", 1.0, 1), (day, "A", 2.0, 2), (day, "A", 2.0, 3), (day, "X", 1.0, 4), (day, "X", 1.0, 5), (None, "A", 1.0, 6),
            (day, None, 1.0, 7), (day, "B", None, 8)]
    batch = spark.createDataFrame(rows, "date date, ticker string, close double, seq int")
    parent = spark.createDataFrame([("A",), ("B",), (None,), ("A",)], "ticker string")
    checked = split_rejects(batch, parent, ["date", "ticker"], "ticker", "seq")
    assert checked.good.columns == batch.columns and sorted(r.seq for r in checked.good.collect()) == [1, 8]
    assert sorted((r.seq, r.reason) for r in checked.rejects.collect()) == [
        (2, "duplicate"), (3, "duplicate"), (4, "orphan"), (5, "orphan"), (6, "null key"), (7, "null key")]


def test_a_day_spreads_over_tasks_and_an_empty_load_leaves_nothing(spark):
    store = TableStore(spark, scratch())
    day = spark.range(20_000).select(F.lit(dt.date(2024, 1, 1)).alias("date"), F.concat(F.lit("T"), "id").alias("ticker"),
                                     *[F.lit(1.5).alias(c) for c in ("open", "high", "low", "close")], F.col("id").alias("volume"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_table(store, "precios_historicos", day, 1, unique_source=True, batch="a:0")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(store.read("precios_historicos").inputFiles()) > 1
    before = sorted(os.listdir(os.path.join(store.base, "precios_historicos")))
    assert not load_table(store, "precios_historicos", day, 2, unique_source=True, batch="a:1").written
    assert sorted(os.listdir(os.path.join(store.base, "precios_historicos"))) == before
    assert store.loaded("precios_historicos", "a:0") and not store.loaded("precios_historicos", "a:1")
    # a retried version replaces its manifest in one step
    load_table(store, "precios_historicos", day, 1, unique_source=True, batch="a:0")
    assert store.versions("precios_historicos") == [1] and store.read("precios_historicos").count() == 20_000


def _shuffle_files(spark):
    return spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",").count("shuffle_")


def _folders(spark):
    at = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {n for n in os.listdir(at) if not n.startswith("rdd-")}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    rows = spark.range(5000).withColumn("k", F.col("id") % 50)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    rows.groupBy("k").count().write.mode("overwrite").format("noop").save()  # so that there are files of others
    spark.sparkContext._jvm.System.gc()
    before = _shuffle_files(spark)
    kept = staged(rows.join(rows.groupBy("k").agg(F.max("id").alias("m")), "k"), "joined")
    price = make_bars(spark, {"A": [1.0, 2.0]}).withColumn("open", F.col("close"))
    load_table(TableStore(spark, scratch()), "precios_historicos", price, 1)
    until = time.time() + 20
    while _shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert kept.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting


def test_daily_runs_leave_their_store_alone(spark):
    there = _folders(spark) if spark.sparkContext.getCheckpointDir() else set()
    got = stored.stored_indicators(spark, SF001, [dt.date(1999, 12, 31), dt.date(2100, 1, 1)])
    assert {n.split("-")[0] for n in _folders(spark) - there} == {"store"}
    assert got.count() > 0


def test_only_staged_tables_are_discarded(spark):
    rows = spark.range(10)
    path = scratch() + "/given"
    rows.write.parquet(path)
    given, first = spark.read.parquet(path), staged(rows, "first")
    with passing():
        second = staged(first, "second")
        assert second.count() == 10
    third = first.select("id")
    discard(given, third)
    assert given.count() == third.count() == first.count() == 10
    left = _folders(spark)
    discard(first, first)
    assert {n.split("-")[0] for n in left - _folders(spark)} == {"first"}
    assert not any(n.startswith("second") for n in left)
