"""Results do not depend on how the data is partitioned."""

from pyspark.sql import functions as F

from candela.operators.ranking import global_row_number
from candela.operators.technical import technical_indicators
from candela.sources.bars import supplier_bars
from conftest import SF001


def test_indicators_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("3", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = technical_indicators(supplier_bars(spark, SF001), complete=True)
            results.append(sorted(tuple(r) for r in df.collect()))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("g"))
    ranked = global_row_number(df, [F.col("g").desc(), F.col("k").asc()], "r", num_partitions=17)
    got = [(r.g, r.k, r.r) for r in ranked.orderBy("r").collect()]
    want = sorted(((g, k) for g, k, _ in got), key=lambda t: (-t[0], t[1]))
    assert [r for _, _, r in got] == list(range(1, 5001))
    assert [(g, k) for g, k, _ in got] == want
