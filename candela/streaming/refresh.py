"""Landed price batches -> versioned price table, as a streaming query.

``readStream`` over the landing folder; every micro-batch is cleaned and
loaded with the price table's rule (rows after the table's maximum date, the
first of duplicates) through ``foreachBatch``.  A load is the table's next
version, whatever the checkpoint: a query that begins anew on an old store
appends what is new.  The manifest names the batch it came from, so a retried
batch is recognised and changes nothing.  Deduplication is by the table's
watermark and by key inside the batch, so no streaming state is needed.
``trigger(availableNow=True)`` processes what has landed and stops: the
daily schedule of the original job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candela.plans.daily import load_table
from candela.plans.tables import clean_prices
from candela.sinks import TableStore

LANDED_BARS = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])


def start_price_refresh(spark: SparkSession, landing_dir: str, store_base: str, checkpoint_location: str,
                        table: str = "precios_historicos") -> StreamingQuery:
    """``checkpoint_location`` belongs to one pair of landing folder and store."""
    store = TableStore(spark, store_base)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{query}:{batch_id}"
        if store.loaded(table, name):
            return
        arrival = F.struct(F.col("_at").alias("at"), F.col("_file").alias("file"), F.monotonically_increasing_id().alias("row"))
        bars = batch.withColumn("arrival", arrival)
        clean = clean_prices(bars, keep=["arrival"])
        version = max(store.versions(table), default=0) + 1
        load_table(store, table, clean, version, seq="arrival", batch=name)

    stream = spark.readStream.schema(LANDED_BARS).parquet(landing_dir).select(
        "*", F.col("_metadata.file_modification_time").alias("_at"), F.col("_metadata.file_path").alias("_file"))
    return (stream.writeStream.foreachBatch(load_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())
