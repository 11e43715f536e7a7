"""Wide price files of any width: one line a date, one cell per (ticker, field).

A header names the cells ``{ticker}|{field}`` after the date.  Neither plan nor
number of scans grows with the tickers, and no name reaches the driver: a line
is one text, cut into one array and met by its header's layout (where each
ticker's fields stand), and going wide is one aggregation by date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.operators.ranking import global_row_number
from candela.sources.reshape import FIELDS

#: characters of all distinct headers that go to every task; wider ones are
#: joined by a shuffle over SALTS copies
BROADCAST_CHARS = 64 << 20
SALTS = 64


def write_wide_csv(bars: DataFrame, path: str, files: int = 8, sep: str = "|", date: str = "date") -> None:
    """Long bars (one a date and ticker) as a folder of wide CSV files, each
    with the header of all tickers in order.  A null ticker has no column, a
    missing bar empty cells; a bar without a date is an error."""
    n = len(FIELDS)
    bars = bars.where(F.col("ticker").isNotNull())
    places = global_row_number(bars.select("ticker").distinct(), [F.col("ticker").asc()], "place")
    names = F.array_join(F.transform(F.array_sort(F.collect_list("ticker")), lambda t: F.concat_ws(
        ",", *[F.concat(t, F.lit(f"{sep}{f}")) for f in FIELDS])), ",")
    header = places.agg(F.when(F.count("*") > 0, F.concat(F.lit("Date,"), names)).otherwise(F.lit("Date")).alias("value"))
    cells = F.concat(*[F.concat(F.lit(","), F.coalesce(F.col(f).cast("string"), F.lit(""))) for f in FIELDS])
    placed = bars.join(places, "ticker").select(F.coalesce(F.col(date).cast("string"), F.raise_error(F.lit("a bar without a date"))).alias(date),
                                                F.struct("place", cells.alias("cells")).alias("c"))
    lines = placed.groupBy(date).agg(F.sort_array(F.collect_list("c")).alias("c"))  # a line's cells
    # the cells of a ticker without a bar that day are as many commas
    filled = f"""concat_ws('', transform(c, (x, i) -> concat(
        repeat('{',' * n}', x.place - 1 - CASE WHEN i = 0 THEN 0 ELSE c[i - 1].place END), x.cells)))"""
    behind = places.agg(F.count("*").cast("int")).scalar() - F.expr("c[size(c) - 1].place")
    data = lines.select(
        F.concat(F.col(date), F.expr(filled), F.repeat(F.lit("," * n), behind)).alias("value"),
        F.pmod(F.xxhash64(date), F.lit(files)).alias("file"), F.lit(1).alias("step"))
    heads = header.select("value", F.explode(F.expr(f"sequence(0L, {files - 1}L)")).alias("file"), F.lit(0).alias("step"))
    (heads.unionByName(data).repartition(files, "file").sortWithinPartitions("step", "value")
     .select("value").write.mode("overwrite").text(path))


def read_wide_csv(spark: SparkSession, path: str, start=None, end=None, sep: str = "|") -> DataFrame:
    """The long rows (date, ticker, open, high, low, close, volume) of wide CSV
    files; optional half-open date range.  Lines whose first cell is ``date``
    are headers: each file has one (its own; names may be quoted), anywhere.
    Fields are known in any case, other cells are ignored, what is no number is
    missing, and a ticker without any value that day has no row."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    first = F.lower(F.trim(F.replace(F.substring_index("value", ",", 1), F.lit('"'), F.lit(""))))
    lines = lines.withColumn("is_header", first == F.lit("date"))
    heads = lines.where("is_header").select("file", "value").distinct().withColumn("header", F.xxhash64("value"))
    distinct = heads.select("header", "value").distinct()
    names = distinct.select("header", F.posexplode(F.split("value", ",")).alias("at", "name"))
    names = names.select("header", "at", F.trim(F.replace("name", F.lit('"'), F.lit(""))).alias("name")).where(F.instr("name", sep) > 0)
    names = names.select("header", "at", F.substring_index("name", sep, 1).alias("ticker"),
                         F.lower(F.expr(f"substr(name, instr(name, '{sep}') + {len(sep)})")).alias("field"))
    spots = names.groupBy("header", "ticker").agg(*[F.min(F.when(F.col("field") == f, F.col("at"))).alias(f) for f in FIELDS])
    layouts = spots.groupBy("header").agg(F.collect_list(F.struct("ticker", *FIELDS)).alias("layout"))  # a header's cells
    size = distinct.agg(F.coalesce(F.sum(F.length("value")), F.lit(0))).first()[0]
    by_file = heads.select("file", "header").join(layouts, "header").select("file", "layout")
    data = lines.where("NOT is_header").select("file", "value")
    if size <= BROADCAST_CHARS:
        met = data.join(F.broadcast(by_file), "file")
    else:
        salted = by_file.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = data.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(salted, ["file", "salt"])
    cut = met.select("layout", F.split("value", ",", -1).alias("cells"))
    cut = cut.withColumn("date", F.trim(F.col("cells")[0]).try_cast("date"))
    if start is not None:
        cut = cut.where(F.col("date") >= F.lit(start))
    if end is not None:
        cut = cut.where(F.col("date") < F.lit(end))
    values = ", ".join(f"try_cast(get(cells, x.{f}) AS DOUBLE) AS {f}" for f in FIELDS)
    any_value = " OR ".join(f"r.{f} IS NOT NULL" for f in FIELDS)
    rows = F.expr(f"filter(transform(layout, x -> struct(x.ticker AS ticker, {values})), r -> {any_value})")
    return cut.select("date", F.explode(rows).alias("r")).select("date", "r.*")
