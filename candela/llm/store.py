"""Shared scratch storage and small plumbing for the corpus operators.

Intermediate tables are written below the folder the cluster names in
``spark.checkpoint.dir`` (shared by all executors, so a lost executor loses
nothing) and read back, which also cuts lineage.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.session import read_back

#: rows of an Arrow batch: its texts stand in a worker's memory and its JVM's at once
BATCH_ROWS = 1000
#: rows of numbers in a batch that a task gives: its JVM holds each outside the heap, and
#: what large ones of ever other sizes took there does not go back to the system
GIVEN_ROWS = 1 << 14
#: rows after which the Parquet writer first looks at a page's size: at its default of 100,
#: rows of hundreds of kilobytes make pages of tens of megabytes, which its codecs hold
#: outside the heap, when written and when read, for as long as the executor lives
PAGE_ROWS = 4


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """The registered queries and the stages ask for small Arrow batches: with
    the default of 10,000 rows of whole texts, two tasks an executor hold
    hundreds of megabytes twice. A smaller setting of the session is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    return spark


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in batches of at most GIVEN_ROWS rows."""
    for lo in range(0, batch.num_rows, GIVEN_ROWS):
        yield batch.slice(lo, GIVEN_ROWS)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder. Only where the
    session names none (local tests) a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="candela-llm-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    """A mounted file-system path of a shared folder, for files that are
    memory-mapped. Stores without a mount are refused."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    elif "://" in path:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {path}")
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back."""
    return read_back(df, shared_dir(df.sparkSession, name), **{"parquet.page.size.row.check.min": PAGE_ROWS})


def in_order(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, list[tuple]]:
    """``df`` written in ranges of ``order``, with the number of its range,
    ``part``, and ``at``, which rises with the order; and (part, rows, first at)
    of every range. No task holds more than its range."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    counts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()  # a row a range
    return placed, sorted(tuple(r) for r in counts)


def numbered(df: DataFrame, order: list[Column], number: str, first: int, name: str) -> DataFrame:
    """``df`` with consecutive numbers from ``first`` on in the order."""
    placed, parts = in_order(df, order, name)
    rows, before = [], first
    for part, n, start in parts:
        rows.append((part, before - start))
        before += n
    shifts = df.sparkSession.createDataFrame(rows, "part int, shift long")
    return placed.join(F.broadcast(shifts), "part").withColumn(number, F.col("at") + F.col("shift")).drop("part", "at", "shift")


def write_atomic(path: str, write) -> None:
    """Write a file under a private name, then rename: a retried or
    speculative task replaces it with the same bytes."""
    private = f"{path}.{uuid.uuid4().hex}"
    with open(private, "wb") as f:
        write(f)
    os.replace(private, path)


def give_back() -> None:
    """Freed memory goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(run):
    """A task function that drops what modules keep and gives freed memory back
    at its end: Python workers live on between tasks, and those of a later stage
    need the room."""
    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            for module, drop in (("candela.llm.tokens", "drop_encoders"), ("candela.llm.text", "drop_powers")):
                if module in sys.modules:
                    getattr(sys.modules[module], drop)()
            give_back()

    return task


def position(df: DataFrame, name: str) -> int:
    """Place of a column: of names that differ in case alone, the exact one."""
    names = df.columns
    if name in names:
        return names.index(name)
    return [c.lower() for c in names].index(name.lower())


def flat(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..., so that none clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def fitted(df: DataFrame, **types: str) -> DataFrame:
    """The named columns of ``df`` alone, cast: extra columns, whatever their
    names, never reach an operator."""
    plain = flat(df)
    return plain.select(*[plain[f"c{position(df, c)}"].cast(t).alias(c) for c, t in types.items()])


def extended(df: DataFrame, column: str, added: dict[str, str], make) -> DataFrame:
    """``df`` with further columns that ``make`` computes from an Arrow array
    of the text column ``column``. Other columns are kept as they are, but for
    such as bear a new column's name."""
    new_names = {a.lower() for a in added}
    stay = [i for i, c in enumerate(df.columns) if c.lower() not in new_names]
    names = [df.columns[i] for i in stay]
    plain = flat(df)
    at = position(df, column)
    columns = [plain[f"c{i}"] for i in stay]
    if at in stay and plain.schema[f"c{at}"].dataType == T.StringType():
        place = stay.index(at)  # the texts go to the workers once
    else:
        columns.append(plain[f"c{at}"].cast("string").alias("read"))
        place = len(names)
    kept = plain.select(*columns)
    n = len(names)

    def run(batches):
        for batch in batches:
            new = make(batch.column(place))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names=[*batch.schema.names[:n], *added])

    schema = T.StructType(kept.schema.fields[:n])
    for name, kind in added.items():
        schema = schema.add(name, kind, True)
    return kept.mapInArrow(released(run), schema).toDF(*names, *added)
