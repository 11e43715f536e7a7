"""Session helpers.

Library code never creates or reconfigures a session on its own; it takes the
caller's ``SparkSession``.  ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

import os
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: rows of series that one task of a window holds: a row takes 1 to 4 KB there,
#: as every sort of a plan keeps its own copy
SERIES_ROWS = 200_000
#: shuffle partitions at most (map status is maps x partitions)
MOST_PARTITIONS = 20_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "candela") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CANDELA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Column-heavy plans (dozens of window expressions) are built through
        # thousands of Python->JVM calls; capturing a Python call site for
        # each one doubles the driver-side build time of a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(os.path.join("/tmp", f"candela-checkpoints-{os.getpid()}"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the one the context has, else the one the
    cluster names in ``spark.checkpoint.dir``.  Without either, on more than
    one machine, there is no folder that all executors see: an error."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext.master.startswith("local["):
        named = os.path.join("/tmp", f"candela-checkpoints-{os.getpid()}")
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when the query ends. Without,
    they stay on the executors' disks until the driver happens to collect its
    garbage. The session's setting is put back."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


#: folders of the frames that ``read_back`` gave
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


#: what was staged in the innermost ``passing``
_PASSING: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


def read_back(df: DataFrame, path: str, **options: object) -> DataFrame:
    """``df`` written as Parquet to the new folder ``path`` and read back."""
    spark = df.sparkSession
    with shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    made = _PASSING.get()
    if made is not None:
        made.append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of staged tables that nothing will read any more.
    Frames that were not staged stay as they are."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            context = table.sparkSession.sparkContext
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def passing() -> Iterator[None]:
    """What is staged within it is deleted at its end: for work that stores its
    results elsewhere."""
    made: list[DataFrame] = []
    outer = _PASSING.set(made)
    try:
        yield
    finally:
        _PASSING.reset(outer)
        discard(*made)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read
    back: computed once, a fraction of what a checkpoint of rows takes, and
    its count comes from the files."""
    return read_back(df, f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df``, of about ``rows`` rows, by ``key`` into tasks of SERIES_ROWS.
    The sizes that Spark coalesces by are of compressed narrow rows, which
    say little about what windows make of them. A small frame stays."""
    if rows <= SERIES_ROWS:
        return df
    n = max(-(-rows // SERIES_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(min(n, MOST_PARTITIONS), key)


def cluster_settings(input_bytes: float, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 << 20, aggregated_share: float = 0.05) -> dict[str, str]:
    """Suggested settings for a run over ``input_bytes`` of line items (the
    caller applies them when building its session; library code never
    changes a session).

    * file splits for about 12 waves of tasks, 64 MiB at least and 1 GiB at
      most, which a split that comes within a tenth of it takes in full (as at
      100 TB): the scan streams, so a split does not have to fit in memory;
    * initial shuffle partitions: one per ``target_partition_bytes`` of what is
      shuffled, ``aggregated_share`` of the input (few columns, combined per
      map task), at least two waves; AQE then coalesces them. Map status is
      maps x reducers: at 100 TB 93,133 x 18,627, about 1.7e9 compressed
      sizes of a byte, and in highly compressed form far less;
    * AQE skew handling splits any shuffle partition over 5x the median.
    """
    slots = executors * cores_per_executor
    share = int(input_bytes // (12 * slots))
    split = 1 << 30 if share > 0.9 * (1 << 30) else max(64 << 20, share)
    partitions = max(2 * slots, int(input_bytes * aggregated_share // target_partition_bytes) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
