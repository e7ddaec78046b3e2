"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, suppress
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Codec of the layers of a warehouse; about a third smaller than Spark's default.
STORED_AS = "zstd"


# A shuffle partition should fit the memory of a task.
_PARTITION_BYTES = 192 << 20
# So should the rows of a split, which dedup sorts and aggregates group; Parquet holds a row in some ten bytes.
_SPLIT_BYTES = 16 << 20
_SPLIT_KEY = "spark.sql.files.maxPartitionBytes"
# Texts are read and handed to Python in batches of at most so many rows or bytes: a batch is held several times over,
# by the reader, in Arrow's vectors, in the buffer of the pipe and in the worker, and all of them grow by doubling.
_BATCHES = {
    "spark.sql.parquet.columnarReaderBatchSize": 512,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 512,
    "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20,
}


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Initial number of shuffle partitions; adaptive execution merges what turns out small."""
    return max(cores, -(-input_bytes // _PARTITION_BYTES))


def build_session(
    app: str = "tradewind",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the plans are written for; ``conf`` overrides them.

    With ``input_bytes``, the size of the raw tables, the number of shuffle partitions follows it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        wanted = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def small_splits(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` as they are, whose scans deal files out in small splits.

    The size of splits follows the session that opened a table, so the caller's own is left as it is.
    """
    apart = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            apart.conf.set(key, value)
    if _bytes(spark.conf.get(_SPLIT_KEY)) > _SPLIT_BYTES:
        apart.conf.set(_SPLIT_KEY, str(_SPLIT_BYTES))
    return apart


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans that run inside read their files and feed Python in small batches; the caller's settings are as before after it."""
    before = {key: spark.conf.get(key, None) for key in _BATCHES}
    try:
        for key, most in _BATCHES.items():
            # Zero or less stands for no limit.
            if before[key] is None or not 0 < _bytes(before[key]) <= most:
                spark.conf.set(key, str(most))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _bytes(size: str) -> int:
    """A size as settings spell it, like 16m or 134217728b."""
    digits = size.rstrip("bBkKmMgGtT")
    return int(digits) << 10 * " kmgt".index(size[len(digits) :].lower().strip("b") or " ")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without that setting
    gets a temporary folder; on a cluster the absence is an error, since a folder on one machine
    would be lost with it. The application's part of the folder is deleted when the driver ends.
    """
    base = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY, None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set(_CHECKPOINT_KEY, base)
    folder = os.path.join(base, f"tradewind-{spark.sparkContext.applicationId}")
    if folder not in _CLEARED_AT_EXIT:
        _CLEARED_AT_EXIT.add(folder)
        atexit.register(_clear, *file_system(spark, folder))
    return folder


_CLEARED_AT_EXIT: set[str] = set()


def _clear(files: object, where: object) -> None:
    # The JVM may be gone already, after a crash or a kill.
    with suppress(Exception):
        files.delete(where, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage with a table that survives executor loss; unlike a checkpoint of the RDD it
    computes the plan once and stays columnar.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def stored_bytes(df: DataFrame) -> int:
    """Size of the files of a stored table; no job runs for it."""
    total = 0
    for folder in {os.path.dirname(name) for name in df.inputFiles()}:
        files, where = file_system(df.sparkSession, folder)
        total += files.getContentSummary(where).getLength()
    return total


def remove(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote, once nothing reads it any more."""
    for folder in {os.path.dirname(name) for name in df.inputFiles()}:
        files, where = file_system(df.sparkSession, folder)
        files.delete(where, True)
