"""Session settings the warehouse relies on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # One explicit zone: dates and window bounds never depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, also where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed streaming state lives off-heap and is checkpointed as change logs.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Landed logs, keyed tables and state are most of what a job keeps on disk: a third less of it than by the defaults.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # Counting keys costs a read of the state for each write to it.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # A join of streams keeps one store a partition, not four: each is opened, committed and held on disk on its own.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # A store's files take the room that they need, not some megabytes each from the start.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # All stores of an executor share this much memory; else each of them fills buffers of its own.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    # The stores of a query that has ended, and what compaction has replaced, go soon.
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
    # A query starts again from its last batches only.
    "spark.sql.streaming.minBatchesToRetain": "8",
    # A task writes so many partitions of a table side by side before it sorts its rows by them.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    importable(spark)
    return spark


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has found it."""
    here = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if here not in paths.split(":"):
        environment["PYTHONPATH"] = f"{paths}:{here}".lstrip(":")


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


# One shuffle partition per this much input.
SHUFFLE_BYTES = 512 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system's own records."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def stamp(files, status, second: int) -> None:
    files.setTimes(status.getPath(), 1000 * second, 1000 * second)


def in_name_order(spark: SparkSession, folder: str) -> None:
    """Stamp a folder's data files so that a stream, which goes by their times, reads them in the order of their names.

    Where the store keeps no times that are set, each file is written again, one after another.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def data():
        return sorted((s for s in files.listStatus(at(folder)) if not s.getPath().getName().startswith(("_", "."))),
                      key=lambda s: s.getPath().getName())

    found = data()
    first = min((s.getModificationTime() for s in found), default=0) // 1000 - len(found)
    for second, status in enumerate(found, first):
        stamp(files, status, second)
    if [s.getModificationTime() for s in data()] != [1000 * s for s in range(first, first + len(found))]:
        for status in found:
            spark.read.parquet(status.getPath().toString()).coalesce(1).write.mode("append").parquet(folder)
            files.delete(status.getPath(), False)


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Raise the number of shuffle partitions to suit an input of ``size`` bytes.

    A number that the user has set higher stays. Adaptive execution merges partitions that turn out small, but it cannot cut evenly large
    ones: the number must be high enough from the start. A stream keeps the number of its
    first start, so call this before.
    """
    cores = spark.sparkContext.defaultParallelism
    number = max(cores, -(-size // SHUFFLE_BYTES))
    number = max(number, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


# Bytes of the tables whose messages share one partition of a stream's state.
STATE_BYTES = 128 * 1024 * 1024
# For streams that go through an input and end.
BOUNDED_CONF = {
    # Ids, amounts and messages hardly repeat: a dictionary of them is built, compared with each value and thrown away.
    "parquet.enable.dictionary": "false",
    # State that is mostly written once has one copy, its change logs; a snapshot would be a second one.
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "100",
}
PARTITIONS, CLEANUP = "spark.sql.shuffle.partitions", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def restore(spark: SparkSession, before: dict[str, str | None]) -> None:
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile leaves no shuffle files behind."""
    before = {CLEANUP: spark.conf.get(CLEANUP, None)}
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        restore(spark, before)


@contextmanager
def streaming(spark: SparkSession, size: int, read_size: int) -> Iterator[None]:
    """Settings for the streams that are started meanwhile, over an input of ``size`` bytes.

    Each micro-batch opens and commits the state of each partition, which takes about a quarter of a second however little
    it holds: there are as many as the input asks for, in whole rounds of the cores, also where the session has more. The
    shuffle of a micro-batch is deleted when that has ended. What is read afterwards has shuffles for ``read_size`` bytes.
    """
    found, cores = spark.conf.get(PARTITIONS), spark.sparkContext.defaultParallelism
    spark.conf.set(PARTITIONS, str(cores * max(2, -(-size // (cores * STATE_BYTES)))))
    before = {name: spark.conf.get(name, None) for name in BOUNDED_CONF}
    for name, value in BOUNDED_CONF.items():
        spark.conf.set(name, value)
    try:
        with shuffles_deleted(spark):
            yield
    finally:
        restore(spark, before)
        spark.conf.set(PARTITIONS, str(max(int(found), -(-read_size // SHUFFLE_BYTES))))


def _files_of(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _files_of(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    files, folder = _files_of(spark, path)
    files.delete(folder, True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the shared folder named in ``spark.checkpoint.dir``.

    Only a local master may go without that setting; it then uses the machine's own
    temporary folder, which every task can see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = "/tmp/tidemart"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
