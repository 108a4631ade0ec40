"""What the operators of this subpackage share: run folders, table reads, hot-key joins."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shared_dir

# A side of at most this many rows of a few numbers (below 100 MB) may be sent to all executors.
BROADCAST_ROWS = 1_000_000

# Copies of the unique side of a join whose other side may have hot keys.
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


class Workspace:
    """Tables of one run, in a folder of its own below ``spark.checkpoint.dir``.

    A written table cuts the lineage and outlives lost executors. ``drop`` deletes a table that
    is no longer needed; the folder itself goes when the driver's file system closes.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = shared_dir(spark, purpose)
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._files.mkdirs(path)
        self._files.deleteOnExit(path)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name)), True)


def small_side(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a saved side for broadcast if it is counted and small; else leave the join a shuffle.

    ``frame`` must be a written table of a few narrow columns: counting one reads its footers.
    """
    return F.broadcast(frame) if frame.count() <= rows else frame


def join_hot(many: DataFrame, one: DataFrame, key: str, spread: Column, how: str = "left",
             salts: int = SALTS) -> DataFrame:
    """Join rows with the one row of their key, where a key may hold a large share of all rows.

    The rows of a key are dealt over ``salts`` partitions by ``spread``, and ``one`` is copied to
    each. ``one`` should hold only keys that matter: its size is what gets multiplied.
    """
    salt = "_salt"
    copies = one.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = many.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(copies, [key, salt], how).drop(salt)


# Rows that go to a Python worker at once, unless the session says otherwise than Spark's default:
# texts are long, and a worker holds a batch several times over.
BATCH_ROWS = "1000"
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Workers live on after a task; with these they give large freed blocks back to the system.
_WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2",
                  "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "16777216"}


def importable(spark: SparkSession, lean: bool = False) -> None:
    """Let Python workers find this package where the driver has found it, and keep batches small.

    The path is needed where the package is not installed but lies at one place on all machines,
    and the workers start in another folder than the driver.
    """
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    here = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if here not in paths.split(":"):
        environment["PYTHONPATH"] = f"{paths}:{here}".lstrip(":")
    if lean:
        for name, value in _WORKER_MEMORY.items():
            environment.setdefault(name, value)
