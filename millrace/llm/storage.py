"""Written tables that cut lineage.

Intermediate results go to Parquet below ``spark.checkpoint.dir``, which driver and executors share, so a lost
executor costs the tasks it ran and nothing else.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Bytes of texts or sets that a Python worker gets at once.
BATCH = "8m"


def give_back() -> None:
    """Hand what this process has freed back to the system: a Python worker lives on after its task, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one where none is set, and only if the executors are in this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(_delete, spark, found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the JVM may be gone at exit; files in the checkpoint folder are then the cluster's to expire
        pass


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: str | None) -> Iterator[None]:
    """Batches to Python workers hold at most so many bytes meanwhile: for rows that carry large arrays."""
    name, old = "spark.sql.execution.arrow.maxBytesPerBatch", None
    if size:
        old = spark.conf.get(name)
        spark.conf.set(name, size)
    try:
        yield
    finally:
        if size:
            spark.conf.set(name, old)


class Stash:
    """Parquet tables of one operator run, below one folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.made = 0
        self.paths: set[str] = set()
        atexit.register(_delete, spark, self.base)  # what a lazy result still reads stays as long as the session

    def keep(self, df: DataFrame, name: str, batch: str | None = None) -> DataFrame:
        """Write df and return the written table; ``batch`` bounds the bytes that Python workers get at once."""
        self.made += 1
        path = f"{self.base}/{self.made:03d}-{name}"
        self.paths.add(path)
        with arrow_batches(self.spark, batch):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stash_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Delete a table that keep() returned, once nothing reads it any more."""
        if path := getattr(df, "_stash_path", None):
            _delete(self.spark, path)
            self.paths.discard(path)

    def drop_others(self, *needed: DataFrame) -> None:
        """Delete all tables kept so far but the needed ones."""
        for path in self.paths - {getattr(df, "_stash_path", None) for df in needed}:
            _delete(self.spark, path)
        self.paths &= {getattr(df, "_stash_path", None) for df in needed}
