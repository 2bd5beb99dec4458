"""Reading the given tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from collarlake.workspace import scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Python workers find this package as the driver does."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows and bytes that travel to a Python worker at once. A worker, and the executor's
# memory outside of its heap, hold a few such batches at a time.
ROWS, BYTES = 1000, 8 * 1024 * 1024


def importable(spark: SparkSession) -> None:
    """Workers of a session that was started elsewhere look into this folder too, and get
    batches of texts that are small beside their memory: the session's limits are lowered
    to ROWS and BYTES where they are higher or off. They stay lowered, since plans that are
    made here run later."""
    limits = spark._jsparkSession.sessionState().conf()  # reads sizes such as 64m as numbers
    for name, now, most in (
        ("maxRecordsPerBatch", limits.arrowMaxRecordsPerBatch(), ROWS),
        ("maxBytesPerBatch", limits.arrowMaxBytesPerBatch(), BYTES),
    ):
        if not 0 < now <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def freed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that gives freed memory back to the system when a task ends.
    Workers are used again by later stages, which need it more."""

    def then(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library, which decides for itself

    return then


class Saved:
    """Tables that one job writes to the shared folder, so that no later step depends on
    what a lost executor held."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self.count = 0
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        self.paths.append(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._saved_at = path
        return saved

    def drop(self, tables: Iterable[DataFrame]) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            self.paths.remove(table._saved_at)
            remove(self.spark, table._saved_at)

    def keep(self, tables: Iterable[DataFrame]) -> None:
        """Delete all tables but these."""
        kept = {table._saved_at for table in tables}
        for path in [p for p in self.paths if p not in kept]:
            self.paths.remove(path)
            remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, by whatever file system it is in."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
