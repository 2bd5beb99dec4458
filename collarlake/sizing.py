"""Numbers of tasks that fit the size of the data."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

MIB = 1024 * 1024

# Bytes of a Parquet file become about this many times as many in a shuffle.
SHUFFLE_EXPANSION = 3
SHUFFLE_BYTES_PER_TASK = 256 * MIB
# Map tasks times reduce tasks is the number of blocks of a shuffle. These bounds keep
# the blocks of 100 TB near 60 kB each; larger tasks sort on disk.
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SCAN_TASKS = 100_000

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the one it compares with the broadcast threshold."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def shuffle_partitions(input_bytes: int) -> int:
    needed = -(-input_bytes * SHUFFLE_EXPANSION // SHUFFLE_BYTES_PER_TASK)
    return min(needed, MAX_SHUFFLE_PARTITIONS)


def scan_bytes(input_bytes: int) -> int:
    return -(-input_bytes // MAX_SCAN_TASKS)


@contextmanager
def sized_for(*inputs: DataFrame) -> Iterator[None]:
    """Raise the session's numbers of tasks to what the inputs need, within the block.

    The numbers are only ever raised, and adaptive execution joins partitions that turn
    out small, so an estimate that is too high does little harm.
    """
    spark = inputs[0].sparkSession
    total = sum(estimated_bytes(df) for df in inputs)
    conf = spark._jsparkSession.sessionState().conf()
    wanted = {
        SHUFFLE_PARTITIONS: (conf.numShufflePartitions(), shuffle_partitions(total)),
        SCAN_BYTES: (conf.filesMaxPartitionBytes(), scan_bytes(total)),
    }
    raised = {name: str(need) for name, (now, need) in wanted.items() if need > now}
    before = {name: spark.conf.get(name) for name in raised}
    for name, value in raised.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
