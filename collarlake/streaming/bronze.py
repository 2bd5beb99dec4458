"""Streaming ingest of collar files into the append-only bronze table.

Beside bronze there are two small tables: the lines that could not be read, or not all of
them, with their text; and a log with a row for each batch, written last, that says which
days the batch's readings belong to.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType

from collarlake.functions.cleaning import parse_reading_time
from collarlake.schemas import BATCH, BATCH_LOG, BRONZE_FILES, QUARANTINE, RAW_DAY, RAW_TELEMETRY
from collarlake.sizing import sized_for
from collarlake.sources.tables import NO_DAY, day_folder, exists, files_in, move, remove

# The source skips files that are much older than the newest one it has seen, seven days
# by default. Late uploads keep their old times, so no file may ever count as too old.
NEVER_TOO_OLD = "36500d"

# The text of a line that is no JSON, or has a value that does not fit its column.
CORRUPT = "_corrupt_record"
BROKEN, MISTYPED = "broken", "mistyped"


def quarantine_of(path: str) -> str:
    """Where the lines are that bronze at ``path`` could not take in whole."""
    return f"{path.rstrip('/')}_quarantine"


def log_of(path: str) -> str:
    return f"{path.rstrip('/')}_log"


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_TELEMETRY,
    max_files_per_batch: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """New JSON files as a stream.

    ``max_files_per_batch`` bounds a batch after a backlog. With ``archive`` files are
    moved there once ingested, so that the landing folder stays quick to list. A line that
    is no JSON is a row of NULLs, a value that does not fit its column a NULL; either
    way the line's text is in the column CORRUPT.
    """
    columns = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.readStream.schema(columns).option("maxFileAge", NEVER_TOO_OLD)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def with_ingest_audit(df: DataFrame) -> DataFrame:
    """Ingest time, one per micro-batch, and source file."""
    return df.withColumns(
        {"ingested_at": F.current_timestamp(), "source_file": F.col("_metadata.file_path")}
    )


def rescued(batch: DataFrame) -> DataFrame:
    """The lines of a batch that could not be read whole: their text, whether they are no
    JSON at all or have values that do not fit, and the columns of these values."""
    line = F.col(CORRUPT)

    def lost(name: str) -> Column:
        given = F.get_json_object(line, f"$.{name}")
        return F.when(given.isNotNull() & F.col(name).isNull(), F.lit(name))

    parsed = F.try_parse_json(line).isNotNull()
    names = [n for n in RAW_TELEMETRY.names if n in batch.columns]
    return batch.filter(line.isNotNull()).select(
        line.alias("line"),
        F.when(parsed, MISTYPED).otherwise(BROKEN).alias("reason"),
        F.when(parsed, F.array_compact(F.array(*map(lost, names)))).alias("bad_columns"),
        "ingested_at",
        "source_file",
    )


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write a micro-batch: a folder per day of the readings and, in it, one of the batch.

    The rebalance step brings a day's readings together, so that a batch adds few files to
    each day however many tasks read it; large days are split. Within a file rows are
    ordered by animal, so that readers of some animals skip row groups. Lines that could not
    be read whole are a second pass over the batch, made only if there are any. A batch that
    runs again after a failure replaces its folders.
    """
    if CORRUPT not in batch.columns:
        batch = batch.withColumn(CORRUPT, F.lit(None).cast("string"))
    seen = Observation()
    day, whole = F.col(RAW_DAY), "_whole"
    rows = batch.withColumns(
        {
            RAW_DAY: parse_reading_time(F.col("reading_time")).cast("date"),
            BATCH: F.lit(batch_id).cast("long"),
            whole: F.col(CORRUPT).isNull(),
        }
    )
    placed = rows.drop(CORRUPT).hint("rebalance", RAW_DAY)
    placed = placed.sortWithinPartitions(RAW_DAY, BATCH, "cat_id").observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col(whole)).alias("n_quarantined"),
        F.collect_set(day.cast("string")).alias("days"),  # as many as there are days
        F.count_if(day.isNull()).alias("undated"),
    )
    (
        placed.drop(whole)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RAW_DAY, BATCH)
        .parquet(path)
    )
    found = seen.get
    folder = f"{BATCH}={batch_id}"
    if found["n_quarantined"]:
        _replace(rescued(batch), f"{quarantine_of(path)}/{folder}")
    days = sorted(date.fromisoformat(text) for text in found["days"])
    one = [(days, found["undated"] > 0, found["n_rows"], found["n_quarantined"])]
    columns = StructType(BATCH_LOG.fields[:-1])
    log = batch.sparkSession.createDataFrame(one, columns).coalesce(1)
    _replace(log, f"{log_of(path)}/{folder}")


def _replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def batches(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Numbers of the batches that are in bronze and later than ``after``."""
    names = (name.partition("=") for name in files_in(spark, log_of(path)))
    found = (int(number) for key, _, number in names if key == BATCH)
    return sorted(n for n in found if n > after)


def read_log(spark: SparkSession, path: str, after: int = -1) -> DataFrame:
    """The log of the batches after one; the folders of the others are not opened."""
    return _by_batch(spark, log_of(path), BATCH_LOG, batches(spark, path, after))


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """All lines that bronze at ``path`` could not take in whole."""
    where = quarantine_of(path)
    if not files_in(spark, where):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(where)


def _by_batch(
    spark: SparkSession, root: str, schema: StructType, numbers: list[int]
) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/{BATCH}={n}" for n in numbers]
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def days_of_batches(spark: SparkSession, path: str, after: int = -1) -> set[date | None]:
    """The days that the batches after one brought readings of; None stands for readings
    without a valid time. No reading is read."""
    days: set[date | None] = set()
    for row in read_log(spark, path, after).select("days", "undated").toLocalIterator():
        days.update(row.days)
        if row.undated:
            days.add(None)
    return days


def start_bronze(
    bronze: DataFrame, path: str, checkpoint: str, *, continuous: bool = False
) -> StreamingQuery:
    """Append a stream to bronze. Without ``continuous`` it ends when all files are read.

    The checkpoint holds which files were read and which batch they are in, and a batch
    replaces itself, so a restart after a failure neither loses nor repeats a file.
    Readers need no log of the writer: a reading's day and batch are in its folder's name.
    """
    writer = (
        bronze.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, path))
    )
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    max_files_per_batch: int | None = None,
    archive: str | None = None,
) -> None:
    """Ingest all files that are new since the last run, and return when they are in."""
    files = read_landing(
        spark, landing, max_files_per_batch=max_files_per_batch, archive=archive
    )
    start_bronze(with_ingest_audit(files), path, checkpoint).awaitTermination()


PLAN = StructType(
    [
        StructField(RAW_DAY, DateType()),
        StructField("into", LongType()),
        StructField("replaced", ArrayType(LongType())),
    ]
)


def compacting_of(path: str) -> str:
    """Where compaction prepares files, out of the readers' sight."""
    return f"{path.rstrip('/')}_compacting"


def compact(spark: SparkSession, path: str, days: Collection[date | None] | None = None) -> None:
    """Rewrite days that have several batch folders so that each has one, that of its last
    batch; large days keep as many files as their rows need.

    The new files are written aside, then what replaces what, and only then folders are
    exchanged, day by day. A compaction that stopped in between is finished by the next
    call. Batches that come in meanwhile are not touched. Readers of a day that is being
    exchanged may miss it, so no build may run at the same time.
    """
    _finish_compaction(spark, path)
    if days is None:
        names = (name.partition("=") for name in files_in(spark, path))
        texts = [text for key, _, text in names if key == RAW_DAY]
        days = [None if text == NO_DAY else date.fromisoformat(text) for text in texts]
    held = {day: _batches_of(spark, path, day) for day in days}
    todo = {day: numbers for day, numbers in held.items() if len(numbers) > 1}
    if not todo:
        return
    aside = compacting_of(path)
    folders = [
        f"{day_folder(path, day, RAW_DAY)}/{BATCH}={n}" for day, ns in todo.items() for n in ns
    ]
    rows = spark.read.schema(BRONZE_FILES).option("basePath", path).parquet(*folders)
    with sized_for(rows):
        (
            rows.drop(BATCH)
            .hint("rebalance", RAW_DAY)
            .sortWithinPartitions(RAW_DAY, "cat_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(RAW_DAY)
            .parquet(f"{aside}/data")
        )
    plan = [(day, max(numbers), numbers) for day, numbers in todo.items()]
    _replace(spark.createDataFrame(plan, PLAN).coalesce(1), f"{aside}/plan")
    _finish_compaction(spark, path)


def _batches_of(spark: SparkSession, path: str, day: date | None) -> list[int]:
    names = (n.partition("=") for n in files_in(spark, day_folder(path, day, RAW_DAY)))
    return sorted(int(number) for key, _, number in names if key == BATCH)


def _finish_compaction(spark: SparkSession, path: str) -> None:
    """Exchange the folders of a compaction whose files are all written; drop one whose
    files are not. Days that were exchanged before have nothing aside any more."""
    aside = compacting_of(path)
    if "_SUCCESS" in files_in(spark, f"{aside}/plan"):
        for row in spark.read.schema(PLAN).parquet(f"{aside}/plan").toLocalIterator():
            new = day_folder(f"{aside}/data", row[RAW_DAY], RAW_DAY)
            if exists(spark, new):
                folder = day_folder(path, row[RAW_DAY], RAW_DAY)
                for number in row.replaced:
                    remove(spark, f"{folder}/{BATCH}={number}")
                move(spark, new, f"{folder}/{BATCH}={row.into}")
    remove(spark, aside)
