"""Tables as Parquet folders."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

PARTITION = "reading_date"
# What Spark calls the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
AUDIT = "table_name string, row_count long, last_altered timestamp"


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a table and its schema."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def overwrite_by_day(
    df: DataFrame,
    path: str,
    day: str,
    *,
    days: Collection[date | None] | None = None,
    rebalance: bool = True,
    cluster: str | None = None,
) -> None:
    """Replace a table that has a folder per day. ``day`` is a SQL expression for it.

    With ``days`` only their folders are replaced, and removed where ``df`` has no rows of
    them. That is done once the new rows are in: a run that fails leaves the old ones.

    The rebalance step gives each day as many files of even size as its rows need: a
    day with very many rows is split, and tasks with little data are joined. It is a
    shuffle, so leave it out where ``df`` is a narrow plan over a table that already
    has a folder per day: its tasks then hold few days each, and write few files.

    ``cluster`` names a column that readers filter by. A day's rows are then dealt by ranges of
    it, in place of the rebalance step, and ordered by it in each file, so that the files'
    statistics tell readers what to skip.
    """
    rows = df.withColumn(PARTITION, F.expr(day).cast("date"))
    if rebalance:
        dealt = rows.hint("rebalance", PARTITION)
        rows = dealt if cluster is None else rows.repartitionByRange(PARTITION, cluster)
    if cluster is not None:
        rows = rows.sortWithinPartitions(PARTITION, cluster)
    mode = "static" if days is None else "dynamic"
    spark = df.sparkSession
    ensure(spark, path)
    folders = [day_folder(path, one) for one in days or ()]
    before = {folder: set(files_in(spark, folder)) for folder in folders}
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(PARTITION)
        .parquet(path)
    )
    for folder, old in before.items():
        # A folder that was written has none of its old files.
        if old and old & set(files_in(spark, folder)):
            remove(spark, folder)


def day_folder(path: str, day: date | None, column: str = PARTITION) -> str:
    return f"{path.rstrip('/')}/{column}={NO_DAY if day is None else day}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _file_system(spark, path)
    return system.exists(where)


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    where, system = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(where)] if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    where, system = _file_system(spark, path)
    system.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another place in the same file system."""
    where, system = _file_system(spark, source)
    to, _ = _file_system(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


def ensure(spark: SparkSession, path: str) -> None:
    """Make the folder of a table that may get no rows."""
    where, system = _file_system(spark, path)
    system.mkdirs(where)


def on_days(
    table: DataFrame, days: Collection[date | None] | None, column: str = PARTITION
) -> DataFrame:
    """Rows of the given days, or all. None among the days stands for rows without a day.

    Other days' folders are not opened.
    """
    if days is None:
        return table
    wanted = F.col(column).isin([day for day in days if day is not None])
    return table.filter(wanted | F.col(column).isNull() if None in days else wanted)


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table. An empty one needs its ``schema``, since it has no file to tell it."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


# Types that take in others without loss, narrow ones first.
WIDER = (
    ("tinyint", "smallint", "int", "bigint"),
    ("tinyint", "smallint", "int", "double"),
    ("float", "double"),
    ("date", "timestamp"),
)


def common_type(types: Collection[str]) -> str:
    """The narrowest type that takes in all of these, text if there is no other."""
    for order in ((t,) for t in types):
        if set(types) <= set(order):
            return order[0]
    for order in WIDER:
        if set(types) <= set(order):
            return max(types, key=order.index)
    return "string"


def read_evolved(
    spark: SparkSession, path: str, days: Collection[date | None] | None = None
) -> DataFrame:
    """A table whose days were written under different schemas: with all columns that any of
    the days has, NULL where a day lacks it, and of a type that takes in all of theirs.

    One footer is read per day. Days of one schema are read together, so the plan grows with
    the number of schemas, not of days. A day's files are of one write, so of one schema.
    """
    if days is None:
        names = (name.partition("=") for name in files_in(spark, path))
        folders = [f"{path}/{key}={text}" for key, _, text in names if key == PARTITION]
    else:
        folders = [f for f in (day_folder(path, day) for day in days) if exists(spark, f)]
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for folder in folders:
        schema = spark.read.parquet(folder).schema
        groups.setdefault(schema.json(), (schema, []))[1].append(folder)
    types: dict[str, list[str]] = {}
    for schema, _ in groups.values():
        for field in schema:
            types.setdefault(field.name, []).append(field.dataType.simpleString())
    columns = {name: common_type(found) for name, found in types.items()}
    parts = []
    for schema, own in groups.values():
        day = StructType([*schema.fields, StructField(PARTITION, DateType())])
        rows = spark.read.schema(day).option("basePath", path).parquet(*own)
        known = set(schema.names)
        parts.append(
            rows.select(
                *(
                    (F.col(f"`{n}`") if n in known else F.lit(None)).cast(kind).alias(n)
                    for n, kind in columns.items()
                ),
                PARTITION,
            )
        )
    if not parts:
        return spark.createDataFrame([], StructType([StructField(PARTITION, DateType())]))
    return reduce(DataFrame.unionByName, parts)


def load_audit(
    spark: SparkSession,
    paths: Mapping[str, str],
    schema: str | None = None,
    columns: Mapping[str, StructType] | None = None,
) -> DataFrame:
    """Row count and last change of each table: columns table_name, row_count, last_altered.

    Tables are named with their schema, as in ``staging.cats``, or without one. ``schema``
    leaves the others out; they are not opened. ``columns`` may hold schemas by the same
    names, for tables that may be empty. No data column is read: counts come from the files'
    footers, the change time from the file listing.
    """
    parts = [
        read(spark, path, (columns or {}).get(name)).agg(
            F.lit(name.rpartition(".")[2]).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("_metadata.file_modification_time").alias("last_altered"),
        )
        for name, path in paths.items()
        if schema is None or name.rpartition(".")[0] == schema
    ]
    if not parts:
        return spark.createDataFrame([], AUDIT)
    return reduce(DataFrame.unionByName, parts)
