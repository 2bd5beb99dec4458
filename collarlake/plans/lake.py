"""The whole chain, from new files to the flat mart.

Every table is written once and read by what follows, so a lost executor costs the
tasks it ran, never an earlier table. A run over some days reads and rewrites only the
folders of these days. A run that is given none finds them: the days that batches
ingested since the last run brought readings of, and those of animals that came to the
registry or left it. Animals whose profile changed are refreshed in the flat mart.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from collarlake.operators import quality
from collarlake.plans import models, progress
from collarlake.plans.silver import clean, silver
from collarlake.schemas import BRONZE, STAGING_REGISTRY, STAGING_TELEMETRY, all_text
from collarlake.sizing import sized_for
from collarlake.sources import loads, tables
from collarlake.sources.registry import load_registry, read_registry_csv
from collarlake.sources.telemetry import load_telemetry, read_bronze, split_load
from collarlake.streaming import bronze as stream
from collarlake.streaming.bronze import ingest


@dataclass(frozen=True)
class Lake:
    """Where the tables are. ``landing`` and ``registry`` are inputs, the rest is written
    below ``root``. Ingested files are moved to ``archive``, if there is one, which keeps
    the landing folder and the list of known files short. Silver files that are no whole
    Parquet files are left out of the load and named, unless ``skip_bad_files`` is off."""

    root: str
    landing: str
    registry: str
    archive: str | None = None
    skip_bad_files: bool = True

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


# Days to rebuild, or None for all. None among the days stands for readings without a day.
Days = Collection[date | None] | None
# The days that changed since the last run.
NEW = "new"

TABLES = (
    "bronze",
    "silver",
    "staging_telemetry",
    "staging_registry",
    "dim_cats",
    "fact_readings",
    "daily_health",
    "bi_flat",
)

DAY = "reading_date"
DAY_OF_READING = "cast(reading_time as date)"


def _many(days: Days) -> bool:
    """Whether tasks may hold several days. Rows of one day need no regrouping by day."""
    return days is None or len(days) > 1


@lru_cache(maxsize=1)
def schemas(spark: SparkSession) -> dict[str, StructType]:
    """The schema of every written table, which an empty one has no file to tell."""

    def empty(schema: StructType) -> DataFrame:
        return spark.createDataFrame([], schema)

    rows = silver(empty(BRONZE), empty(all_text(STAGING_REGISTRY)))
    readings = models.stg_telemetry(empty(STAGING_TELEMETRY))
    cats = models.dim_cats(models.stg_registry(empty(STAGING_REGISTRY)))
    health = models.daily_health(models.daily_telemetry(readings))
    found = {
        "silver": rows,
        "staging_telemetry": empty(STAGING_TELEMETRY),
        "rejected_telemetry": split_load(rows).rejected,
        "staging_registry": empty(STAGING_REGISTRY),
        "dim_cats": cats,
        "fact_readings": models.fact_readings(readings),
        "daily_health": health,
        "bi_flat": models.bi_flat(health, cats),
    }
    whole = {"staging_registry", "dim_cats"}
    return {
        name: df.schema if name in whole else df.withColumn(DAY, F.lit(None).cast("date")).schema
        for name, df in found.items()
    }


def read(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    return tables.read(spark, lake.path(table), schemas(spark)[table])


def read_silver(spark: SparkSession, lake: Lake, days: Days = None) -> DataFrame:
    """Silver with all columns that the registry has had, whenever a day was built."""
    return tables.read_evolved(spark, lake.path("silver"), days)


def build_bronze(spark: SparkSession, lake: Lake, max_files_per_batch: int | None = None) -> None:
    tables.ensure(spark, lake.landing)
    ingest(
        spark,
        lake.landing,
        lake.path("bronze"),
        lake.path("checkpoints/bronze"),
        max_files_per_batch,
        lake.archive,
    )
    tables.ensure(spark, lake.path("bronze"))


def compact_bronze(spark: SparkSession, lake: Lake, days: Days = None) -> None:
    """Join the folders that batches left in bronze's days. No build may run meanwhile."""
    stream.compact(spark, lake.path("bronze"), days)


def build_silver(spark: SparkSession, lake: Lake, days: Days = None) -> None:
    """Rebuild silver, or only the given days of it.

    Duplicates of a reading have the same time, so a day can be rebuilt on its own. So
    can the readings without a valid time, which are in no day.
    """
    bronze = read_bronze(spark, lake.path("bronze"), days)
    with sized_for(bronze):
        tables.overwrite_by_day(
            silver(bronze, read_registry_csv(spark, lake.registry)),
            lake.path("silver"),
            "cast(parsed_reading_time as date)",
            days=days,
            rebalance=_many(days),
        )


def build_staging(spark: SparkSession, lake: Lake, days: Days = None) -> None:
    """Load silver and the registry into the typed staging tables.

    Days whose files were all loaded before are not opened; one with new, changed or
    vanished files is loaded anew. Rows that do not fit go to rejected_telemetry, by day like
    the others. What was loaded and left out is in load_files and load_history.
    """
    load_id = loads.next_load(spark, lake.path("load_history"))
    _load_readings(spark, lake, days, load_id)
    _load_registry(spark, lake, load_id)


def _changed(
    spark: SparkSession, files: DataFrame, manifest: str, table: str, days: Days
) -> set[date | None]:
    """Days to load. Without the table itself no file counts as loaded."""
    known = tables.on_days(loads.read_manifest(spark, manifest), days)
    if not tables.files_in(spark, table):
        known = known.limit(0)
    return loads.changed_days(files, known)


def _load_readings(spark: SparkSession, lake: Lake, days: Days, load_id: int) -> None:
    started = datetime.now()
    silver_path, staging, manifest = map(lake.path, ("silver", "staging_telemetry", "load_files"))
    history = lake.path("load_history")
    files = loads.listed(spark, silver_path, days)
    part: Days = _changed(spark, files, manifest, staging, days)
    if not part:
        tables.ensure(spark, staging)
        tables.ensure(spark, lake.path("rejected_telemetry"))
        loads.record(spark, history, load_id, "staging_telemetry", started, 0)
        return
    if days is None and not tables.files_in(spark, staging):
        part = None
    schema = schemas(spark)["silver"]
    bad = loads.bad_files(spark, silver_path, schema, part) if lake.skip_bad_files else []
    counts = Observation()
    skip = [path for path, _ in bad]
    load = load_telemetry(spark, silver_path, part, counts, skip, schema)
    with sized_for(load.loaded):
        tables.overwrite_by_day(
            load.loaded, staging, DAY_OF_READING, days=part, rebalance=False
        )
    rejected = load.rejected if counts.get["rejected"] else load.rejected.limit(0)
    tables.overwrite_by_day(
        rejected,
        lake.path("rejected_telemetry"),
        "try_cast(reading_time as date)",
        days=part,
        rebalance=False,
    )
    reasons = spark.createDataFrame(bad, "path string, skipped string")
    loaded = tables.on_days(files, part).join(reasons, "path", "left")
    loaded = loaded.withColumn("load_id", F.lit(load_id).cast("long"))
    tables.overwrite_by_day(loaded, manifest, DAY, days=part)
    loads.record(
        spark,
        history,
        load_id,
        "staging_telemetry",
        started,
        counts.get["rows"] - counts.get["rejected"],
        counts.get["rejected"],
        tables.on_days(files, part).count() - len(bad),
        len(bad),
    )


def _load_registry(spark: SparkSession, lake: Lake, load_id: int) -> None:
    started = datetime.now()
    manifest, staging = lake.path("registry_files"), lake.path("staging_registry")
    files = loads.listed(spark, lake.registry)
    if not _changed(spark, files, manifest, staging, None):
        loads.record(spark, lake.path("load_history"), load_id, "staging_registry", started, 0)
        return
    counts = Observation()
    rows = load_registry(spark, lake.registry).observe(counts, F.count(F.lit(1)).alias("rows"))
    tables.overwrite(rows, staging)
    known = files.withColumns(
        {"skipped": F.lit(None).cast("string"), "load_id": F.lit(load_id).cast("long")}
    )
    tables.overwrite(known, manifest)
    loads.record(
        spark,
        lake.path("load_history"),
        load_id,
        "staging_registry",
        started,
        counts.get["rows"],
        files=files.count(),
    )


def load_history(spark: SparkSession, lake: Lake) -> DataFrame:
    """A row for each load of each staging table: times, rows loaded and rejected, files loaded
    and left out."""
    return loads.read_history(spark, lake.path("load_history"))


def skipped_files(spark: SparkSession, lake: Lake) -> DataFrame:
    """Files that the loads left out, with the reason."""
    return loads.read_manifest(spark, lake.path("load_files")).filter("skipped is not null")


def quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    """Lines that bronze could not take in whole."""
    return stream.read_quarantine(spark, lake.path("bronze"))


def audit(spark: SparkSession, lake: Lake, schema: str | None = None) -> DataFrame:
    """Row count and last change of the written tables, or of those of one schema: raw,
    staging or marts. To be asked for after a load."""
    raw, staging = ("silver",), ("staging_telemetry", "rejected_telemetry", "staging_registry")
    known = schemas(spark)
    names = {t: "raw" if t in raw else "staging" if t in staging else "marts" for t in known}
    return tables.load_audit(
        spark,
        {f"{group}.{t}": lake.path(t) for t, group in names.items()},
        schema,
        {f"{group}.{t}": known[t] for t, group in names.items()},
    )


def staged_readings(spark: SparkSession, lake: Lake, days: Days = None) -> DataFrame:
    """The staging model of readings. A view: nothing is written."""
    staging = read(spark, lake, "staging_telemetry")
    return models.stg_telemetry(tables.on_days(staging, days))


def build_marts(
    spark: SparkSession, lake: Lake, as_of: date | None = None, days: Days = None
) -> None:
    """Write the dimension, the fact, daily health and the flat mart.

    Staging and the daily summary are views inside these plans; the marts are tables. With
    ``days`` the flat mart is also refreshed on other days of animals whose profile is not
    the one that the last finished run put there.
    """
    registry = models.stg_registry(read(spark, lake, "staging_registry"))
    tables.overwrite(models.dim_cats(registry, as_of), lake.path("dim_cats"))
    stale = _stale_days(spark, lake, days)

    readings = staged_readings(spark, lake, days)
    with sized_for(readings):
        tables.overwrite_by_day(
            models.fact_readings(readings),
            lake.path("fact_readings"),
            DAY_OF_READING,
            days=days,
            rebalance=False,
            cluster="cat_id",
        )
        tables.overwrite_by_day(
            models.daily_health(models.daily_telemetry(readings)),
            lake.path("daily_health"),
            DAY,
            days=days,
            rebalance=_many(days),
        )
    flat = days if days is None else {*days, *stale}
    health = tables.on_days(read(spark, lake, "daily_health"), flat)
    cats = read(spark, lake, "dim_cats")
    with sized_for(health, cats):
        tables.overwrite_by_day(
            models.bi_flat(health, cats),
            lake.path("bi_flat"),
            DAY,
            days=flat,
            cluster="cat_id",
        )


def _mark(spark: SparkSession, lake: Lake) -> progress.Mark | None:
    return progress.last(spark, lake.path("progress"))


def _stale_days(spark: SparkSession, lake: Lake, days: Days) -> set[date | None]:
    """Days of the flat mart that carry profiles which are others in the dimension now."""
    mark = _mark(spark, lake)
    if days is None or mark is None:
        return set()
    cats = read(spark, lake, "dim_cats")
    altered = progress.changes(spark, lake.path("progress_profiles"), mark, cats).altered
    return progress.days_with(read(spark, lake, "daily_health"), DAY, altered)


def days_to_build(spark: SparkSession, lake: Lake, as_of: date | None = None) -> Days:
    """The days that changed since the last run whose checks passed; None, which means
    all, if there was none. To be asked for after bronze was built."""
    mark = _mark(spark, lake)
    if mark is None:
        return None
    cats = models.dim_cats(models.stg_registry(load_registry(spark, lake.registry)), as_of)
    moved = progress.changes(spark, lake.path("progress_profiles"), mark, cats).moved
    return progress.days_since(spark, lake.path("bronze"), mark, moved)


def newest_batch(spark: SparkSession, lake: Lake) -> int:
    """The number of the last batch that is in bronze, -1 without one."""
    return max(stream.batches(spark, lake.path("bronze")), default=-1)


def commit(spark: SparkSession, lake: Lake, batch: int) -> None:
    """Note that the marts follow bronze up to a batch, and the registry as it is in them."""
    paths = lake.path("progress"), lake.path("progress_profiles")
    progress.commit(spark, *paths, read(spark, lake, "dim_cats"), batch)


def register(spark: SparkSession, lake: Lake) -> None:
    """Name the written tables, and the models that are views, for use in SQL."""
    read_bronze(spark, lake.path("bronze")).createOrReplaceTempView("bronze")
    for name in TABLES[1:]:
        read(spark, lake, name).createOrReplaceTempView(name)
    readings = staged_readings(spark, lake)
    registry = models.stg_registry(read(spark, lake, "staging_registry"))
    readings.createOrReplaceTempView("stg_telemetry")
    registry.createOrReplaceTempView("stg_registry")
    models.daily_telemetry(readings).createOrReplaceTempView("daily_telemetry")
    quarantine(spark, lake).createOrReplaceTempView("quarantine")
    skipped_files(spark, lake).createOrReplaceTempView("skipped_files")
    load_history(spark, lake).createOrReplaceTempView("load_history")


def check(spark: SparkSession, lake: Lake, days: Days = None) -> DataFrame:
    """Failures per check, over the tables as they are now.

    The keys of readings and of daily rows contain the day, so a duplicate is in the
    same day as its original, and the days that were rebuilt can be checked alone.
    """

    def by_day(name: str) -> DataFrame:
        return tables.on_days(read(spark, lake, name), days)

    report = quality.check_report(
        {
            "staging_telemetry": by_day("staging_telemetry"),
            "staging_registry": read(spark, lake, "staging_registry"),
            "stg_telemetry": staged_readings(spark, lake, days),
            "dim_cats": read(spark, lake, "dim_cats"),
            "fact_readings": by_day("fact_readings"),
            "daily_health": by_day("daily_health"),
        }
    )
    # Before duplicates are dropped: unparsed times of one collar become one row.
    bronze = read_bronze(spark, lake.path("bronze"), days)
    warnings = quality.warning_report(
        clean(bronze), by_day("daily_health"), quarantine(spark, lake)
    )
    return report.unionByName(warnings)


def require_checks(spark: SparkSession, lake: Lake, days: Days = None) -> None:
    """Raise if a check fails."""
    with sized_for(read(spark, lake, "staging_telemetry")):
        quality.require_passed(check(spark, lake, days))


def run(
    spark: SparkSession,
    lake: Lake,
    as_of: date | None = None,
    days: Days | str = NEW,
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """Ingest, rebuild, check; return the flat mart. Raises if a check fails.

    Without ``days`` only what changed since the last run whose checks passed is rebuilt:
    everything the first time. ``days`` may also name the days to rebuild, or be None for all.
    A run over named days leaves the others' changes to the next one.
    """
    build_bronze(spark, lake, max_files_per_batch)
    batch = newest_batch(spark, lake)
    part = days_to_build(spark, lake, as_of) if days == NEW else days
    if part is None or part:
        build_silver(spark, lake, part)
    build_staging(spark, lake, part)
    build_marts(spark, lake, as_of, part)
    require_checks(spark, lake, part)
    if days is None or days == NEW:
        commit(spark, lake, batch)
    return read(spark, lake, "bi_flat").select(*models.BI_COLUMNS)
