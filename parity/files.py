"""Sources, sinks, loads, streams and the whole chain over files.

Each query writes the given tables to a new shared folder in the format under test,
and reads them back through the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collarlake.functions.cleaning import parse_reading_time
from collarlake.plans import lake
from collarlake.schemas import RAW_TELEMETRY
from collarlake.sources import registry, tables, telemetry
from collarlake.streaming import bronze
from collarlake.workspace import scratch_dir
from parity import adapter
from parity.catalog import query
from parity.relational import SILVER

TELEMETRY = "select * exclude (ingested_at, source_file) from raw"
REGISTRY_TEXT = "select columns(*)::string from registry"


def write_json(readings: DataFrame, path: str) -> None:
    """Raw collar files, added to those already in the landing folder."""
    readings.select(*RAW_TELEMETRY.names).write.mode("append").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Registry files with a header, added to those already there; blanks are kept."""
    (
        rows.write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _ingest_raw(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    write_json(adapter.raw(spark, sf_dir), f"{root}/landing")
    bronze.ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    return telemetry.read_bronze(spark, f"{root}/bronze")


@query("src_stream_json", TELEMETRY)
def src_stream_json(spark, sf_dir):
    rows = _ingest_raw(spark, sf_dir, scratch_dir(spark, "stream-json"))
    return rows.select(*RAW_TELEMETRY.names)


@query(
    "ingest_audit_cols",
    """select collar_id, reading_time, count(*) as n_rows, true as has_time, true as has_file
       from raw group by all""",
)
def ingest_audit_cols(spark, sf_dir):
    rows = _ingest_raw(spark, sf_dir, scratch_dir(spark, "ingest-audit"))
    return rows.groupBy("collar_id", "reading_time").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("ingested_at").isNotNull()).alias("has_time"),
        F.bool_and(F.col("source_file").endswith(".json")).alias("has_file"),
    )


def _two_waves(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Files arrive in two waves; ingest runs after each, and once more without new files."""
    raw = adapter.raw(spark, sf_dir)
    asleep = F.coalesce(F.col("activity_level") == "sleep", F.lit(False))
    for wave in (raw.filter(asleep), raw.filter(~asleep), None):
        if wave is not None:
            write_json(wave, f"{root}/landing")
        bronze.ingest(
            spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", max_files_per_batch=64
        )
    return telemetry.read_bronze(spark, f"{root}/bronze")


@query("sink_stream_append", TELEMETRY)
def sink_stream_append(spark, sf_dir):
    rows = _two_waves(spark, sf_dir, scratch_dir(spark, "stream-append"))
    return rows.select(*RAW_TELEMETRY.names)


@query("sink_stream_compact", TELEMETRY)
def sink_stream_compact(spark, sf_dir):
    """Bronze after the folders of its batches were joined, day by day."""
    root = scratch_dir(spark, "stream-compact")
    _two_waves(spark, sf_dir, root)
    bronze.compact(spark, f"{root}/bronze")
    return telemetry.read_bronze(spark, f"{root}/bronze").select(*RAW_TELEMETRY.names)


@query(
    "stream_incremental_files",
    """select coalesce(activity_level = 'sleep', false) as first_wave, count(*) as n_rows
       from raw group by all""",
)
def stream_incremental_files(spark, sf_dir):
    rows = _two_waves(spark, sf_dir, scratch_dir(spark, "stream-waves"))
    wave = F.coalesce(F.col("activity_level") == "sleep", F.lit(False))
    return rows.groupBy(wave.alias("first_wave")).agg(F.count(F.lit(1)).alias("n_rows"))


MISTYPED = "coalesce(activity_level is null and battery_level_pct < 0, false)"
BROKEN = "coalesce(activity_level is null and battery_level_pct > 100, false)"
DAMAGED = f"(select *, {MISTYPED} as mistyped, {BROKEN} as broken from raw)"


@query(
    "src_stream_quarantine",
    f"""select 'bronze' as place, case when not broken then collar_id end as collar_id,
               case when not broken then reading_time end as reading_time,
               case when not broken and not mistyped then steps_count end as steps_count,
               null as reason, null as bad_columns
        from {DAMAGED}
        union all
        select 'quarantine', collar_id, reading_time, null,
               case when broken then 'broken' else 'mistyped' end,
               case when mistyped then 'steps_count' end
        from {DAMAGED} where broken or mistyped""",
)
def src_stream_quarantine(spark, sf_dir):
    """Lines cut off at the end, and lines with a step count that is no number. Bronze has a row
    for each line; quarantine has the damaged ones with their text and what is wrong."""
    root = scratch_dir(spark, "stream-quarantine")
    raw = adapter.raw(spark, sf_dir)
    line = F.to_json(F.struct(*RAW_TELEMETRY.names))
    mistyped = F.regexp_replace(line, r'"steps_count":-?\d+', '"steps_count":"many"')
    cut = F.expr("substring(line, 1, length(line) - 1)")
    lines = raw.withColumn("line", F.when(F.expr(MISTYPED), mistyped).otherwise(line))
    lines.select(F.when(F.expr(BROKEN), cut).otherwise(F.col("line"))).write.text(f"{root}/landing")
    bronze.ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    nothing = F.lit(None).cast("string")
    good = telemetry.read_bronze(spark, f"{root}/bronze").select(
        F.lit("bronze").alias("place"),
        "collar_id",
        "reading_time",
        "steps_count",
        nothing.alias("reason"),
        nothing.alias("bad_columns"),
    )

    def from_line(name: str):
        return F.nullif(F.regexp_extract("line", rf'"{name}":"([^"]*)"', 1), F.lit(""))

    kept = bronze.read_quarantine(spark, f"{root}/bronze").select(
        F.lit("quarantine"),
        from_line("collar_id"),
        from_line("reading_time"),
        F.lit(None).cast("int"),
        "reason",
        F.array_join("bad_columns", ","),
    )
    return good.union(kept)


@query("src_bronze", "select * from raw")
def src_bronze(spark, sf_dir):
    path = scratch_dir(spark, "bronze")
    tables.overwrite(adapter.raw(spark, sf_dir), path)
    return telemetry.read_bronze(spark, path)


def _registry_files(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_dir(spark, label)
    write_csv(adapter.registry_text(spark, sf_dir), path)
    return path


@query("src_registry_csv", REGISTRY_TEXT)
def src_registry_csv(spark, sf_dir):
    return registry.read_registry_csv(spark, _registry_files(spark, sf_dir, "registry-text"))


@query("load_csv_stage", "select * from registry")
def load_csv_stage(spark, sf_dir):
    return registry.load_registry(spark, _registry_files(spark, sf_dir, "registry-load"))


@query("csv_null_tokens", "select * from registry")
def csv_null_tokens(spark, sf_dir):
    """NULLs are written as one of the tokens, by the kind of the row."""
    token = F.when(F.col("gender") == "MALE", "NULL").when(F.col("breed").isNull(), "null")
    text = adapter.registry_text(spark, sf_dir)
    path = scratch_dir(spark, "registry-tokens")
    write_csv(text.select(*(F.coalesce(F.col(n), token).alias(n) for n in text.columns)), path)
    return registry.load_registry(spark, path)


@query(
    "csv_column_mismatch",
    """select * replace (case when gender = 'MALE' then owner_id end as owner_id,
                         case when gender = 'MALE' then registered_at end as registered_at)
       from registry""",
)
def csv_column_mismatch(spark, sf_dir):
    """Files with the last two columns missing, and files with a column too many."""
    text = adapter.registry_text(spark, sf_dir)
    path = scratch_dir(spark, "registry-ragged")
    male = F.col("gender") == "MALE"
    write_csv(text.filter(~male).drop("owner_id", "registered_at"), path)
    write_csv(text.filter(male).withColumn("note", F.lit("extra")), path)
    return registry.load_registry(spark, path)


@query("sink_silver_overwrite", SILVER)
def sink_silver_overwrite(spark, sf_dir):
    """Silver replaces a table of another schema."""
    path = scratch_dir(spark, "silver")
    tables.overwrite(adapter.registry_typed(spark, sf_dir), path)
    silver = adapter.silver_table(spark, sf_dir)
    tables.overwrite_by_day(silver, path, "cast(parsed_reading_time as date)")
    return tables.read(spark, path).select(*silver.columns)


OLD_DAYS = "coalesce(cast(parsed_reading_time as date) < date '2024-01-16', false)"


@query(
    "sink_silver_evolved",
    f"""select * replace (case when not {OLD_DAYS} then weight_lbs end as weight_lbs,
                         cast(steps_count as bigint) as steps_count)
        from silver""",
)
def sink_silver_evolved(spark, sf_dir):
    """Days written before the registry had weights, and before step counts were long."""
    path = scratch_dir(spark, "silver-evolved")
    silver = adapter.silver_table(spark, sf_dir)
    old = F.expr(OLD_DAYS)
    day = "cast(parsed_reading_time as date)"
    tables.overwrite_by_day(silver.filter(old).drop("weight_lbs"), path, day)
    wide = silver.filter(~old).withColumn("steps_count", F.col("steps_count").cast("long"))
    days = [r[0] for r in wide.select(F.expr(day).alias("d")).distinct().collect()]
    tables.overwrite_by_day(wide, path, day, days=days)
    return tables.read_evolved(spark, path).select(*silver.columns)


BAD_STEPS = "(activity_level is null and battery_level_pct < 0)"


def _damaged_silver(spark: SparkSession, sf_dir: str) -> str:
    """Silver files whose step count is text, and not a number in some rows."""
    steps = F.when(F.expr(BAD_STEPS), "many").otherwise(F.col("steps_count").cast("string"))
    path = scratch_dir(spark, "silver-damaged")
    tables.overwrite(adapter.silver_table(spark, sf_dir).withColumn("steps_count", steps), path)
    return path


@query(
    "load_parquet_stage",
    f"""select collar_id, cat_id, parsed_reading_time as reading_time, heart_rate_bpm,
               activity_level, steps_count, purr_frequency_hz, ambient_temp_c,
               battery_level_pct from silver where not {BAD_STEPS}""",
)
def load_parquet_stage(spark, sf_dir):
    load = telemetry.load_telemetry(spark, _damaged_silver(spark, sf_dir))
    return load.loaded.drop("ingested_at", "source_file")


@query(
    "load_parquet_rejected",
    f"""select collar_id, strftime(parsed_reading_time, '%Y-%m-%d %H:%M:%S') as reading_time,
               'many' as steps_count, 'steps_count' as bad_columns
        from silver where {BAD_STEPS}""",
)
def load_parquet_rejected(spark, sf_dir):
    load = telemetry.load_telemetry(spark, _damaged_silver(spark, sf_dir))
    return load.rejected.select(
        "collar_id",
        "reading_time",
        "steps_count",
        F.concat_ws(",", "bad_columns").alias("bad_columns"),
    )


def _silver_by_day(spark: SparkSession, sf_dir: str, place: lake.Lake) -> DataFrame:
    silver = adapter.silver_table(spark, sf_dir)
    tables.overwrite_by_day(silver, place.path("silver"), "cast(parsed_reading_time as date)")
    write_csv(adapter.registry_text(spark, sf_dir), place.registry)
    return silver


def _place(spark: SparkSession, label: str) -> lake.Lake:
    root = scratch_dir(spark, label)
    return lake.Lake(root, f"{root}/landing", f"{root}/registry")


STAGED = """select collar_id, cat_id, parsed_reading_time as reading_time, heart_rate_bpm,
                   activity_level, steps_count, purr_frequency_hz, ambient_temp_c,
                   battery_level_pct from silver"""


def _staged(spark: SparkSession, place: lake.Lake) -> DataFrame:
    rows = lake.read(spark, place, "staging_telemetry")
    return rows.drop("ingested_at", "source_file", lake.DAY)


@query(
    "load_skipped_files",
    f"""select *, null as skipped from ({STAGED})
        union all
        select null, null, cast(min(parsed_reading_time) as date), null, null, null, null, null,
               null, 'no mark at its beginning' from silver""",
)
def load_skipped_files(spark, sf_dir):
    """A day's folder also has a file of readings that is no Parquet file. It is left out and
    named, here with the file's day as the time; all other files are loaded."""
    place = _place(spark, "load-skipped")
    silver = _silver_by_day(spark, sf_dir, place)
    first = silver.agg(F.min("parsed_reading_time").cast("date")).first()[0]
    day = silver.filter(F.col("parsed_reading_time").cast("date") == F.lit(first))
    bad = day.select(F.to_json(F.struct("collar_id", "cat_id"))).coalesce(1)
    bad.write.mode("append").text(tables.day_folder(place.path("silver"), first))
    lake.build_staging(spark, place)
    skipped = lake.skipped_files(spark, place).select(
        F.col(lake.DAY).cast("timestamp").alias("reading_time"), "skipped"
    )
    return _staged(spark, place).unionByName(skipped, allowMissingColumns=True)


CHANGED_DAY = "(select max(cast(parsed_reading_time as date)) from silver)"


@query(
    "load_once",
    f"""select load_id, table_name,
               case when table_name = 'staging_registry'
                    then case when load_id = 1 then (select count(*) from registry) else 0 end
                    when load_id = 1 then (select count(*) from silver)
                    when load_id = 2 then 0
                    else (select count(*) from silver
                          where cast(parsed_reading_time as date) = {CHANGED_DAY}
                          and steps_count > 0) end as rows_loaded,
               (select count(*) from silver
                where load_id < 3 or steps_count > 0
                or cast(parsed_reading_time as date) is distinct from {CHANGED_DAY}) as staged_rows
        from (select unnest([1, 2, 3]) as load_id),
             (select unnest(['staging_telemetry', 'staging_registry']) as table_name)""",
)
def load_once(spark, sf_dir):
    """Three loads: of everything, of nothing new, and of one day whose files were replaced. What
    each loaded, by the history, and the staged rows after it."""
    place = _place(spark, "load-once")
    silver = _silver_by_day(spark, sf_dir, place)
    last = silver.agg(F.max("parsed_reading_time").cast("date")).first()[0]
    staged = []
    for load in (1, 2, 3):
        if load == 3:
            day = silver.filter(F.col("parsed_reading_time").cast("date") == F.lit(last))
            tables.overwrite_by_day(
                day.filter("steps_count > 0"),
                place.path("silver"),
                "cast(parsed_reading_time as date)",
                days=[last],
            )
        lake.build_staging(spark, place)
        staged.append((load, _staged(spark, place).count()))
    after = spark.createDataFrame(staged, "load_id long, staged_rows long")
    history = lake.load_history(spark, place).join(after, "load_id")
    return history.select("load_id", "table_name", "rows_loaded", "staged_rows")


@query(
    "load_audit_cols",
    "select collar_id, parsed_reading_time as reading_time, true as new_time, true as new_file from silver",
)
def load_audit_cols(spark, sf_dir):
    """Load time and file replace those of bronze."""
    path = scratch_dir(spark, "load-audit")
    tables.overwrite(adapter.silver_table(spark, sf_dir), path)
    loaded = telemetry.load_telemetry(spark, path).loaded
    return loaded.select(
        "collar_id",
        "reading_time",
        (F.col("ingested_at") > F.lit(adapter.AS_OF)).alias("new_time"),
        F.col("source_file").endswith(".parquet").alias("new_file"),
    )


@query("staging_tables", "select * from registry")
def staging_tables(spark, sf_dir):
    path = scratch_dir(spark, "staging-registry")
    tables.overwrite(registry.type_registry(adapter.registry_text(spark, sf_dir)), path)
    return tables.read(spark, path)


@query(
    "load_audit",
    """select 'staging_telemetry' as table_name, count(*) as row_count, true as dated from silver
       union all select 'staging_registry', count(*), true from registry""",
)
def load_audit(spark, sf_dir):
    root = scratch_dir(spark, "audit")
    paths = {name: f"{root}/{name}" for name in ("staging_telemetry", "staging_registry")}
    tables.overwrite(adapter.staging(spark, sf_dir), paths["staging_telemetry"])
    tables.overwrite(adapter.registry_typed(spark, sf_dir), paths["staging_registry"])
    audit = tables.load_audit(spark, paths)
    return audit.select("table_name", "row_count", F.col("last_altered").isNotNull().alias("dated"))


@query(
    "filter_schema_eq",
    """select 'staging_registry' as table_name, count(*) as row_count from registry
       union all select 'cat_names', count(distinct name) from registry""",
)
def filter_schema_eq(spark, sf_dir):
    """The audit of one schema's tables; those of other schemas are left out."""
    root = scratch_dir(spark, "audit-schema")
    cats = adapter.registry_typed(spark, sf_dir)
    written = {
        "raw.registry": adapter.registry_text(spark, sf_dir),
        "staging.staging_registry": cats,
        "staging.cat_names": cats.select("name").distinct(),
    }
    paths = {name: f"{root}/{name}" for name in written}
    for name, df in written.items():
        tables.overwrite(df, paths[name])
    return tables.load_audit(spark, paths, "staging").select("table_name", "row_count")


@query("model_materialize", "select * from fact")
def model_materialize(spark, sf_dir):
    """The fact as a table: a folder per day."""
    path = scratch_dir(spark, "fact")
    fact = adapter.fact(spark, sf_dir)
    tables.overwrite_by_day(fact, path, lake.DAY_OF_READING)
    return tables.read(spark, path).select(*fact.columns)


@query("scan_bi_mart", "select * from bi")
def scan_bi_mart(spark, sf_dir):
    path = scratch_dir(spark, "bi")
    mart = adapter.bi(spark, sf_dir)
    tables.overwrite_by_day(mart, path, lake.DAY)
    return tables.read(spark, path).select(*mart.columns)


@query("lake_build", "select * from bi")
def lake_build(spark, sf_dir):
    """The whole chain over files. The readings arrive in two waves such that each key's
    latest one comes in the second, so that "latest wins" is decided by the chain; then
    those once more. All checks must pass on the tables that result."""
    place = _place(spark, "lake")
    write_csv(adapter.registry_text(spark, sf_dir), place.registry)
    latest = _earlier_ingested(spark, sf_dir, place)
    for _ in range(2):
        write_json(latest, place.landing)
        lake.build_bronze(spark, place)
    return lake.run(spark, place, adapter.AS_OF)


def _earlier_ingested(spark: SparkSession, sf_dir: str, place: lake.Lake) -> DataFrame:
    """Ingest all readings but the latest one of each key, and return those.

    One shuffle ranks the readings; they are kept, since callers write them in several parts.
    """
    raw = adapter.raw(spark, sf_dir)
    # What the chain calls one reading: times that cannot be parsed are alike.
    keyed = raw.withColumn("time", parse_reading_time(F.col("reading_time")))
    # The order of the chain's "latest wins": ties are settled by all other columns.
    order = dict.fromkeys(("ingested_at", "source_file", *raw.columns))
    reading = Window.partitionBy("collar_id", "time").orderBy(*(F.col(n).desc() for n in order))
    ranked = keyed.withColumn("latest", F.row_number().over(reading) == 1).drop("time")
    path = scratch_dir(spark, "ranked-readings")
    tables.overwrite(ranked, path)
    kept = tables.read(spark, path, ranked.schema)
    write_json(kept.filter(~F.col("latest")), place.landing)
    lake.build_bronze(spark, place)
    return kept.filter("latest").drop("latest")


@query("lake_changes", "select * from bi")
def lake_changes(spark, sf_dir):
    """The chain over files that change between runs: the first registry lacks some animals
    and has other weights, and half of the latest readings come late. The second run is not
    told any day; it must find what changed, and end where a full build does."""
    place = _place(spark, "lake-changes")
    latest = _earlier_ingested(spark, sf_dir, place)
    late = F.coalesce(F.col("activity_level") == "sleep", F.lit(False))
    write_json(latest.filter(~late), place.landing)
    cats = adapter.registry_text(spark, sf_dir)
    gone = F.coalesce(F.col("weight_lbs").cast("double") > 18, F.lit(False))
    other = F.when(F.col("gender") == "MALE", "5.5").otherwise(F.col("weight_lbs"))
    first = lake.Lake(place.root, place.landing, f"{place.root}/registry-before")
    write_csv(cats.filter(~gone).withColumn("weight_lbs", other), first.registry)
    lake.run(spark, first, adapter.AS_OF)
    write_json(latest.filter(late), place.landing)
    write_csv(cats, place.registry)
    return lake.run(spark, place, adapter.AS_OF)
