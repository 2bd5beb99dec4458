"""The registry of animals: a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from collarlake.functions.cleaning import null_tokens
from collarlake.schemas import STAGING_REGISTRY, all_text


def read_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """The file as text columns, named by its header."""
    return spark.read.option("header", True).csv(path)


def read_registry_text(spark: SparkSession, path: str) -> DataFrame:
    """The file as text columns, by position: the header is skipped.

    Missing fields at the end of a line are NULL, extra fields are ignored, and the
    tokens for NULL become NULL.
    """
    raw = (
        spark.read.schema(all_text(STAGING_REGISTRY))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return raw.select(*(null_tokens(F.col(name)).alias(name) for name in raw.columns))


def _typed_or_abort(field: StructField) -> Column:
    """The text as the field's type. A text that does not fit stops the whole load."""
    text = F.col(field.name)
    if isinstance(field.dataType, StringType):
        typed, bad = text, F.length(text) > field.metadata["max_length"]
    else:
        typed = text.try_cast(field.dataType)
        bad = text.isNotNull() & typed.isNull()
    message = F.concat(F.lit(f"registry load: bad {field.name}: "), text)
    return F.when(bad, F.raise_error(message)).otherwise(typed).cast(field.dataType)


def type_registry(text: DataFrame, schema: StructType = STAGING_REGISTRY) -> DataFrame:
    return text.select(*(_typed_or_abort(field).alias(field.name) for field in schema))


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """The typed staging registry. Any value that does not fit its column aborts the job."""
    return type_registry(read_registry_text(spark, path))
