"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from collarlake import constants as k


def surrogate_key(df: DataFrame, *names: str) -> Column:
    """MD5 of the columns' texts, joined by ``-``, with a token in place of NULL."""
    return F.md5(F.concat_ws(k.KEY_SEPARATOR, *(_key_text(df, name) for name in names)))


def _key_text(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)):
        text = F.date_format(column, k.KEY_TIME_PATTERN)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(k.KEY_NULL_TOKEN))
