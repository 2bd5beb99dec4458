"""Removal of passages of lines that occurred before.

Every three consecutive lines of a document are a window. A window whose hash occurs
earlier in the corpus, in order of doc_id and position, is a repeat; the lines that
repeats cover, merged over overlapping windows, are removed. First occurrences stay.
Single lines and pairs that repeat stay as well: a repeat needs a window.

A first pass counts windows by hash, with a partial step, so a window of very many
documents sends one row per task. The hashes that occur more than once are written; the
second pass joins the windows with them to find all but the first occurrence. That join
is plain, so Catalyst broadcasts a small list and adaptive execution splits a hot hash.
Texts are shuffled only to meet the lines to remove, and not where those are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved

LINES = 3


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(row, at, hi, lo): a document's key, the number of a window's first line, and two
    independent 64-bit hashes of its lines. Windows of blank lines only are left out."""
    split = docs.select(_row().alias("row"), F.split("text", "\n", -1).alias("lines"))
    starts = F.sequence(F.lit(0), F.size("lines") - lines)

    def window(at: Column) -> Column:
        parts = F.slice("lines", at + 1, lines)
        blank = F.trim(F.array_join(parts, "")) == ""
        return F.struct(
            at.alias("at"),
            F.xxhash64(parts).alias("hi"),
            F.xxhash64(F.lit("second"), parts).alias("lo"),
            blank.alias("blank"),
        )

    spread = split.where(F.size("lines") >= lines).select(
        "row", F.explode(F.transform(starts, window)).alias("w")
    )
    return spread.where(~F.col("w.blank")).select("row", "w.at", "w.hi", "w.lo")


def _row() -> Column:
    """What a document is known by: rows that agree in doc_id and text are one document.
    Sorts by doc_id, null last."""
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").alias("doc_id"),
        F.xxhash64("text").alias("text"),
    )


def repeats(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """(row, starts): per document the first lines of its windows that occurred before."""
    saved = Saved(docs.sparkSession, "lines")
    found = windows(docs, lines)
    firsts = saved.write(
        found.groupBy("hi", "lo")
        .agg(F.min(F.struct("row", "at")).alias("first"), F.max(F.struct("row", "at")).alias("last"))
        .where("first < last")
        .select("hi", "lo", "first"),
        "repeated",
    )
    later = found.join(firsts, ["hi", "lo"]).where(F.struct("row", "at") > F.col("first"))
    return later.groupBy("row").agg(F.collect_set("at").alias("starts"))


def dedup_lines(docs: DataFrame, lines: int = LINES, count: str | None = None) -> DataFrame:
    """``docs`` with repeated passages removed from ``text``; all other columns unchanged.
    ``count`` names a further column, the number of lines removed; it replaces one of that name.

    Needs doc_id and text. A document with fewer lines than a window, and one whose text is
    null or empty, is unchanged. One whose lines are all repeats keeps an empty text. Rows
    with the same doc_id and text count as one document, and stay alike. Lines end at
    newlines only; a carriage return is part of its line.
    """
    drop = repeats(docs, lines).select(F.col("row").alias("__row"), "starts")
    drop = drop.withColumnRenamed("starts", "__starts")
    joined = docs.withColumn("__key", _row()).join(drop, F.col("__key") == F.col("__row"), "left")
    offsets = F.sequence(F.lit(0), F.lit(lines - 1))
    covered = F.array_distinct(
        F.flatten(F.transform("__starts", lambda at: F.transform(offsets, lambda o: at + o)))
    )
    split = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), covered)
    text = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    text = F.when(F.col("__starts").isNull(), F.col("text")).otherwise(text).alias("text")
    out = [text if name == "text" else F.col(f"`{name}`") for name in docs.columns if name != count]
    if count:
        out.append(F.coalesce(F.size(covered), F.lit(0)).cast("long").alias(count))
    return joined.select(*out)
