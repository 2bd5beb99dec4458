"""From raw documents to token ids: quality, line dedup, near-dedup, mixing, encoding.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir), works on all that
the stage before it kept, and returns a table that is written and read again as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collarlake.llm import bpe, linededup, mixing, neardup, quality
from collarlake.llm.queries import bucket, tokenizer
from collarlake.llm.tables import Saved, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_QUALITY = 0.5
TOKENIZER = "byte_bpe_50k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores LEAST_QUALITY or more.

    It learns from the features of all documents and the labels outside the held-out
    quarter, as ``op5_quality`` does.
    """
    saved = Saved(spark, "quality")
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality")
    x = saved.write(quality.featurised(docs), "features")
    model = quality.fit(x, quality.trusted(labels, bucket(4) != 2), saved)
    saved.drop([x])
    return quality.keep(docs, model, LEAST_QUALITY)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of three or more lines that occurred before, and without
    documents of which that leaves nothing. n_chars is that of the text that is left."""
    columns = docs.columns
    left = linededup.dedup_lines(docs, count="__removed")
    left = left.where((F.col("__removed") == 0) | (F.trim(F.col("text"), F.lit("\n ")) != ""))
    n_chars = F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near duplicates."""
    return neardup.dedup(docs)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, packed, with their number, and whether decoding them gives
    the text back."""
    path = tokenizer(TOKENIZER)
    ids = bpe.encode(docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)), path, keep_text=False)
    back = bpe.decode(ids, path)
    return back.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", distinct_lines),
    ("near_dedup", distinct_documents),
    ("mixing", target_mix),
    ("bpe", encoded),
]

#: A learnt classifier has no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the given documents, each but the last written in between."""
    saved = Saved(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    kept = None
    for name, stage in STAGES[:-1]:
        done = saved.write(stage(spark, docs, sf_dir), name)
        if kept is not None:
            saved.drop([kept])
        docs = kept = done
    return STAGES[-1][1](spark, docs, sf_dir)
