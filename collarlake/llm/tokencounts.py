"""Token counts with a cache keyed by content and tokenizer version.

A text is known by the SHA-256 of its normalised content, a tokenizer by the SHA-256 of its
file. Counts are stored under both. A run joins the digests of its texts with the stored
ones, encodes each distinct content that is missing once, appends the new counts to the
cache, and joins all documents with it.

Copies of a text are reduced before they are shuffled, one per task. The join of the
documents with the counts carries digests only; adaptive execution splits a hot one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake.llm.tables import importable

# How the file format splits normalised texts; white space is dropped.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Outside of these characters, normalisation and classes are left to the library.
PLAIN = regex.compile(r"[\x00-įı-ɏ]*")
REMEMBERED = 1_000_000
STRETCH = 1 << 22


def normalised(text: Column | str) -> Column:
    """Content that a tokenizer which drops white space counts alike: runs of ASCII white
    space are one space. A null is the empty text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_replace(text, r"[\x09-\x0D\x20]+", " ")


def version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counter:
    """Counts by distinct words: each new word is encoded once and its count remembered, up
    to a bound. Texts with special tokens or unusual characters are encoded whole."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _library(path)
        self.split = regex.compile(SPLIT)
        self.known: dict[str, int] = {}

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        words = [
            self.split.findall(text.lower()) if "<|" not in text and PLAIN.fullmatch(text) else None
            for text in texts
        ]
        met = set(chain.from_iterable(own for own in words if own))
        if len(self.known) + len(met) > REMEMBERED:
            self.known = {}
        new = list(met.difference(self.known))
        self.known.update(zip(new, self._whole(new), strict=True))
        whole = iter(self._whole([t for t, own in zip(texts, words, strict=True) if own is None]))
        look = self.known.__getitem__
        return [next(whole) if own is None else sum(map(look, own)) for own in words]


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            counts, run, size = [], [], 0
            for value in batch.column("content"):
                run.append(value.as_py() or "")
                size += len(run[-1])
                if size > STRETCH:
                    counts += counter.count(run)
                    run, size = [], 0
            counts += counter.count(run)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    return run


def counted(docs: DataFrame, path: str, cache: str, name: str = "n_tokens") -> DataFrame:
    """``docs`` without ``text`` but with its number of tokens, ``name``.

    ``path`` is a tokenizer file of a kind that drops white space and that every worker can
    open; ``cache`` a folder in shared storage that lasts. Two writers at a time may both
    encode a content that is missing; its count is read once all the same. A null text
    counts as empty. Repeated rows come back as often as they came. A column called
    ``name`` is replaced. A run that stops early has stored whole files of counts or none
    of them, and the next run encodes what is missing.
    """
    spark = docs.sparkSession
    importable(spark)
    others = [c for c in docs.columns if c not in ("text", name)]
    digest = F.unhex(F.sha2(normalised("text"), 256)).alias("__digest")
    folder = f"{cache}/version={version(path)}"
    stored = spark.read.schema("digest binary, n_tokens long")
    spark_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    begun = spark_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark_path)
    # Copies are reduced per task first; the contents are then in place for the join.
    missing = (
        docs.select(digest, normalised("text").alias("content"))
        .groupBy(F.col("__digest").alias("digest"))
        .agg(F.first("content").alias("content"))
    )
    if begun:
        missing = missing.join(stored.parquet(folder).select("digest"), "digest", "left_anti")
    missing.mapInArrow(_counting(path), "digest binary, n_tokens long").write.mode(
        "append"
    ).parquet(folder)
    # One count per content, however often it was stored.
    counts = stored.parquet(folder).groupBy(F.col("digest").alias("__digest")).agg(
        F.max("n_tokens").alias("__n")
    )
    keyed = docs.select(*(F.col(f"`{c}`") for c in others), digest)
    joined = keyed.join(counts, "__digest", "left")
    return joined.select(*(F.col(f"`{c}`") for c in others), F.col("__n").alias(name))
