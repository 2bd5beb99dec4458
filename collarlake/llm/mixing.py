"""Mixing sources to target weights.

A source's tokens are summed, its target gives a repetition rate, and each document is
emitted floor(rate) times, and once more with the probability of the rate's fraction. That
last copy is decided by a hash of the document, so a run again decides alike.

A few large documents can take a source far from its target if each is drawn by itself. So
the hash of the largest ones is compared with the fraction, and that of each class of
smaller ones with a threshold that makes up for the classes before it: the one at which the
words taken come nearest to what is wanted. Over all draws the thresholds' mean is the
fraction too. They are found from sizes added up by ranges of the hash, in two passes, so
the number of rows per source is bounded and no document is moved.

The sources may be many: they are numbered in order by a sort over all tasks, and their
targets are found by passes over the table of sources that return two sums each. The
documents meet the table of sources in a plain join, broadcast by Catalyst only below its
size threshold; otherwise adaptive execution splits a hot source.

Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3.0
WEIGHTS = (1, 2, 3)
CHANCE_BITS = 53
# Sizes of documents, in means of their source, at which classes of smaller ones begin.
CLASSES = (float("inf"), 8.0, 2.0, 0.5)
BIN_BITS = 8  # of the chance, by which sizes are added up in one pass


def word_count(text: Column | str) -> Column:
    """Number of words of a text; none in a missing one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame, saved: Saved) -> DataFrame:
    """``sources`` (source, ...) with ``nth``, counted from 0 by code point, null last.

    The table is sorted by ranges over all tasks and written; each range is numbered on its
    own, behind the rows of the ranges before it.
    """
    ranged = (
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("range", F.spark_partition_id())
    )
    ranged = saved.write(ranged, "sources")
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, "range")
        .withColumn("nth", F.col("start") + F.col("place"))
        .drop("range", "start", "place")
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST
) -> DataFrame:
    """``sizes`` (source, source_size) with target and rate.

    Weights repeat over the sources in order. They share the sum of all sizes; no target is
    above ``most`` times its source's size, and what a source cannot take is shared by
    weight among the others, until none is above. Sources without tokens have target 0.
    """
    spark = sizes.sparkSession
    saved = Saved(spark, "mix")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    table = saved.write(
        numbered(sizes, saved).select(
            "source",
            "source_size",
            F.element_at(cycle, (F.pmod("nth", F.lit(len(weights))) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(most)).alias("most"),
        ),
        "weights",
    )
    total = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:  # each pass takes the sources that are above their limit out of the sharing
        above = F.col("weight") * F.lit(level) >= F.col("most")
        row = table.agg(
            F.sum(F.when(above, F.col("most"))).alias("taken"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("capped"),
        ).first()
        if row.capped == capped or not row.weight:
            break
        capped, level = row.capped, (total - (row.taken or 0.0)) / row.weight
    target = F.least(F.col("weight") * F.lit(level), F.col("most"))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(most)))
    return table.select(
        "source",
        "source_size",
        target.alias("target"),
        F.coalesce(rate, F.lit(0.0)).alias("rate"),
    )


def chance(seed: int, *key: Column | str) -> Column:
    """A number from 0 to 2^53, by a hash of the key."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 64 - CHANCE_BITS)


def _fraction(rate: Column) -> Column:
    """The fraction of a rate on the scale of chances."""
    return ((rate - F.floor(rate)) * F.lit(float(1 << CHANCE_BITS))).cast("long")


def _crossing(sizes: DataFrame, rates: DataFrame, saved: Saved) -> DataFrame:
    """``rates`` with ``threshold``: the documents of a source that are larger than ``above`` and at
    most ``upto``, and whose chance is below it, have as near to ``wanted`` words as can be."""
    low = F.lit(0).cast("long")
    rates = rates.withColumn("low", low)
    for level in (1, 2):
        width = 1 << (CHANCE_BITS - level * BIN_BITS)
        edges = rates.select(F.col("source").alias("of"), "above", "upto", "wanted", "low")
        inside = sizes.join(edges, F.col("source").eqNullSafe(F.col("of")))
        at = F.floor((F.col("chance") - F.col("low")) / F.lit(width)).cast("long")
        inside = inside.where(
            (F.col("size") > F.col("above"))
            & (F.col("size") <= F.col("upto"))
            & at.between(0, (1 << BIN_BITS) - 1)
        )
        bins = inside.groupBy("source", at.alias("at")).agg(
            F.sum("size").alias("words"), F.first("wanted").alias("wanted")
        )
        so_far = F.sum("words").over(Window.partitionBy("source").orderBy("at"))
        bins = bins.withColumn("so_far", so_far)
        of = F.col("source").alias("of")
        if level == 1:
            # The last range that begins below what is wanted, and what is left for it.
            before = F.col("so_far") - F.col("words")
            best = bins.where(before < F.col("wanted")).groupBy(of).agg(
                F.max(F.struct("at", (F.col("wanted") - before).alias("left"))).alias("b")
            )
            rates = rates.join(best, F.col("source").eqNullSafe(F.col("of")), "left")
            rates = rates.withColumn("low", F.coalesce(F.col("b.at") * F.lit(width), low))
            rates = rates.withColumn("wanted", F.coalesce("b.left", "wanted")).drop("of", "b")
            rates = saved.write(rates, "ranges")
        else:
            # The end of a range, or the beginning of all, that comes nearest.
            off = F.abs(F.col("so_far") - F.col("wanted"))
            best = bins.groupBy(of).agg(F.min(F.struct(off.alias("off"), F.col("at") + 1)).alias("b"))
            rates = rates.join(best, F.col("source").eqNullSafe(F.col("of")), "left")
            nearer = F.coalesce(F.col("b.off") < F.abs("wanted"), F.lit(False))
            ends = F.when(nearer, F.col("b.col2") * F.lit(width)).otherwise(low)
            rates = rates.withColumn("threshold", F.col("low") + ends)
    return saved.write(rates.select("source", "threshold"), "crossing")


def thresholds(sizes: DataFrame, rates: DataFrame, saved: Saved) -> DataFrame:
    """``rates`` (source, source_size, rows, target, rate) with the ``mean`` size of a document, and
    for each of CLASSES the chance below which its documents get a last copy, ``below0``, ...

    ``sizes`` has source, size and chance of each document. The largest ones are drawn by the
    fraction; each further class makes up for those before it.
    """
    rates = saved.write(
        rates.withColumn("mean", F.col("source_size") / F.col("rows")).withColumn(
            "below0", _fraction(F.col("rate"))
        ),
        "rates",
    )
    for k, cut in enumerate(CLASSES[1:], 1):
        known = rates.select(F.col("source").alias("of"), "mean", *(f"below{i}" for i in range(k)))
        placed = sizes.join(known, F.col("source").eqNullSafe(F.col("of")))
        size = F.col("size")
        drawn = F.when((size > cut * F.col("mean")) & (F.col("chance") < below(k)), size)
        upto = F.when(size > CLASSES[k + 1] * F.col("mean"), size) if k + 1 < len(CLASSES) else size
        sums = placed.groupBy(F.col("source").alias("of")).agg(
            F.coalesce(F.sum(drawn), F.lit(0)).alias("drawn"), F.coalesce(F.sum(upto), F.lit(0)).alias("all")
        )
        # The fraction of all words down to this class, less those that larger ones give.
        joined = rates.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        wanted = (F.col("rate") - F.floor("rate")) * F.col("all") - F.col("drawn")
        least = CLASSES[k + 1] if k + 1 < len(CLASSES) else 0
        asked = joined.select(
            "source",
            (F.col("mean") * F.lit(float(least))).alias("above"),
            (F.col("mean") * F.lit(float(cut))).alias("upto"),
            F.coalesce(wanted, F.lit(0.0)).alias("wanted"),
        )
        found = _crossing(sizes, saved.write(asked, "asked"), saved)
        found = found.select(F.col("source").alias("of"), F.col("threshold").alias(f"below{k}"))
        rates = rates.join(found, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        rates = saved.write(rates, "rates")
    return rates.drop("rows")


def below(classes: int, prefix: str = "") -> Column:
    """The chance below which a document gets a last copy, by its size's class."""
    found = F.col(f"{prefix}below{classes - 1}")
    for k in range(classes - 2, -1, -1):
        larger = F.col(f"{prefix}size") > CLASSES[k + 1] * F.col(f"{prefix}mean")
        found = F.when(larger, F.col(f"{prefix}below{k}")).otherwise(found)
    return found


def rated(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = 9
) -> DataFrame:
    """``docs`` with __size, __source_size, __target and __copies, how often each is taken.

    Needs doc_id, text and source. A missing text has no words. Documents of a source that
    has no words are taken 0 times. The draw depends on doc_id and text: equal rows share
    it, copies of a text under other ids do not.
    """
    saved = Saved(docs.sparkSession, "mixing")
    draw = chance(seed, F.col("doc_id"), F.crc32(F.col("text")))
    sized = docs.withColumn("__size", word_count("text")).withColumn("__chance", draw)
    sizes = saved.write(
        sized.select("source", F.col("__size").alias("size"), F.col("__chance").alias("chance")), "sizes"
    )
    sums = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    sums = saved.write(sums, "sums")
    shares = targets(sums.select("source", "source_size"), weights, most)
    counts = sums.select(F.col("source").alias("of"), "rows")
    shares = shares.join(counts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rates = saved.write(thresholds(sizes, shares, saved), "thresholds")
    rates = rates.select(*(F.col(c).alias(f"__{c}") for c in rates.columns))
    joined = sized.join(rates, F.col("source").eqNullSafe(F.col("__source")))
    drawn = (F.col("__chance") < below(len(CLASSES), "__")) & (F.col("__source_size") > 0)
    copies = (F.floor("__rate") + F.when(drawn, 1).otherwise(0)).cast("int")
    inner = [f"__below{k}" for k in range(len(CLASSES))]
    return joined.withColumn("__copies", copies).drop(
        "__source", "__rate", "__mean", "__chance", *inner
    )


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: int = 9
) -> DataFrame:
    """``docs``, each row as often as the mix takes it, with unchanged columns."""
    taken = rated(docs, weights, most, seed).where("__copies > 0")
    repeated = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return repeated.select(*docs.columns)
