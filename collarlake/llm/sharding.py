"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns several points of a ring, its virtual nodes; a row belongs to the first
virtual node clockwise of its key's hash. A shard holds at most its quota of rows, and all
quotas together are the number of rows, so every shard ends with exactly its quota and
counts differ by one at most. Rows that a full shard cannot hold continue clockwise to the
next virtual node of a shard with room: they pass a virtual node only if its whole shard is
full. The walk goes by rounds: all rows under way arrive at their next virtual node, each shard
takes in what it has room for, in order of the cells that rows come from, and the others
go on. Each round but the last fills a shard at least, so there are no more than shards.

The ring has a fixed number of cells. All that is computed about the ring as a whole
works on one row per cell or virtual node, a number that does not depend on the data.
Rows are counted per cell, numbered within their cell, and meet the plan of their cell in
a join by cell, for which they are already in place.

Only built-in functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved

CELLS = 1 << 14
VIRTUAL_NODES = 64
# Repeats of one row are dealt on in pieces of this many.
PIECE = 4096


def _ring_cell(*parts: Column | str) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(CELLS)).cast("int")


def ring(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """(cell, shard) of every virtual node; of several in one cell the least hash counts."""
    nodes = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"))
        .select("shard", F.explode(F.sequence(F.lit(0), F.lit(virtual_nodes - 1))).alias("node"))
        .select(
            "shard",
            _ring_cell(F.lit("virtual node"), "shard", "node").alias("cell"),
            F.xxhash64(F.lit("tie"), "shard", "node").alias("tie"),
        )
    )
    return nodes.groupBy("cell").agg(F.min_by("shard", F.struct("tie", "shard")).alias("shard"))


def _next_open(waiting: DataFrame, nodes: DataFrame) -> DataFrame:
    """``waiting`` (cell, lo, rows, at) with the place and shard of the first of ``nodes`` (cell,
    shard) at or after ``at``, around the ring. At most one row per cell on either side."""
    none = F.lit(None).cast("int")
    spots = waiting.select(F.struct("cell", "lo", "rows").alias("who"), "at", none.alias("shard"))
    nobody = F.lit(None).cast(spots.schema["who"].dataType).alias("who")
    # Of a group and a node at one place the group comes first: it meets the node.
    both = spots.unionByName(nodes.select(nobody, F.col("cell").alias("at"), "shard"))
    node = F.when(F.col("shard").isNotNull(), F.struct("at", "shard"))
    everything = Window.partitionBy(F.lit(0))
    onward = everything.orderBy("at", F.col("shard").asc_nulls_first(), "who").rowsBetween(
        0, Window.unboundedFollowing
    )
    met = F.coalesce(F.first(node, ignorenulls=True).over(onward), F.min(node).over(everything))
    found = both.select("who", met.alias("met")).where("who is not null")
    return found.select("who.*", F.col("met.at").alias("at"), F.col("met.shard").alias("shard"))


def plan(counts: DataFrame, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """Which rows of each cell go where: (cell, lo, hi, shard, slot). Rows numbered lo to
    hi - 1 in the cell take the slots from ``slot`` on in the shard.

    ``counts`` has (cell, rows). The result is bounded: a cell's rows are cut where a shard
    becomes full, which happens once for each shard.
    """
    spark = counts.sparkSession
    saved = Saved(spark, "ring")
    zero = F.lit(0).cast("long")
    total = counts.agg(F.coalesce(F.sum("rows"), zero)).first()[0]
    more = F.when(F.col("id") < total % shards, 1).otherwise(0)
    rooms = spark.range(shards).select(
        F.col("id").cast("int").alias("shard"), (more + total // shards).cast("long").alias("room")
    )
    nodes = saved.write(ring(spark, shards, virtual_nodes), "nodes")
    waiting = counts.where("rows > 0").select("cell", zero.alias("lo"), "rows", F.col("cell").alias("at"))
    waiting = saved.write(waiting, "waiting")
    parts = []
    while not waiting.isEmpty():
        # Shards with room, and their virtual nodes.
        rooms = saved.write(rooms.where("room > 0"), "rooms")
        arrived = _next_open(waiting, nodes.join(rooms, "shard").select("cell", "shard"))
        queue = Window.partitionBy("shard").orderBy("cell", "lo").rowsBetween(
            Window.unboundedPreceding, -1
        )
        before = F.coalesce(F.sum("rows").over(queue), zero)
        arrived = arrived.withColumn("before", before).join(rooms, "shard")
        taken = F.least("rows", F.greatest(zero, F.col("room") - F.col("before")))
        arrived = saved.write(arrived.withColumn("taken", taken), "arrived")
        parts.append(
            arrived.where("taken > 0").select(
                "cell", "lo", (F.col("lo") + F.col("taken")).alias("hi"), "shard"
            )
        )
        filled = arrived.groupBy(F.col("shard").alias("of")).agg(F.sum("taken").alias("taken"))
        rooms = rooms.join(filled, F.col("shard") == F.col("of"), "left").select(
            "shard", (F.col("room") - F.coalesce("taken", zero)).alias("room")
        )
        waiting = arrived.where("taken < rows").select(
            "cell",
            (F.col("lo") + F.col("taken")).alias("lo"),
            (F.col("rows") - F.col("taken")).alias("rows"),
            "at",
        )
    if not parts:
        kinds = "cell int, lo long, hi long, shard int, slot long"
        return spark.createDataFrame([], kinds)
    pieces = reduce(DataFrame.unionByName, parts)
    in_shard = (
        Window.partitionBy("shard").orderBy("cell", "lo").rowsBetween(Window.unboundedPreceding, -1)
    )
    slot = F.coalesce(F.sum(F.col("hi") - F.col("lo")).over(in_shard), zero)
    return pieces.withColumn("slot", slot)


def assign(rows: DataFrame, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, numbered from 0 without gaps in each shard.

    ``rows`` should hold what identifies a row and little else: all its columns together
    are the key on the ring, so that rows that share one of them, such as a repeated or
    missing id, do not gather in a place. Repeated rows come back as often as they came.
    They are counted before they are shuffled and dealt out again in pieces, so no task
    meets all repeats of a row. Nulls are values like others. An empty table gives none.
    Columns named shard and slot take part in the key and are then replaced.

    A row added or removed moves others only where a quota changes.
    """
    given = rows.columns
    names = [f"__own_{name}" if name in ("shard", "slot") else name for name in given]
    rows = rows.toDF(*names)
    saved = Saved(rows.sparkSession, "ring")
    keyed = rows.select(*names, _ring_cell(*names).alias("__cell"))
    counts = saved.write(
        keyed.groupBy(F.col("__cell").alias("cell")).agg(F.count(F.lit(1)).alias("rows")), "counts"
    )
    pieces = saved.write(plan(counts, shards, virtual_nodes), "plan")
    pieces = pieces.select(*(F.col(c).alias(f"__{c}") for c in pieces.columns))
    in_cell = (
        Window.partitionBy("__cell")
        .orderBy(F.xxhash64(F.lit("order"), *names), *names)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = (
        keyed.groupBy("__cell", *names)
        .agg(F.count(F.lit(1)).alias("__copies"))
        .withColumn("__at", F.coalesce(F.sum("__copies").over(in_cell), F.lit(0).cast("long")))
    )
    met = (
        numbered.join(pieces, "__cell")
        .withColumn("__from", F.greatest("__at", "__lo"))
        .withColumn("__to", F.least(F.col("__at") + F.col("__copies"), F.col("__hi")))
        .where("__from < __to")
        .withColumn("__slot", F.col("__slot") + F.col("__from") - F.col("__lo"))
        .withColumn("__many", F.col("__to") - F.col("__from"))
    )
    dealt = met.select(
        *names,
        F.col("__shard").alias("shard"),
        "__slot",
        "__many",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("__many") - 1, F.lit(PIECE))).alias("__p"),
    ).repartition(*names, "__p")
    within = F.sequence("__p", F.least(F.col("__p") + PIECE, F.col("__many")) - 1)
    kept = [name for name in given if name not in ("shard", "slot")]
    return dealt.select(*kept, "shard", "__slot", F.explode(within).alias("__i")).select(
        *kept, "shard", (F.col("__slot") + F.col("__i")).alias("slot")
    )
