"""A Merkle manifest of a dataset, and versions of it that copy paths.

Rows are leaves. Per group, every three consecutive nodes become the digest of their
concatenated hex digests, level by level, until one is left; the groups' last nodes are
joined likewise into one root.

The tree is kept in aligned blocks of 3^6 consecutive nodes. A block is built by one task;
its root is a leaf of the next layer of blocks, so a group may have any number of rows. The
nodes of a tree never change: a leaf with another digest makes a new version, which copies
the nodes between the leaf and the block's root and shares all others. Above its block the
version goes on with the siblings of the block's ancestors, in the task of the block, so
versions of one tree are made independently of each other.

Leaves are numbered by a range partitioning and the counts of its parts, never by a
window over a whole group.

Nulls in any column have a digest of their own; a null group comes first. Rows of one key
are ordered by their leaves, and equal rows take neighbouring places. An empty table has
an empty manifest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from collarlake.llm.tables import Saved, importable
from collarlake.sizing import sized_for

ARITY = 3
DEPTH = 6

# Columns of a layer of nodes: the group, the place in it, the group's number of nodes.
NODES = "__group string, __pos long, __n long, __node binary"
WAY = "proof binary, shape binary, subroot binary, root binary"


def field(value: Column) -> Column:
    """A value as it is digested: its length in bytes and itself, or ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: Sequence[Column]) -> Column:
    """The digest of a row's values in order, as bytes."""
    return F.unhex(F.sha2(F.concat(F.lit(""), *map(field, values)), 256))


def joined(digests: Sequence[bytes]) -> bytes:
    """The digest of digests, which are concatenated as hex text."""
    return sha256(b"".join(digests).hex().encode()).digest()


class Block:
    """The tree above consecutive nodes, by levels; none of its nodes ever changes. A
    block that is only a part of its layer is built to its full depth."""

    def __init__(self, nodes: list[bytes], part: bool, depth: int) -> None:
        self.levels = [nodes]
        while len(self.levels) <= depth if part else len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(
                [joined(below[i : i + ARITY]) for i in range(0, len(below), ARITY)]
            )

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def way(self, at: int) -> tuple[bytes, bytes]:
        """The siblings on the way from a leaf to the root, left to right in each level, and
        for each level how many of them are left and right of the way."""
        siblings, shape = [], bytearray()
        for level in self.levels[:-1]:
            first = at - at % ARITY
            run = level[first : first + ARITY]
            siblings += run[: at - first] + run[at - first + 1 :]
            shape += bytes((at - first, len(run) - 1 - (at - first)))
            at //= ARITY
        return b"".join(siblings), bytes(shape)

    def version(self, at: int, leaf: bytes) -> list[bytes]:
        """The nodes that a version with another leaf has of its own, the leaf first, its
        root last. All others are this block's."""
        copied = [leaf]
        for level in self.levels[:-1]:
            first = at - at % ARITY
            run = level[first : first + ARITY]
            run[at - first] = copied[-1]
            copied.append(joined(run))
            at //= ARITY
        return copied


def climbed(node: bytes, proof: bytes, shape: bytes) -> bytes:
    """The root above a node, by the siblings on its way."""
    at = 0
    for left, right in zip(shape[::2], shape[1::2], strict=True):
        siblings = [proof[at + 32 * i : at + 32 * i + 32] for i in range(left + right)]
        node = joined([*siblings[:left], node, *siblings[left:]])
        at += 32 * (left + right)
    return node


def _block_of(table: pa.Table, depth: int) -> tuple[pa.Table, Block]:
    """A block's rows in order, and its tree."""
    table = table.sort_by("__pos")
    part = table.column("__n")[0].as_py() > ARITY**depth
    return table, Block(table.column("__node").to_pylist(), part, depth)


def _number(nodes: DataFrame, depth: int) -> Column:
    """The number of a node's block, which is the place of the block's root in the next layer."""
    return F.floor(nodes["__pos"] / F.lit(ARITY**depth)).cast("long").alias("__block")


def _next_layer(nodes: DataFrame, depth: int) -> DataFrame:
    size = ARITY**depth

    def root(table: pa.Table) -> pa.Table:
        table, block = _block_of(table, depth)
        pos, n = table.column("__pos")[0].as_py(), table.column("__n")[0].as_py()
        return pa.table(
            {
                "__group": table.column("__group").slice(0, 1).cast(pa.string()),
                "__pos": pa.array([pos // size], pa.int64()),
                "__n": pa.array([-(-n // size)], pa.int64()),
                "__node": pa.array([block.root], pa.binary()),
            }
        )

    columns = nodes.select("__group", "__pos", "__n", "__node")
    return columns.groupBy("__group", _number(columns, depth)).applyInArrow(root, NODES)


def _ways(
    nodes: DataFrame, above: DataFrame, carried: Sequence[str], kinds: str, depth: int
) -> DataFrame:
    """Rows of a layer with the way from each to the root, from the ways of the layer above.
    ``carried`` columns stay; ``__own``, where it is one of them and not null, is the leaf of
    a version, whose root is ``folded``."""

    def run(own: pa.Table, up: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in out})
        own, block = _block_of(own, depth)
        above = {name: up.column(name)[0].as_py() for name in ("proof", "shape", "subroot", "root")}
        ways = [block.way(at) for at in range(own.num_rows)]
        columns = [own.column(c).combine_chunks().cast(out.field(c).type) for c in carried]
        columns.append(pa.array([proof + above["proof"] for proof, _ in ways], pa.binary()))
        columns.append(pa.array([shape + above["shape"] for _, shape in ways], pa.binary()))
        for name in ("subroot", "root"):
            columns.append(pa.array([above[name]] * own.num_rows, pa.binary()))
        if "__own" in carried:
            leaves = own.column("__own").to_pylist()
            tops = [block.version(at, leaf)[-1] for at, leaf in enumerate(leaves)]
            columns.append(
                pa.array([climbed(x, above["proof"], above["shape"]) for x in tops], pa.binary())
            )
        return pa.table(dict(zip(out.names, columns, strict=True)))

    schema = f"{kinds}, {WAY}" + (", folded binary" if "__own" in carried else "")
    out = to_arrow_schema(StructType.fromDDL(schema))
    grouped = above.groupBy("__group", F.col("__pos").alias("__block"))
    return nodes.groupBy("__group", _number(nodes, depth)).cogroup(grouped).applyInArrow(run, schema)


def numbered(rows: DataFrame, order: Sequence[str], saved: Saved) -> DataFrame:
    """``rows`` with each row's place in its ``__group`` by ``order`` (nulls first), from 0, and
    the group's number of rows: columns ``__pos`` and ``__n``.

    The rows are dealt by ranges of group and order, also those of one group, and get
    their place in their part; the counts of the parts, a row for each group and part,
    give where each part begins.
    """
    tie = F.monotonically_increasing_id()
    keys = [F.col(c).asc_nulls_first() for c in ("__group", *order)]
    with sized_for(rows):
        dealt = rows.withColumn("__tie", tie).repartitionByRange(*keys, F.col("__tie"))
        dealt = dealt.sortWithinPartitions(*keys, F.col("__tie")).drop("__tie")
        dealt = saved.write(dealt.withColumn("__at", F.monotonically_increasing_id()), "dealt")
        # A part's rows share the upper bits of their number.
        dealt = dealt.withColumn("__part", F.shiftright("__at", 33))
        parts = dealt.groupBy("__group", "__part").agg(
            F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")
        )
        own = Window.partitionBy("__group")
        before = own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(
            "__group",
            "__part",
            (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
            F.sum("__rows").over(own).alias("__n"),
        )
        placed = dealt.join(parts, ["__group", "__part"])
        placed = placed.withColumn("__pos", F.col("__at") + F.col("__shift"))
        return saved.write(placed.drop("__at", "__part", "__shift"), "numbered")


def _layers(leaves: DataFrame, saved: Saved, depth: int) -> list[DataFrame]:
    """The leaves and the layers of block roots above them, until each group has one node."""
    layers = [leaves]
    most = leaves.agg(F.max("__n")).first()[0] or 0
    while most > 1:
        layers.append(saved.write(_next_layer(layers[-1], depth), "layer"))
        most = -(-most // ARITY**depth)
    return layers


def manifest(
    rows: DataFrame,
    group: str,
    order: str,
    fields: Sequence[str],
    altered: Mapping[str, Column] | None = None,
    depth: int = DEPTH,
) -> DataFrame:
    """The manifest of ``rows``: for each its ``order`` column and, as bytes, its ``leaf``, the
    ``subroot`` of its group, the ``root``, the ``proof`` (the digests of its siblings up to
    the root) with its ``shape`` (numbers of left and right siblings, by level), and the
    ``folded`` root of the version that has this row's altered leaf.

    ``fields`` are digested in their order. ``altered`` gives other values for some of them; a
    row whose values stay the same makes the version that equals the tree. No other column
    is read, and their names do not matter. A block has 3^``depth`` nodes.
    """
    spark = rows.sparkSession
    importable(spark)
    saved = Saved(spark, "manifest")
    own = [F.col(f"`{c}`") for c in fields]
    other = [(altered or {}).get(c, F.col(f"`{c}`")) for c in fields]
    key = F.col(f"`{group}`").cast("string")
    # A null group sorts before the empty text, and every other as its bytes do.
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("+"), key), F.lit("")).alias("__group"),
        F.col(f"`{order}`").alias("__key"),
        digest(own).alias("__node"),
        digest(other).alias("__own"),
    )
    leaves = numbered(saved.write(leaves, "leaves"), ("__key", "__node"), saved)
    layers = _layers(leaves, saved, depth)
    tops = layers[-1].select(
        F.lit("").alias("__group"), F.col("__group").alias("__name"), F.col("__node")
    )
    tops = numbered(tops, ("__name",), saved)
    upper = _layers(tops, saved, depth)

    nothing = F.lit(b"").cast("binary")
    ways = upper[-1].select(
        "__group",
        "__pos",
        *(["__name", "__node"] if len(upper) == 1 else []),
        nothing.alias("proof"),
        nothing.alias("shape"),
        nothing.alias("subroot"),
        F.col("__node").alias("root"),
    )
    for layer in reversed(upper[:-1]):
        named = layer is upper[0]
        kinds = "__group string, __pos long" + (", __name string, __node binary" if named else "")
        carried = ["__group", "__pos"] + (["__name", "__node"] if named else [])
        ways = saved.write(_ways(layer, ways, carried, kinds, depth), "upper-ways")

    ways = ways.select(
        F.col("__name").alias("__group"),
        F.lit(0).cast("long").alias("__pos"),
        "proof",
        "shape",
        F.col("__node").alias("subroot"),
        "root",
    )
    for layer in reversed(layers[1:-1]):
        ways = _ways(layer, ways, ["__group", "__pos"], "__group string, __pos long", depth)
        ways = saved.write(ways, "ways")
    key_type = rows.schema[order].dataType.simpleString()
    done = _ways(
        layers[0],
        ways,
        ["__key", "__node", "__own"],
        f"__key {key_type}, __node binary, __own binary",
        depth,
    )
    return done.select(
        F.col("__key").alias(order),
        F.col("__node").alias("leaf"),
        "subroot",
        "root",
        "proof",
        "shape",
        "folded",
    )
