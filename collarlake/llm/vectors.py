"""Vectors in cells of space, shards of cells, and queries sent to the cells that matter.

Pivots are fitted on a bounded sample, and each vector belongs to the cell of its nearest
pivot. Cells that hold more than a shard's worth of rows, such as those of many equal
vectors, are split into parts by hash, so an index is built over a bounded number of rows
however the vectors lie. Queries go to chosen cells, to all of their parts. An index and
the queries that it answers are brought together by a sort: it comes first and is read
once, the queries follow in batches. Where many queries meet one index, they are spread
over several copies of it.

Vectors without any structure need most of the cells; then the work is that of comparing
every query with every shard.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved, importable

SAMPLE = 1 << 20  # components of all sampled vectors of one length
PER_PIVOT = 16  # sampled vectors that a pivot stands for, at least
LENGTHS = 16  # lengths of vectors that get pivots, the most frequent; others are one cell each
ROUNDS = 8
ASKED = 256  # sampled vectors that are asked to find how many cells a query needs
WITHIN = 0.995  # share of their neighbours that lie in those cells
QUERIES = 4096  # queries that a copy of an index answers
TASKS = 20_000
SLACK = 1e-6
LOTS = 1 << 30

KEYS = ["dim", "cell", "part", "salt"]


def usable(vectors: DataFrame, nonzero: bool = False) -> DataFrame:
    """(vec_id, x, dim): rows with an id and a vector of finite components, as doubles."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & fine)
    if nonzero:
        rows = rows.where(F.exists("x", lambda v: v != 0))
    return rows.withColumn("dim", F.size("x"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(x).ravel()))


def by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, batch.filter(pa.array(dims == dim))


# ---- cells


class Space:
    """The pivots of the vectors of one length, and how many cells a query for ``k``
    neighbours is sent to."""

    def __init__(self, x: np.ndarray, number: int, k: int) -> None:
        source = np.random.default_rng(6)
        distinct = np.unique(x, axis=0)  # equal vectors would be as many equal pivots
        number = min(number, len(distinct))
        self.pivots = distinct[source.choice(len(distinct), number, replace=False)]
        for _ in range(ROUNDS):
            own = self.nearest(x)
            rows = np.bincount(own, minlength=number)
            sums = np.zeros_like(self.pivots)
            np.add.at(sums, own, x)
            self.pivots = np.where(rows[:, None] > 0, sums / np.maximum(rows, 1)[:, None], self.pivots)
        self.probes = self._needed(x, k)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.pivots.T - (self.pivots**2).sum(axis=1) / 2).argmax(axis=1)

    def away(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return np.sqrt(((x - self.pivots[cell]) ** 2).sum(axis=1))

    def order(self, q: np.ndarray) -> np.ndarray:
        """Per query all cells, those whose pivots have the highest inner products first."""
        return np.argsort(-(q @ self.pivots.T), axis=1, kind="stable")

    def _needed(self, x: np.ndarray, k: int) -> int:
        """Cells that hold the share WITHIN of the ``k`` neighbours of sampled vectors in the
        sample. Those among all vectors are nearer, so it asks for too many, not too few."""
        at = np.linspace(0, len(x) - 1, min(ASKED, len(x))).astype(int)
        value = x[at] @ x.T
        value[np.arange(len(at)), at] = -np.inf
        near = np.argsort(-value, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
        rank = np.argsort(self.order(x[at]), axis=1)
        met = np.sort(np.take_along_axis(rank, self.nearest(x)[near], axis=1), axis=None)
        return int(met[int(np.ceil(WITHIN * len(met))) - 1]) + 1


Spaces = dict[int, Space]
Convert = Callable[[np.ndarray], np.ndarray]


def spaces(rows: DataFrame, per_shard: int, k: int, convert: Convert) -> Spaces:
    """The spaces of the lengths of vectors that need several shards. What is collected is
    bounded by SAMPLE / PER_PIVOT numbers for each of at most LENGTHS lengths."""
    counts = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()
    rows_of = {r["dim"]: r["count"] for r in counts if r["count"] > per_shard}
    if not rows_of:
        return {}
    chance = F.coalesce(
        *[F.when(F.col("dim") == d, F.lit(min(1.0, SAMPLE / (d * n)))) for d, n in rows_of.items()],
        F.lit(0.0),
    )
    lot = F.pmod(F.xxhash64("vec_id", "x"), F.lit(LOTS)) / F.lit(float(LOTS))
    # The limit holds where many repeated rows share a lot.
    most = sum(2 * min(n, SAMPLE // d) + PER_PIVOT for d, n in rows_of.items())

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        dim, x = key[0].as_py(), convert(matrix(table.column("x")))
        x = x[np.lexsort((*x.T[::-1], table.column("vec_id").to_numpy()))]
        number = min(-(-rows_of[dim] // per_shard), len(x) // PER_PIVOT)
        made = [pickle.dumps(Space(x, number, k), protocol=5)] if number > 1 else [None]
        return pa.table({"dim": pa.array([dim], pa.int32()), "space": pa.array(made, pa.binary())})

    sample = rows.where(lot < chance).limit(most)
    fitted = sample.groupBy("dim").applyInArrow(fit, "dim int, space binary").collect()
    return {r["dim"]: pickle.loads(r["space"]) for r in fitted if r["space"] is not None}


def placed(rows: DataFrame, found: Spaces, convert: Convert, saved: Saved) -> DataFrame:
    """(dim, cell, vec_id, x, away): the vectors with their cells and distances to its pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in by_length(batches):
            x = convert(matrix(part.column("x")))
            cell, away = np.zeros(len(x), np.int64), np.zeros(len(x))
            if dim in found:
                cell = found[dim].nearest(x)
                away = found[dim].away(x, cell)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("dim"),
                    pa.array(cell, pa.int32()),
                    part.column("vec_id"),
                    lists(x),
                    pa.array(away),
                ],
                names=["dim", "cell", "vec_id", "x", "away"],
            )

    kinds = "dim int, cell int, vec_id long, x array<double>, away double"
    return saved.write(rows.select("dim", "vec_id", "x").mapInArrow(run, kinds), "cells")


def tasks(groups: int) -> int:
    """Shuffle partitions for so many groups: a few more, so that they rarely share one."""
    return max(1, min(TASKS, 3 * groups))


def sharded(
    rows: DataFrame, per_shard: int, k: int, index: Callable, saved: Saved, convert: Convert = lambda x: x
) -> tuple[DataFrame, DataFrame, Spaces]:
    """(dim, cell, part, index): ``index`` of (ids, matrix) for every shard; (dim, cell, parts,
    radius): the cells; and the spaces. Rows of a cell are dealt to its parts by id and
    place, so that repeats of a row spread over all of them."""
    importable(rows.sparkSession)
    found = spaces(rows, per_shard, k, convert)
    points = placed(rows, found, convert, saved)
    parts = F.greatest(F.lit(1), F.round(F.count("*") / per_shard)).cast("int")
    cells = points.groupBy("dim", "cell").agg(parts.alias("parts"), F.max("away").alias("radius"))
    cells = saved.write(cells, "sizes")
    number = cells.agg(F.sum("parts")).first()[0] or 0

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        made = pickle.dumps(index(ids[order], matrix(table.column("x"))[order]), protocol=5)
        columns = {name: pa.array([value.as_py()], pa.int32()) for name, value in zip(KEYS, key, strict=False)}
        return pa.table(columns | {"index": pa.array([made], pa.binary())})

    dealt = points.withColumn("lot", F.xxhash64("vec_id", F.monotonically_increasing_id()))
    dealt = dealt.join(cells.drop("radius"), ["dim", "cell"])
    dealt = dealt.withColumn("part", F.pmod("lot", "parts").cast("int"))
    made = (
        dealt.select("dim", "cell", "part", "vec_id", "x")
        .repartition(tasks(number), "dim", "cell", "part")
        .groupBy("dim", "cell", "part")
        .applyInArrow(build, "dim int, cell int, part int, index binary")
    )
    return saved.write(made, "shards"), cells, found


# ---- queries


def questions(queries: DataFrame) -> DataFrame:
    """(dim, query_id, x, home, floor): the queries, with no home and no floor yet. Rows that
    repeat an id are one query, with the least of their vectors."""
    queries = queries.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("x").alias("x"))
    nothing = F.lit(None)
    return queries.select(
        F.size("x").alias("dim"), "query_id", "x", nothing.cast("int").alias("home"), nothing.cast("long").alias("floor")
    )


def routed(asked: DataFrame, choose: Callable, found: Spaces, convert: Convert = lambda x: x) -> DataFrame:
    """(dim, query_id, x, home, floor, cells): the cells of each query, which ``choose``
    (space, dim, matrix, floors) gives as an array of flags. A length without pivots has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in by_length(batches):
            x = convert(matrix(part.column("x")))
            if dim in found:
                floors = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                chosen = choose(found[dim], dim, x, np.where(np.isnan(floors), -np.inf, floors))
            else:
                chosen = np.ones((len(x), 1), bool)
            ends = np.concatenate([[0], np.cumsum(chosen.sum(axis=1))]).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(chosen)[1].astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [part.column("dim"), part.column("query_id"), lists(x), part.column("home"), part.column("floor"), cells],
                names=["dim", "query_id", "x", "home", "floor", "cells"],
            )

    kinds = "dim int, query_id long, x array<double>, home int, floor long, cells array<int>"
    return asked.select("dim", "query_id", "x", "home", "floor").mapInArrow(run, kinds)


def first_cells(number: Callable[[Space], int]) -> Callable:
    """Chooses the first cells in the order of their pivots' inner products."""

    def choose(space: Space, dim: int, q: np.ndarray, floors: np.ndarray) -> np.ndarray:
        chosen = np.zeros((len(q), len(space.pivots)), bool)
        np.put_along_axis(chosen, space.order(q)[:, : number(space)], True, axis=1)
        return chosen

    return choose


def reaching_cells(cells: DataFrame, found: Spaces) -> Callable:
    """Chooses all cells that may hold a score of the floor or more: no vector of a cell has
    an inner product with q above q . pivot + |q| radius. Bounds are rounded up."""
    radii = {dim: np.zeros(len(space.pivots)) for dim, space in found.items()}
    if radii:
        for r in cells.where(F.col("dim").isin(list(radii))).collect():
            radii[r["dim"]][r["cell"]] = r["radius"]

    def choose(space: Space, dim: int, q: np.ndarray, floors: np.ndarray) -> np.ndarray:
        length = np.sqrt((q**2).sum(axis=1))[:, None]
        reach = length * (np.sqrt((space.pivots**2).sum(axis=1)) + radii[dim])
        bounds = q @ space.pivots.T + length * radii[dim] + SLACK * (1 + reach)
        return ~(bounds < floors[:, None])  # one that is no number is kept

    return choose


def _part(home: bool | None) -> Callable[[DataFrame], DataFrame]:
    own: Column = F.pmod(F.xxhash64("query_id"), "parts").cast("int")

    def run(rows: DataFrame) -> DataFrame:
        if home:
            return rows.withColumn("part", own)
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        if home is None:
            return rows
        return rows.where(~F.coalesce((F.col("cell") == F.col("home")) & (F.col("part") == own), F.lit(False)))

    return run


def searching(search: Callable, kind: pa.DataType, again: bool) -> Callable:
    """A task over indexes, each followed by its queries: what ``search`` (index, ids, matrix,
    floors) finds per query. Queries of a part without rows find nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, index = None, None
        for batch in batches:
            keys = np.column_stack([batch.column(name).to_numpy() for name in KEYS])
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if tuple(keys[begin]) != place:
                    place, index = tuple(keys[begin]), None
                if batch.column("index")[begin].is_valid:
                    index = pickle.loads(batch.column("index")[begin].as_buffer())
                    begin += 1
                rows = batch.slice(begin, end - begin)
                if not len(rows):
                    continue
                names, values = [[] for _ in range(len(rows))], [[] for _ in range(len(rows))]
                if index is not None:
                    ids, floors = rows.column("query_id").to_numpy(), rows.column("floor").to_pylist()
                    names, values = search(index, ids, matrix(rows.column("x")), floors)
                x = rows.column("x")
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("dim"),
                        rows.column("query_id"),
                        x if again else pa.nulls(len(rows), x.type),
                        rows.column("cell"),
                        pa.array(names, pa.list_(pa.int64())),
                        pa.array(values, pa.list_(kind)),
                    ],
                    names=["dim", "query_id", "x", "home", "vec_id", "score"],
                )

    return run


def searched(
    asked: DataFrame,
    shards: DataFrame,
    cells: DataFrame,
    search: Callable,
    score: str,
    saved: Saved,
    home: bool | None = None,
) -> DataFrame:
    """(dim, query_id, x, home, vec_id, score): what ``search`` found per query and shard, in
    arrays: in all parts of the query's cells, or in one part only (its home, then x comes
    back), or in all but that one."""
    asked = saved.write(asked, "asked")
    load = asked.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell").count()
    salts = F.ceil(F.col("count") / (F.col("parts") * QUERIES if home else F.lit(QUERIES))).cast("int")
    plan = load.join(cells, ["dim", "cell"]).select("dim", "cell", "parts", salts.alias("salts"))
    plan = saved.write(plan, "plan")
    copies = plan.agg(F.sum(F.col("parts") * F.col("salts"))).first()[0] or 0

    rows = asked.withColumn("cell", F.explode("cells")).join(plan, ["dim", "cell"])
    salt = F.pmod(F.xxhash64(F.lit("salt"), "query_id"), "salts").cast("int")
    rows = _part(home)(rows).select("dim", "cell", "part", salt.alias("salt"), "query_id", "x", "floor")
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    indexes = shards.join(plan, ["dim", "cell"]).select("dim", "cell", "part", salt.alias("salt"), "index")
    together = indexes.unionByName(rows, allowMissingColumns=True)
    together = together.repartition(tasks(copies), *KEYS).sortWithinPartitions(*KEYS, F.asc_nulls_first("query_id"))
    kind = pa.float64() if score == "double" else pa.int64()
    return together.mapInArrow(
        searching(search, kind, bool(home)),
        f"dim int, query_id long, x array<double>, home int, vec_id array<long>, score array<{score}>",
    )


def results(found: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) of what was found, a row each."""
    row = F.explode(F.arrays_zip("vec_id", "score"))
    return found.select("query_id", row.alias("r")).select("query_id", "r.vec_id", "r.score")


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest per query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
