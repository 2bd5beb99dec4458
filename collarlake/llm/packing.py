"""Packing of documents into sequences of a fixed number of tokens, by bin completion.

Texts are encoded and cut where they are; what is packed are the pieces' lengths. There are no
more different lengths than a sequence has tokens, so the search works on how many pieces
each length has, a table whose size does not depend on the data, and sees all
documents at once. It returns patterns: the lengths in a sequence, and how many sequences
are filled alike. Pieces find their place by their rank among those of their length. Ranks
come from the counts of lengths in each part of the pieces' table; no group of equal lengths is
ever in one task.

The search is a branch and bound on sequences. Each step takes the longest piece left and
lists fillings of the room beside it that are not dominated: no piece left over could replace
one or two of the filling's pieces and use as much room or more. A piece that fits the room
exactly dominates all other fillings. A filling is used for as many sequences as the counts
allow. A branch ends when its waste exceeds what a better solution may have; the first
solution to beat is that of best-fit decreasing. The search ends when a solution meets the lower
bound, or after ``STEPS`` steps with the best solution found. Steps and the fillings
listed in one are bounded; pieces are not: every solution has all of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collarlake.llm.bpe import SPLIT, loaded
from collarlake.llm.tables import Saved, importable
from collarlake.sizing import sized_for

STEPS = 6_000
FILLINGS = 8  # tried beside one piece
TRIES = 400  # ways to look for these

Pattern = tuple[tuple[int, ...], int]


@lru_cache(maxsize=4)
def encoding(path: str):
    """The vocabulary of a tokenizer file as ranks. Ids of merged tokens rise with their
    merge, so the lowest id is merged first, as the file says."""
    import tiktoken

    model, tokens, special = loaded(path)
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if ids != sorted(set(ids)) or len(ids) + 256 != len(vocab):
        raise ValueError("the tokens of this file are not in the order of their merges")
    ranks = {token: i for i, token in tokens.items() if i not in special.values()}
    return tiktoken.Encoding(
        "packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special
    )


def packed_ids(path: str, text: str) -> bytes:
    """Token ids as little-endian unsigned 32-bit numbers. Special tokens in a text become
    their ids."""
    found = encoding(path).encode_to_numpy(text, allowed_special="all")
    return found.astype("<u4", copy=False).tobytes()


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, behind a shorter first one if need be."""
    first = tokens % capacity or min(tokens, capacity)
    return [(0, first), *((at, capacity) for at in range(first, tokens, capacity))]


def pieces(
    df: DataFrame, path: str, key: str, text: str = "text", capacity: int = 2048, end: int = 0
) -> DataFrame:
    """The pieces of each row's text: ``key``, ``piece``, ``start``, ``length`` and ``ids_crc32``; and for the
    ranks, ``part`` and ``nth``, the place among the task's pieces of that length.

    A document is its text's ids and then ``end``; a null text is empty. A column of another
    name is not read.
    """
    importable(df.sparkSession)
    df = df.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType(
        [
            T.StructField("__key", df.schema["__key"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("nth", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64).tolist()
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            rows, found = [], []
            for row, value in enumerate(batch.column("__text")):
                ids = packed_ids(path, value.as_py() or "") + last
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    found.append((piece, start, length, crc, part, seen[length]))
                    seen[length] += 1
                    rows.append(row)
            columns = zip(*found, strict=True) if found else [()] * 6
            arrays = [pa.array(x, pa.int64()) for x in columns]
            arrays[0], arrays[4] = arrays[0].cast(pa.int32()), arrays[4].cast(pa.int32())
            own = batch.column("__key").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([own, *arrays], names=schema.names)

    return df.mapInArrow(run, schema)


class Stock:
    """How many pieces of each length are left, and the longest one that fits a room."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts.astype(np.int64).copy()
        self._fits()

    def _fits(self) -> None:
        sizes = np.arange(len(self.counts))
        self.fits = np.maximum.accumulate(np.where(self.counts > 0, sizes, 0))
        self.longest = int(self.fits[-1])

    def take(self, filling: Sequence[int], times: int) -> None:
        for size in filling:
            self.counts[size] -= times
        self._fits()

    def most(self, filling: Sequence[int]) -> int:
        """For how many sequences the filling can be used."""
        return min(int(self.counts[s]) // filling.count(s) for s in set(filling))

    def dominated(self, filling: Sequence[int], waste: int) -> bool:
        """Whether a piece left over could replace one or two of these and fill as much."""
        left = {s: int(self.counts[s]) - filling.count(s) for s in set(filling)}

        def longest(room: int, least: int) -> bool:
            size = int(self.fits[min(room, len(self.fits) - 1)])
            while size >= least and left.get(size, 1) <= 0:
                size = int(self.fits[size - 1]) if size else 0
            return size >= least

        beside = filling[1:]
        if any(longest(s + waste, s + 1) for s in set(beside)):
            return True
        pairs = {a + b for i, a in enumerate(beside) for b in beside[i + 1 :]}
        return any(longest(s + waste, s) for s in pairs if s < len(self.fits))


def fillings(stock: Stock, capacity: int, allowed: int) -> list[tuple[int, ...]]:
    """Undominated fillings of a sequence around the longest piece, the least waste first,
    that waste no more than ``allowed`` in one sequence."""
    longest = stock.longest
    counts = stock.counts
    found: dict[tuple[int, ...], int] = {}
    tries = TRIES

    def pair(room: int, most: int) -> tuple[int, ...]:
        """Two pieces that fill a room exactly, the longer one as long as can be."""
        first = np.arange(min(room - 1, most), room // 2 - 1 if room > 1 else 0, -1)
        second = room - first
        good = (counts[first] > (first == second)) & (counts[second] > 0) & (second <= first)
        at = int(np.argmax(good)) if len(first) else 0
        return (int(first[at]), int(second[at])) if len(first) and good[at] else ()

    def search(room: int, most: int, own: tuple[int, ...]) -> bool:
        """Fill a room with pieces of at most ``most``; whether to go on looking."""
        nonlocal tries
        tries -= 1
        size = int(stock.fits[min(room, most)])
        if not size or size == room:
            own = (*own, size) if size else own
            found[own] = room - size
            # One piece that fits exactly dominates all other fillings.
            return tries > 0 and len(found) < FILLINGS and not (size and len(own) == 1)
        if two := pair(room, most):
            found[(*own, *two)] = 0
            if len(found) >= FILLINGS:
                return False
        while size:
            stock.take((size,), 1)
            go_on = search(room - size, size, (*own, size))
            stock.take((size,), -1)
            if not go_on:
                return False
            size = int(stock.fits[size - 1])
        return True

    stock.take((longest,), 1)
    search(capacity - longest, longest, ())
    stock.take((longest,), -1)
    listed = sorted(
        ((waste, (longest, *own)) for own, waste in found.items() if waste <= allowed),
        key=lambda x: (x[0], len(x[1]), [-s for s in x[1]]),
    )
    good = [own for waste, own in listed if not stock.dominated(own, waste)]
    return good or [own for _, own in listed[:1]]


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing: each piece goes to the fullest sequence that has room for it, and
    equal pieces to equal sequences at once."""
    rooms: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for size in np.flatnonzero(counts)[::-1].tolist():
        left, room = int(counts[size]), size
        while left:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                fit = capacity // size
                if left >= fit:
                    rooms[capacity - fit * size].append(((size,) * fit, left // fit))
                if left % fit:
                    rest = left % fit
                    rooms[capacity - rest * size].append(((size,) * rest, 1))
                break
            own, times = rooms[room].pop()
            used = min(times, left)
            if times > used:
                rooms[room].append((own, times - used))
            rooms[room - size].append(((*own, size), used))
            left -= used
            if room - size >= size:
                room = room - size
    return [pattern for group in rooms for pattern in group]


def sequences(patterns: Sequence[Pattern]) -> int:
    return sum(times for _, times in patterns)


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """No packing has fewer: by the tokens, and by the pieces too long to share a sequence."""
    sizes = np.arange(len(counts))
    total = int((counts * sizes).sum())
    bound = -(-total // capacity)
    for small in np.unique(np.minimum(sizes[counts > 0], capacity // 2)).tolist():
        # Pieces over capacity - small are alone as far as pieces of at least ``small`` go; what room
        # others leave may be filled completely.
        alone = int(counts[sizes > capacity - small].sum())
        large = (sizes > capacity // 2) & (sizes <= capacity - small)
        middle = (sizes >= small) & (sizes <= capacity // 2)
        rest = int((counts * sizes)[middle].sum())
        spare = int(((capacity - sizes) * counts)[large].sum())
        bound = max(bound, alone + int(counts[large].sum()) + max(0, -(-(rest - spare) // capacity)))
    return bound


def complete(counts: np.ndarray, capacity: int, steps: int = STEPS) -> list[Pattern]:
    """Patterns for all pieces, with as few sequences as the search finds."""
    best = best_fit(counts, capacity)
    bound = least_sequences(counts, capacity)
    total = int((counts * np.arange(len(counts))).sum())
    if sequences(best) == bound:
        return best
    stock = Stock(counts)
    path: list[Pattern] = []
    branches: list[list[tuple[int, ...]]] = []
    wasted = 0

    def spare() -> int:
        """What a better solution may still waste."""
        return (sequences(best) - 1) * capacity - total - wasted

    while steps > 0 and sequences(best) > bound:
        if len(branches) == len(path):
            if not stock.longest:
                if spare() >= 0:
                    best = list(path)
                branches.append([])
            else:
                branches.append(fillings(stock, capacity, spare()) if spare() >= 0 else [])
        steps -= 1
        while branches and not branches[-1]:
            branches.pop()
            if path and len(branches) == len(path):
                own, times = path.pop()
                stock.take(own, -times)
                wasted -= times * (capacity - sum(own))
            if not branches:
                return best
        own = branches[-1].pop(0)
        times = stock.most(own)
        waste = capacity - sum(own)
        if waste:
            times = min(times, max(1, spare() // waste))
        stock.take(own, times)
        path.append((own, times))
        wasted += times * waste
    return best


def places(patterns: Sequence[Pattern]) -> dict[str, np.ndarray]:
    """For each length, in order of ranks: from which rank on pieces go to a pattern, how many
    in one sequence, its first sequence, and where in it they begin."""
    rows, given, first = [], {}, 0
    for own, times in patterns:
        offset = 0
        for size in sorted(set(own), reverse=True):
            need = own.count(size)
            begin = given.get(size, 0)
            rows.append((size, begin, need, first, offset))
            given[size] = begin + need * times
            offset += need * size
        first += times
    rows.sort()
    names = ("size", "begin", "need", "first", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pack(
    docs: DataFrame,
    path: str,
    key: str,
    text: str = "text",
    capacity: int = 2048,
    end: int = 0,
    steps: int = STEPS,
) -> DataFrame:
    """The pieces of all documents with their ``sequence_id`` and ``offset`` in it, without gaps.

    ``path`` is a tokenizer file that every worker can open. Null texts are empty documents,
    with the end alone. Rows that repeat a ``key`` are documents of their own; a null key stays
    null. An empty table has no pieces. Columns other than the key and the text are not read.
    """
    saved = Saved(docs.sparkSession, "packing")
    found = saved.write(pieces(docs, path, key, text, capacity, end), "pieces")
    with sized_for(found):
        parts = saved.write(
            found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("rows")), "parts"
        )
        # At most a row for each length.
        lengths = parts.groupBy("length").agg(F.sum("rows").alias("rows")).collect()
        counts = np.zeros(capacity + 1, np.int64)
        for row in lengths:
            counts[row.length] = row.rows
        plan = places(complete(counts, capacity, steps))
        before = Window.partitionBy("length").orderBy("part")
        before = before.rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(
            "part", "length", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before")
        )
        ranked = saved.write(found.join(parts, ["part", "length"]), "ranked")
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            *(found.schema[n] for n in ("piece", "start", "length", "ids_crc32")),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    shift = int(counts.max()).bit_length() + 1
    order = (plan["size"] << shift) | plan["begin"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(order, (length << shift) | rank, "right") - 1
            beyond, need = rank - plan["begin"][at], plan["need"][at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("__key", "piece", "start", "length", "ids_crc32")),
                    pa.array(plan["first"][at] + beyond // need, pa.int64()),
                    pa.array(plan["offset"][at] + beyond % need * length, pa.int64()),
                ],
                names=schema.names,
            )

    rank = (F.col("nth") + F.col("before")).alias("rank")
    columns = ("__key", "piece", "start", "length", "ids_crc32")
    return ranked.select(*columns, rank).mapInArrow(run, schema)
