"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, scored from mapped files.

Counting. Each task turns its texts into numbered words, counts its distinct n-grams, and
sends them in packed blocks by the hash of the n-gram, so that an n-gram's counts meet in
one place and a very frequent word or context is spread over all places. There the counts
are added up and written as a table sorted by hash. What lower orders need is added up in
the same place first and sent on: for each (n-1)-gram the number of distinct words before
it, and for each context its total and how many n-grams have count 1, 2, and 3 or more.
Words are numbered by falling count, which packs well.

A table holds for each n-gram its count and what it is as a context, in as few bits as
its bucket needs. Of a hash it leaves out the bits that the bucket and a cell of the bucket
fix; of a column it keeps a few bits a row, and the rare larger numbers apart. Nothing is
rounded or left out: hashes are those of 64 bits, and all counts are kept.

Scoring. Workers map the files of a bucket into memory when they first look into it; pages
come from the system's cache and are shared by all workers of a machine. Look-ups are
sorted and distinct, so they run through a file in order.

    p_n(w | c) = max(count(c w) - D(count), 0) / total(c) + g(c) p_{n-1}(w | c')

with counts of distinct left neighbours below the highest order, discounts D1, D2 and D3+
per order from the counts of counts, g(c) the mass that they free, and a uniform
distribution over all words and one unknown word below order 1. An unseen context passes
on to the lower order. A token's context is the n-gram that ends with the token before it, so
one look-up for each token and order finds both.

The folder must be one that all workers see under the same path, as a mounted file system.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from collarlake.llm.tables import importable
from collarlake.llm.words import mix, text_bytes, word_hashes
from collarlake.sizing import estimated_bytes, sized_for

MIB = 1024 * 1024
ORDER = 3
BUCKET_BYTES = 4 * MIB  # of input per bucket
BUCKETS = (16, 65_536)
STRETCH = 4 * MIB
EVENTS = 1 << 21  # n-grams that a task gathers before it counts and sends them
MAPS = 256

END = np.uint64(0x5EED0E0D)  # hash of the end of a text
START = np.uint32(0xFFFFFFFE)
UNKNOWN = np.uint32(0xFFFFFFFD)


def local_path(folder: str) -> str:
    parsed = urlparse(folder)
    if parsed.scheme not in ("", "file"):
        raise ValueError("the model's folder must be mounted: workers map its files")
    return parsed.path


# ---- blocks of numbers that travel between tasks


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of equal length; the first is best sorted. Differences, bytes by place."""
    size, widths, parts = len(columns[0]), [], []
    for column in columns:
        column = column.astype(np.uint64)
        step = column if parts else np.diff(column, prepend=np.uint64(0))
        widths.append(max(1, -(-int(step.max()).bit_length() // 8)) if size else 1)
        parts.append(np.ascontiguousarray(step.view(np.uint8).reshape(size, 8)[:, : widths[-1]].T))
    head = np.array([size, len(columns), *widths], np.uint64)
    raw = b"".join([head.tobytes(), *(p.tobytes() for p in parts)])
    return np.array([len(raw)], np.uint64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(block: bytes) -> list[np.ndarray]:
    length = int(np.frombuffer(block[:8], np.uint64)[0])
    raw = pa.decompress(block[8:], decompressed_size=length, codec="zstd", asbytes=True)
    size, count = (int(x) for x in np.frombuffer(raw[:16], np.uint64))
    at = 16 + 8 * count
    columns = []
    for width in np.frombuffer(raw[16:at], np.uint64).astype(int):
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :width] = np.frombuffer(raw, np.uint8, width * size, at).reshape(width, size).T
        columns.append(wide.view(np.uint64).ravel())
        at += width * size
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return columns


def added(columns: list[np.ndarray], keys: int, by: np.ndarray | None = None) -> list[np.ndarray]:
    """Rows with equal first ``keys`` columns become one, the other columns added up. They are
    sorted by the first column or by ``by``, a hash of the keys, which is then the first one."""
    order = np.argsort(columns[0] if by is None else by)
    hashes = [] if by is None else [by[order]]
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = columns[0][1:] != columns[0][:-1]
    for c in columns[1:keys]:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    summed = [np.add.reduceat(c, at) if len(at) else c for c in columns[keys:]]
    return [c[at] for c in hashes + columns[:keys]] + summed


def added_grams(columns: list[np.ndarray], n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The same for n-grams: their hashes, sorted, and the columns."""
    width = -(-n // 2)
    hashes, *columns = added(columns, width, gram_hash(grams_of(columns[:width], n)))
    return hashes, columns


def keys_of(grams: np.ndarray) -> list[np.ndarray]:
    """n-grams (rows of word numbers) as columns of 64 bits, two words in each."""
    n = grams.shape[1]
    wide = [grams[:, i].astype(np.uint64) for i in range(n)]
    pairs = [wide[i] << np.uint64(32) | wide[i + 1] for i in range(0, n - 1, 2)]
    return pairs + ([wide[-1]] if n % 2 else [])


def grams_of(keys: list[np.ndarray], n: int) -> np.ndarray:
    columns = []
    for i, key in enumerate(keys):
        if 2 * i + 1 < n:
            columns += [key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)]
        else:
            columns.append(key)
    return np.stack(columns, axis=1).astype(np.uint32)


def gram_hash(grams: np.ndarray) -> np.ndarray:
    out = mix(np.full(len(grams), np.uint64(grams.shape[1])))
    for i in range(grams.shape[1]):
        out = mix(out ^ grams[:, i].astype(np.uint64)) + np.uint64(0x632BE59BD9B4E019)
    return mix(out)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash."""
    return (hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def blocks(level: int, kind: str, hashes: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """(level, kind, bucket, block) for each bucket that has rows; columns sorted by the first."""
    order = np.argsort(columns[0])
    to = bucket_of(hashes[order], buckets)
    within = np.argsort(to.astype(np.uint16) if buckets <= 1 << 16 else to, kind="stable")
    order, to = order[within], to[within]
    edges = np.searchsorted(to, np.arange(buckets + 1))
    columns = [c[order] for c in columns]
    for b in np.flatnonzero(np.diff(edges)):
        yield level, kind, int(b), pack([c[edges[b] : edges[b + 1]] for c in columns])


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    levels, kinds, buckets, found = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(levels, pa.int64()),
            pa.array(kinds, pa.string()),
            pa.array(buckets, pa.int64()),
            pa.array(found, pa.binary()),
        ],
        names=["level", "kind", "bucket", "block"],
    )


_BLOCKS = "level long, kind string, bucket long, block binary"
DONE = -1  # level of what tasks report of the files that they wrote


# ---- tables sorted by hash, in files


BITS = (0, 1, 2, 4, 8, 16, 32, 64)  # of a number in a column
RESTS = {40: np.uint8, 48: np.uint16, 64: np.uint32}  # bits of a hash that are stored
CELLS = 256  # cells whose beginnings are counted from the same number


def first_hash(bucket: int, buckets: int) -> int:
    return -(-(bucket << 32) // buckets) << 32


def packed_column(v: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """A column as numbers of few bits above its least, and the places and values of those
    that need more: they have the largest number of these bits, or any if there are none."""
    least = v.min() if len(v) else np.uint64(0)
    x = v - least
    lengths = [int((x >= np.uint64((1 << b) - 1)).sum()) if 0 < b < 64 else 0 for b in BITS]
    lengths[0] = int((x > 0).sum())
    bits, apart = min(zip(BITS, lengths, strict=True), key=lambda c: c[0] * len(x) + 96 * c[1])
    large = np.flatnonzero(x > 0) if not bits else np.flatnonzero(x >= np.uint64((1 << bits) - 1)) if bits < 64 else np.zeros(0, int)
    if bits >= 8:
        dense = np.minimum(x, np.uint64((1 << bits) - 1)).astype(f"u{bits // 8}")
    elif bits:
        each = 8 // bits
        small = np.zeros(-(-len(x) // each) * each, np.uint8)
        small[: len(x)] = np.minimum(x, np.uint64((1 << bits) - 1))
        dense = np.bitwise_or.reduce(small.reshape(-1, each) << (np.arange(each) * bits).astype(np.uint8), axis=1)
    else:
        dense = np.zeros(0, np.uint8)
    return [int(least), bits, len(large)], [dense, large.astype(np.uint32), v[large]]


def packed_hashes(hashes: np.ndarray, first: int, buckets: int) -> tuple[list[int], list[np.ndarray]]:
    """Sorted hashes of a bucket: the cell of each, by its high bits, is known from where the
    cells begin; the rest of its bits is stored."""
    span = (((1 << 32) // buckets + 1) << 32).bit_length()
    rest = min((r for r in RESTS if r >= span - 24), key=lambda r: len(hashes) * min(r, 64) // 8 + 2 * (1 << max(0, span - r)), default=64)
    beyond = hashes - np.uint64(first)
    cells = 1 << max(0, span - rest)
    of = beyond >> np.uint64(rest) if rest < 64 else np.zeros(len(beyond), np.uint64)
    begins = np.searchsorted(of, np.arange(cells + 1, dtype=np.uint64))
    base = begins[::CELLS]
    near = begins - np.repeat(base, CELLS)[: len(begins)]
    wide = np.uint16 if near.max() < 1 << 16 else np.uint32
    low = (beyond & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = beyond >> np.uint64(32) & np.uint64((1 << rest - 32) - 1)
    return [rest, cells, np.dtype(wide).itemsize], [base.astype(np.uint32), near.astype(wide), low, high.astype(RESTS[rest])]


def write_table(path: str, hashes: np.ndarray, values: list[np.ndarray], bucket: int, buckets: int) -> None:
    """One file: a head that says what follows, the hashes, then each column's numbers. It
    appears under its name when it is whole; a task that runs again replaces it."""
    if (hashes[1:] < hashes[:-1]).any():
        order = np.argsort(hashes)
        hashes, values = hashes[order], [v[order] for v in values]
    first = first_hash(bucket, buckets)
    shape, arrays = packed_hashes(hashes, first, buckets)
    head = [len(hashes), first, len(values), *shape]
    for v in values:
        shape, more = packed_column(v.astype(np.uint64))
        head, arrays = head + shape, arrays + more
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.array([len(head) + len(arrays), *head, *(a.nbytes for a in arrays)], np.uint64).tofile(file)
        for a in arrays:
            a.tofile(file)
    os.replace(part, path)


class Table:
    """A mapped file of ``write_table``."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        count = int(raw[:8].view(np.uint64)[0])
        head = [int(x) for x in raw[8 : 8 + 8 * count].view(np.uint64)]
        self.size, self.first, columns, self.rest, _, wide = head[:6]
        shapes = [head[6 + 3 * i : 9 + 3 * i] for i in range(columns)]
        at, parts = 8 + 8 * count, []
        for length in head[6 + 3 * columns :]:
            parts.append(raw[at : at + length])
            at += length
        kinds = [np.uint32, f"u{wide}", np.uint32, RESTS[self.rest]]
        self.base, self.near, self.low, self.high = (self.array(p, k) for p, k in zip(parts, kinds, strict=False))
        self.columns = []
        for i, (least, bits, _) in enumerate(shapes):
            dense, places, large = parts[4 + 3 * i : 7 + 3 * i]
            kind = f"u{bits // 8}" if bits >= 8 else np.uint8
            self.columns.append((least, bits, self.array(dense, kind), self.array(places, np.uint32), self.array(large, np.uint64)))

    @staticmethod
    def array(part: np.ndarray, kind) -> np.ndarray:
        # The parts of a file begin at any byte.
        return np.frombuffer(part, kind) if len(part) else np.zeros(0, kind)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is stored, and its row."""
        beyond = hashes - np.uint64(self.first)
        cell = (beyond >> np.uint64(self.rest)).astype(np.int64) if self.rest < 64 else np.zeros(len(beyond), np.int64)
        asked = beyond & np.uint64((1 << self.rest) - 1)
        at, end = (self.base[c // CELLS].astype(np.int64) + self.near[c] for c in (cell, cell + 1))
        last = max(self.size - 1, 0)
        stop = end
        for _ in range(int((end - at).max(initial=0)).bit_length()):
            middle = np.minimum((at + end) >> 1, last)
            less = (self.stored(middle) < asked) & (at < end)
            end = np.where(less, end, np.maximum(middle, at))
            at = np.where(less, middle + 1, at)
        inside = at < stop
        at = np.minimum(at, last)
        return (self.stored(at) == asked) & inside, at

    def stored(self, rows: np.ndarray) -> np.ndarray:
        return self.high[rows].astype(np.uint64) << np.uint64(32) | self.low[rows]

    def column(self, i: int, rows: np.ndarray) -> np.ndarray:
        least, bits, dense, places, large = self.columns[i]
        if bits >= 8:
            x = dense[rows].astype(np.uint64)
        elif bits:
            each = 8 // bits
            x = (dense[rows // each] >> (rows % each * bits).astype(np.uint8) & ((1 << bits) - 1)).astype(np.uint64)
        else:
            x = np.zeros(len(rows), np.uint64)
        out = x + np.uint64(least)
        if len(places):
            apart = np.flatnonzero(x == np.uint64((1 << bits) - 1))
            near = np.minimum(np.searchsorted(places, rows[apart].astype(np.uint32)), len(places) - 1)
            hit = places[near] == rows[apart]
            out[apart[hit]] = large[near[hit]]
        return out


@lru_cache(maxsize=MAPS)
def mapped(path: str) -> Table:
    return Table(path)


def look_up(folder: str, kind: str, present: frozenset, buckets: int, hashes: np.ndarray, values: int) -> tuple:
    """Per hash whether it is stored, and a row of its first values, 0 if not."""
    asked, back = np.unique(hashes, return_inverse=True)
    edges = np.searchsorted(bucket_of(asked, buckets), np.arange(buckets + 1))
    found = np.zeros(len(asked), bool)
    out = np.zeros((len(asked), values), np.uint64)
    for b in np.flatnonzero(np.diff(edges)):
        if (kind, int(b)) not in present:
            continue
        table = mapped(f"{folder}/{kind}-{b}")
        part = slice(edges[b], edges[b + 1])
        hit, at = table.places(asked[part])
        found[part] = hit
        at = at[hit]
        for i in range(values):
            out[part, i][hit] = table.column(i, at)
    return found[back], out.view(np.int64)[back]


# ---- texts as tokens


def tokens(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Stretches of whole texts: token hashes, each text's words and an end, and where each
    text's tokens begin."""
    data, offsets = text_bytes(column)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + STRETCH, "right")) - 1)
        end = min(end, len(column))
        part = data[offsets[begin] : offsets[end]]
        words, starts = word_hashes(part, offsets[begin : end + 1] - offsets[begin])
        yield np.insert(words, starts[1:], END), starts + np.arange(len(starts))
        begin = end


def events(ids: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """An n-gram per token: the words before it in its text, START where there are none."""
    columns = [ids]
    place = np.arange(len(ids)) - np.repeat(starts[:-1], np.diff(starts))
    for back in range(1, order):
        before = np.full(len(ids), START, np.uint32)
        before[back:] = ids[:-back]
        before[place < back] = START
        columns.append(before)
    return np.stack(columns[::-1], axis=1)


# ---- the model


# Columns of a table: an n-gram's count, at lower orders that of its distinct left neighbours,
# and what it is as a context: what its total has beyond the least that the rest implies, and
# how many n-grams have 1, 2, and 3 or more.
COLUMNS = 5


@dataclass
class Model:
    folder: str
    buckets: int
    order: int
    tokens: int = 0
    types: int = 0
    present: frozenset = frozenset()  # (kind, bucket) of the files that exist
    discounts: dict = field(default_factory=dict)  # by order: D1, D2, D3+
    bottom: tuple = (0, 0, 0, 0)  # total and numbers of counts 1, 2, 3+ at order 1

    def numbered(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers and training counts."""
        found, values = look_up(self.folder, "words", self.present, self.buckets, hashes, 2)
        ids = values[:, 1] * self.buckets + bucket_of(hashes, self.buckets).astype(np.int64)
        return np.where(found, ids, UNKNOWN).astype(np.uint32), values[:, 0]

    def log_probability(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token after those before it in its text."""
        none = np.full((1, self.order), START, np.uint32)  # before a text's first token
        grams = np.concatenate([none, grams])
        p = np.full(len(grams) - 1, 1.0 / (self.types + 1))
        stats = np.array(self.bottom)[:, None]
        for k in range(1, self.order + 1):
            asked = gram_hash(grams[:, self.order - k :])
            # An n-gram of the highest order is no context.
            width = COLUMNS if k < self.order else 1
            _, found = look_up(self.folder, f"grams{k}", self.present, self.buckets, asked, width)
            p = self._interpolated(found[1:, 0], stats, self.discounts[k], p)
            if k < self.order:
                # The context of a token is what ends with the token before it.
                found[starts[1:]] = found[0]
                found[0] = found[starts[0]] if starts[0] else found[0]
                stats = np.ascontiguousarray(found[:-1, 1:].T)
                stats[0] += stats[1] + 2 * stats[2] + 3 * stats[3]
        return np.log10(p)

    def word_scores(self, hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of tokens, and log10 of their probabilities."""
        words, back = np.unique(hashes, return_inverse=True)
        ids, count = self.numbered(words)
        return count[back], self.log_probability(events(ids[back], starts, self.order), starts)

    @staticmethod
    def _interpolated(count: np.ndarray, stats: np.ndarray, discount: tuple, p: np.ndarray) -> np.ndarray:
        total, free = stats[0], np.zeros(stats.shape[1])
        for d, n in zip(discount, stats[1:], strict=True):
            free = free + d * n
        d = np.array([0.0, *discount])[np.minimum(count, 3)]
        known = total > 0
        below = np.where(known, free / np.maximum(total, 1), 1.0)
        return np.where(known, np.maximum(count - d, 0) / np.maximum(total, 1), 0.0) + below * p


def discounts(n: np.ndarray) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of counts 1 to 4; half a count where those are missing."""
    out = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and y else 0.5
        out.append(float(min(max(d, 0.05), k)))
    return tuple(out)


def _merged(blocks_in: list) -> list[np.ndarray]:
    """All blocks of a bucket as one."""
    parts = [unpack(b.as_py()) for b in blocks_in]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def train(docs: DataFrame, folder: str, order: int = ORDER) -> Model:
    """Count all texts of ``docs`` and write the model's files below ``folder``.

    A null or empty text is its end alone. Without any rows all words are equally likely.
    ``folder`` is used by this model only.
    """
    importable(docs.sparkSession)
    with sized_for(docs):
        return _train(docs, local_path(folder), order)


def _train(docs: DataFrame, path: str, order: int) -> Model:
    low, high = BUCKETS
    buckets = min(max(low, -(-estimated_bytes(docs) // BUCKET_BYTES)), high)
    model = Model(path, buckets, order)
    texts = docs.select("text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for words, _ in tokens(batch.column("text")):
                held.append(words)
                if sum(map(len, held)) >= EVENTS:
                    yield send_words(held)
                    held = []
        if held:
            yield send_words(held)

    def send_words(held: list[np.ndarray]) -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return as_batch([*blocks(0, "words", words, [words, counts.astype(np.uint64)], buckets)])

    def store_words(key: tuple, table: pa.Table) -> pa.Table:
        words, counts = added(_merged(table.column("block")), 1)
        rank = np.empty(len(words), np.uint64)
        rank[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(words), dtype=np.uint64)
        bucket = key[0].as_py()
        write_table(f"{path}/words-{bucket}", words, [counts, rank], bucket, buckets)
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()], pa.int64()),
                "types": pa.array([len(words)], pa.int64()),
                "tokens": pa.array([int(counts.sum())], pa.int64()),
            }
        )

    words = (
        texts.mapInArrow(count_words, _BLOCKS)
        .groupBy("bucket")
        .applyInArrow(store_words, "bucket long, types long, tokens long")
        .collect()  # one row per bucket
    )
    model.tokens = sum(row.tokens for row in words)
    model.types = sum(row.types for row in words)
    present = {("words", row.bucket) for row in words}
    model.present = frozenset(present)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for hashes, starts in tokens(batch.column("text")):
                ids, _ = model.numbered(hashes)
                held.append(events(ids, starts, order))
                if sum(map(len, held)) >= EVENTS:
                    yield send_grams(held)
                    held = []
        if held:
            yield send_grams(held)

    def send_grams(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = keys_of(np.concatenate(held))
        hashes, columns = added_grams([*keys, np.ones(len(keys[0]), np.uint64)], order)
        return as_batch([*blocks(order, "grams", hashes, columns, buckets)])

    flow = texts.mapInArrow(count_grams, _BLOCKS)
    for k in range(order, 0, -1):
        flow = flow.groupBy("level", "bucket").applyInArrow(_store(path, k, buckets), _BLOCKS)
    sums = np.zeros((order + 1, 8), np.int64)
    for row in flow.collect():  # a few numbers per order and bucket
        k = int(row.kind)
        present.add((f"grams{k}", row.bucket))
        sums[k] += np.frombuffer(row.block, np.int64)
    model.discounts = {k: discounts(sums[k, :4].astype(float)) for k in range(1, order + 1)}
    model.bottom = tuple(int(x) for x in sums[1, 4:])
    model.present = frozenset(present)
    return model


def _counted(count: np.ndarray) -> list[np.ndarray]:
    """Per n-gram what it adds to its context."""
    return [count, *(count == c for c in (1, 2)), count >= 3]


def _store(path: str, k: int, buckets: int):
    """Add up a bucket's blocks of order k, write its file, and send on what lower orders
    need. What other tasks reported is passed on."""
    width = -(-k // 2)

    def table(bucket: int, grams: list, contexts: list) -> list[tuple]:
        hashes, found = added_grams(_merged(grams), k) if grams else (np.zeros(0, np.uint64), None)
        rows = grams_of(found[:width], k) if grams else np.zeros((0, k), np.uint32)
        count = found[-1] if grams else np.zeros(0, np.uint64)
        every = hashes
        if contexts:
            at, own = added_grams(_merged(contexts), k)
            every = np.union1d(hashes, at)
            mine, theirs = np.searchsorted(every, hashes), np.searchsorted(every, at)
            more = own[width:]
            more[0] = more[0] - more[1] - np.uint64(2) * more[2] - np.uint64(3) * more[3]
            values = [_placed(v, theirs, len(every)) for v in more]
            values = [_placed(count, mine, len(every)), *values]
        else:
            values = [count, *[np.zeros(len(every), np.uint64)] * 4]
        write_table(f"{path}/grams{k}-{bucket}", every, values, bucket, buckets)
        sums = [*((count == c).sum() for c in range(1, 5)), *(s.sum() for s in _counted(count))]
        out = [(DONE, str(k), bucket, np.array(sums).astype(np.int64).tobytes())]
        if k > 1 and len(rows):
            for kind, part, numbers in (
                ("grams", rows[:, 1:], [np.ones(len(rows))]),
                ("contexts", rows[:, :-1], _counted(count)),
            ):
                keys = keys_of(part)
                to, summed = added_grams([*keys, *(v.astype(np.uint64) for v in numbers)], k - 1)
                out += blocks(k - 1, kind, to, summed, buckets)
        return out

    def run(key: tuple, data: pa.Table) -> pa.Table:
        if key[0].as_py() == DONE:
            return data
        kinds = data.column("kind").to_pylist()
        grams, contexts = (
            [b for b, kind in zip(data.column("block"), kinds, strict=True) if kind == name]
            for name in ("grams", "contexts")
        )
        return pa.Table.from_batches([as_batch(table(key[1].as_py(), grams, contexts))])

    return run


def _placed(values: np.ndarray, at, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint64)
    out[at] = values
    return out


ADDED = {
    "n_tokens": T.LongType(),
    "n_known": T.LongType(),
    "base_score": T.DoubleType(),
    "score": T.DoubleType(),
}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known, base_score and score: the log10
    probabilities of the whole text by single words and by the model. Every text has its
    end as a token at least. Columns with one of these names are replaced."""
    importable(docs.sparkSession)
    fields = [f for f in docs.schema.fields if f.name not in ("text", *ADDED)]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, *(T.StructField(n, kind) for n, kind in ADDED.items())])
    base = model.tokens + 0.5 * (model.types + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for hashes, starts in tokens(batch.column("text")):
                count, logs = model.word_scores(hashes, starts)
                heads = starts[:-1]
                parts.append(
                    (
                        np.diff(starts),
                        np.add.reduceat((count > 0).astype(np.int64), heads),
                        np.add.reduceat(np.log10((count + 0.5) / base), heads),
                        np.add.reduceat(logs, heads),
                    )
                )
            if parts:
                found = [pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), *found],
                    names=[*names, *ADDED],
                )

    return docs.mapInArrow(run, schema)
