"""Word hashes of whole Arrow columns of texts, without a Python step per word.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D, with A-Z taken as a-z. A word's
hash is a sum of random numbers for its bytes, each times an odd number for the byte's
place, mixed: 64 bits, so that equal hashes mean equal words but for chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
PLACES = 4096


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def randoms(seed: int, start: int, stop: int) -> np.ndarray:
    """Fixed numbers that look random, by seed and place."""
    return mix(np.arange(start, stop, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
BYTES = randoms(1 << 40, 1, 257)
BYTES[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]
BYTES[WHITE] = 0
PLACE = randoms(2 << 40, 1, PLACES + 1) | np.uint64(1)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where each text begins; a null has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _blocks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about BLOCK bytes that end at white space, so at no word's inside."""
    begin = 0
    while begin < len(data):
        end = begin + BLOCK
        while end < len(data) and not (white := WHITE[data[end : end + BLOCK]]).any():
            end += BLOCK
        end = end + int(white.argmax()) if end < len(data) else len(data)
        yield begin, end
        begin = end


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and where each text's words begin."""
    hashes, starts_all = [], []
    for begin, end in _blocks(data):
        part = data[begin:end]
        solid = ~WHITE[part]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        heads = offsets[np.searchsorted(offsets, begin) : np.searchsorted(offsets, end)] - begin
        first[heads] |= solid[heads]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        part = part[starts[0] :]
        lengths = np.diff(starts, append=end - begin)
        place = np.arange(len(part)) - np.repeat(starts - starts[0], lengths)
        # White space counts 0 wherever it stands, so places behind a word do not matter.
        if (most := int(lengths.max())) > PLACES:
            factor = (randoms(2 << 40, 1, most + 1) | np.uint64(1))[place]
        else:
            factor = PLACE[place]
        hashes.append(mix(np.add.reduceat(BYTES[part] * factor, starts - starts[0])))
        starts_all.append(starts + begin)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts = np.concatenate(starts_all)
    return np.concatenate(hashes), np.searchsorted(starts, offsets)
