"""Packing against the least number of sequences and the tokenizer library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Regex, Tokenizer, pre_tokenizers

from collarlake.llm import packing
from collarlake.llm.queries import tokenizer
from tests.llm.data import documents, odd_rows

PATH = tokenizer("byte_bpe_50k.json")


def fewest(sizes, capacity):
    """The least number of sequences, by trying everything."""
    sizes = sorted(sizes, reverse=True)
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= sizes[i]:
                place(i + 1, [*rooms[: (k := rooms.index(room))], room - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def checked(patterns, counts, capacity):
    given = np.zeros_like(counts)
    for own, times in patterns:
        assert sum(own) <= capacity and times > 0
        for size in own:
            given[size] += times
    assert (given == counts).all()
    return packing.sequences(patterns)


def test_search_finds_the_least_number():
    rnd = random.Random(5)
    better = 0
    for _ in range(300):
        capacity = rnd.choice([10, 20, 50, 100])
        low, high = rnd.choice([(1, capacity), (max(1, capacity // 5), capacity // 2)])
        sizes = [rnd.randint(low, high) for _ in range(rnd.randint(0, 10))]
        counts = np.bincount(sizes, minlength=capacity + 1)
        least = fewest(sizes, capacity)
        assert packing.least_sequences(counts, capacity) <= least
        simple = checked(packing.best_fit(counts, capacity), counts, capacity)
        assert checked(packing.complete(counts, capacity), counts, capacity) == least
        better += simple > least
    assert better  # best-fit decreasing alone would not do


def test_search_with_many_equal_lengths():
    rnd = random.Random(6)
    for _ in range(10):
        counts = np.zeros(2049, np.int64)
        for size in rnd.sample(range(1, 2049), 200):
            counts[size] = rnd.choice([1, 5, 1000, 10**9])
        found = checked(packing.complete(counts, 2048, 300), counts, 2048)
        assert found <= checked(packing.best_fit(counts, 2048), counts, 2048)
        assert found >= packing.least_sequences(counts, 2048)


def test_dominated_fillings_are_left_out():
    counts = np.zeros(101, np.int64)
    for size in (60, 40, 30, 25, 10, 5):
        counts[size] = 1
    # 40 fits beside 60 exactly and dominates all others, such as 30 + 10.
    assert packing.fillings(packing.Stock(counts), 100, 100) == [(60, 40)]
    counts[40] = 0
    found = packing.fillings(packing.Stock(counts), 100, 100)
    assert found[0] == (60, 30, 10) and (60, 10, 5) not in found and (60, 25, 5) not in found


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(8, 4) == [(0, 4), (4, 4)]


def test_character_classes_are_those_of_the_library():
    """The vocabulary's two libraries have regular expression engines of their own."""
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        plain = tiktoken.Encoding("x", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
        ours = set(bytes(plain.encode_ordinary(text)).decode())
        split = pre_tokenizers.Split(Regex(kind), "removed", invert=True)
        assert ours == {part for part, _ in split.pre_tokenize_str(text)}


@pytest.mark.parametrize("capacity", [64, 2048])
@pytest.mark.parametrize("extra", [False, True])
def test_pack_of_odd_rows(spark, given, capacity, extra):
    """Nulls, empty and very long texts, special tokens, repeated rows and ids, clashing names."""
    rows = [*odd_rows(), *given.items(), (400, "word " * 600_000)]
    df = documents(spark, rows, extra)
    if extra:
        for name in ("piece", "length", "part", "rank", "sequence_id", "offset"):
            df = df.selectExpr("*", f"'x' as {name}")
    out = packing.pack(df, PATH, "doc_id", capacity=capacity).collect()
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    want = []
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            crc = zlib.crc32(ids[start : start + length].tobytes())
            want.append((d, piece, start, length, crc))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in out)
    places = defaultdict(list)
    for r in out:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in out) // capacity)
    assert len(places) <= least + max(1, least // 100)


def test_pack_of_nothing(spark):
    df = documents(spark, [(1, "x")])
    assert packing.pack(df.limit(0), PATH, "doc_id").collect() == []
