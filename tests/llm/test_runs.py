"""Runs of repeated words against a comparison of all distances."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from collarlake.llm import queries, runs
from tests.llm.data import WORD, documents, odd_rows


def all_runs(words):
    """(start, length, period) of all runs, by comparing the words at every distance."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            begin = i
            while i < len(words) - q and words[i] == words[i + q]:
                i += 1
            if i > begin and i + q - begin >= max(6, 4 * q):
                found.setdefault((begin, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rnd):
    words = [rnd.randrange(rnd.choice([1, 2, 2, 3, 20])) for _ in range(rnd.choice([0, 1, 5, 40, 200]))]
    while words and len(words) < 400 and rnd.random() < 0.6:
        at = rnd.randrange(len(words))
        part = words[at : at + rnd.choice([1, 2, 3, 5, 8, 20])]
        words = words[:at] + part * rnd.randint(2, 9) + words[at:]
    return words


def by_text(texts):
    sizes = [len(t) for t in texts]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.array([w for t in texts for w in t], np.int64)
    out = [[] for _ in texts]
    for s, e, q in runs.runs_of(flat, np.repeat(np.arange(len(texts)), sizes)).T.tolist():
        own = int(np.searchsorted(begin, s, "right")) - 1
        while not sizes[own]:
            own -= 1
        out[own].append((s - int(begin[own]), e - s, q))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_comparison_of_all_distances(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        texts = [random_words(rnd) for _ in range(rnd.randint(1, 10))]
        assert by_text(texts) == [all_runs(t) for t in texts]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_long_repetitive_texts():
    for words in ([0] * 3000, [0, 1] * 1500, fibonacci(2000), ([0] * 9 + [1]) * 200, [*range(40)] * 30):
        assert by_text([words]) == [all_runs(words)]
    # Much longer ones are quick too.
    assert by_text([[0] * 300_000, [0, 1, 2] * 100_000]) == [[(0, 300_000, 1)], [(0, 300_000, 3)]]


def test_every_nonterminal_derives_its_words():
    rnd = random.Random(9)
    texts = [random_words(rnd) for _ in range(30)]
    flat = np.array([w for t in texts for w in t], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    grammar = runs.Grammar(flat, text)
    first, split, end = grammar.nonterminals()
    assert ((first < split) & (split < end)).all() and (text[first] == text[end - 1]).all()
    for number, at in zip(np.concatenate(grammar.made), np.concatenate(grammar.at), strict=True):
        own = number - grammar.terminals
        width = end[own] - first[own]
        assert (flat[first[own] : end[own]] == flat[at : at + width]).all()
    # The whole of each text is derived by one of them.
    begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    sizes = np.diff(begins, append=len(flat))
    whole = {(int(f), int(e - f)) for f, e in zip(first, end, strict=True)}
    assert all((int(b), int(n)) in whole for b, n in zip(begins, sizes, strict=True) if n > 1)


@pytest.mark.parametrize("extra", [False, True])
def test_detect_of_odd_rows(spark, extra):
    """Nulls, empty and very long texts, ties, repeated rows, other white space, clashing names."""
    rows = [*odd_rows(), (300, "la " * 400_000), (301, "ab cd " * 300_000 + "x"), (302, " \x0b".join("a" * 9))]
    df = documents(spark, rows, extra)
    out = runs.detect(df).collect()
    assert len(out) == len(rows)
    assert set(out[0].asDict()) == set(df.columns) - {"text"} | {"runs", "collapsed"}
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in out), key=str)
    want = []
    for d, t in rows:
        words = WORD.findall(t or "")
        found = {300: [(0, 400_000, 1)], 301: [(0, 600_000, 2)]}.get(d) or all_runs(words[:9000])
        want.append((d, found, kept(words, found)))
    assert got == sorted(want, key=str)
    assert runs.detect(df.limit(0)).collect() == []


def test_query_on_given_documents(spark, given):
    got = {r.doc_id: r for r in queries.op12_runs(spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == set(given)
    from hashlib import sha256

    changed = 0
    for d, t in given.items():
        words = WORD.findall(t or "")
        h = zlib.crc32(str(d).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            changed += 1
        found = all_runs(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        row = got[d]
        assert row.n_runs == len(found)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        assert row.runs_sha256 == sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == sha256(kept(words, found).encode()).hexdigest()
    assert changed and any(r.n_runs for r in got.values())
