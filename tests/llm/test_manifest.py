"""The Merkle manifest against trees built plainly."""

from __future__ import annotations

from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from collarlake.llm import merkle
from tests.llm.data import documents, odd_rows

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*values):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """All levels, from the leaves to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        runs = [below[i : i + 3] for i in range(0, len(below), 3)]
        levels.append([sha256("".join(run).encode()).hexdigest() for run in runs])
    return levels


def way(levels, at):
    found = []
    for level in levels[:-1]:
        first = at - at % 3
        found.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return found


def plain(rows, altered):
    """Per row: (doc_id, leaf, subroot, root, siblings, folded)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    first = lambda x: (x is not None, x or 0)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (first(r[0]), h(*r)))
        trees[name] = tree([h(*r) for r in groups[name]])
    upper = tree([trees[name][-1][0] for name in names])
    out = []
    for i, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = way(trees[name], at) + way(upper, i)
            node = h(*altered(row))
            for left, right in steps:
                node = sha256("".join([*left, node, *right]).encode()).hexdigest()
            siblings = "".join(x for left, right in steps for x in (*left, *right))
            subroot = trees[name][-1][0]
            out.append((row[0], h(*row), subroot, upper[-1][0], siblings, node))
    return out


def made(df, altered=None, **more):
    out = merkle.manifest(df, "source", "doc_id", FIELDS, altered, **more)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof", "shape", "folded"]
    return [
        (r.doc_id, *(x.hex() for x in (r.leaf, r.subroot, r.root, r.proof, r.folded)))
        for r in out.collect()
    ]


def key(row):
    return tuple((x is not None, x) for x in row)


def rows_of(df):
    return [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in df.select(*FIELDS).collect()]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_manifest_equals_plain_trees(spark, depth):
    """Also in blocks so small that there are several layers of them; one source has most rows."""
    texts = [(i * 7919 % 1000, f"text {i}\nline", "hot" if i % 3 else f"s{i % 5}") for i in range(100)]
    df = documents(spark, texts)
    cut = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    want = plain(rows_of(df), lambda r: (*r[:4], r[4].replace("\n", "") if r[0] % 2 == 0 else r[4]))
    assert sorted(made(df, {"text": cut}, depth=depth)) == sorted(want)


@pytest.mark.parametrize("extra", [False, True])
def test_manifest_of_odd_rows(spark, extra):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [(d, t, s) for (d, t), s in zip(odd_rows(), ["a", None, "", "é", "Z", "aa"] * 9, strict=False)]
    rows += [(1, "A" * 3_000_000, "a"), (1, "other text of the same id", "a")]
    df = documents(spark, rows, extra).withColumn("lang", F.when(F.col("doc_id") > 3, "x"))
    if extra:
        for name in ("leaf", "root", "proof", "__group", "__pos", "__node"):
            df = df.withColumn(name, F.lit("y"))
    assert sorted(made(df), key=key) == sorted(plain(rows_of(df), lambda r: r), key=key)


def test_manifest_of_few_rows(spark):
    df = documents(spark, [(1, "one", "a")])
    (row,) = made(df)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == ""
    assert made(df.limit(0)) == []


def test_versions_share_what_they_do_not_copy():
    leaves = [bytes([i]) * 32 for i in range(100)]
    block = merkle.Block(leaves, False, 6)
    before = [list(level) for level in block.levels]
    copied = block.version(17, b"x" * 32)
    assert len(copied) == len(block.levels) and block.levels == before
    again = merkle.Block([*leaves[:17], b"x" * 32, *leaves[18:]], False, 6)
    assert copied[-1] == again.root != block.root
    levels = zip(block.levels, again.levels, strict=True)
    differ = sum(x != y for a, b in levels for x, y in zip(a, b, strict=True))
    assert differ == len(copied)
    assert merkle.climbed(b"x" * 32, *block.way(17)) == again.root
