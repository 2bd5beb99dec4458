"""Encoding, line and near duplicates, token counts."""

from __future__ import annotations

import hashlib
import random
from array import array

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as hypothesis_given
from hypothesis import settings
from hypothesis import strategies as st

from collarlake.llm import bpe, linededup, neardup, queries, tokencounts, words
from collarlake.llm.queries import tokenizer
from parity import compare
from tests.llm.data import ODD_TEXTS, SF, documents, groups, odd_rows

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}


def unpacked(ids: bytes) -> list[int]:
    out = array("I")
    out.frombytes(ids)
    return out.tolist()


# ---- encoding


def test_bpe_of_documents(spark, given, library):
    found = queries.op1_bpe(spark, SF).collect()
    assert len(found) == len(given)
    for row in found:
        ids = library[BYTES].encode(given[row.doc_id], add_special_tokens=False).ids
        text = library[BYTES].decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_of_odd_rows(spark, library):
    rows = odd_rows()
    docs = documents(spark, rows, extra=True).withColumnRenamed("digest", "ids")
    found = bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()
    assert len(found) == len(rows)
    for row in found:
        want = library[BYTES].encode(row.text or "", add_special_tokens=False).ids
        assert unpacked(row.ids) == want and row.decoded == (row.text or "")
    empty = bpe.decode(bpe.encode(docs.limit(0), BYTES), BYTES)
    assert empty.count() == 0 and "decoded" in empty.columns


@settings(max_examples=60, deadline=None)
@hypothesis_given(st.lists(st.text(alphabet="abcdehinst 's.\n\t012éß日́😀<|>", max_size=60), max_size=20))
def test_bpe_equals_the_library(library, texts):
    own = [unpacked(x) for x in bpe.Encoder(BYTES).encode(texts)]
    assert own == [e.ids for e in library[BYTES].encode_batch(texts, add_special_tokens=False)]


def test_bpe_forgets_words(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    encoder, source = bpe.Encoder(BYTES), random.Random(1)
    for _ in range(5):
        texts = [" ".join(source.choice("thing sting string sing ring".split()) for _ in range(30))]
        texts += ["".join(source.choice("abcdef ") for _ in range(200))]
        want = [e.ids for e in library[BYTES].encode_batch(texts, add_special_tokens=False)]
        assert [unpacked(x) for x in encoder.encode(texts)] == want


def test_decoding_of_foreign_ids(spark):
    df = spark.createDataFrame([(array("I", [70_000, 64]).tobytes(),), (None,), (b"",)], "ids binary")
    assert [r.decoded for r in bpe.decode(df, BYTES).collect()] == ["a", None, ""]


# ---- token counts


def test_counts_of_documents(spark, given, library):
    for row in queries.op10_token_counts(spark, SF).collect():
        n = len(library[WORDS].encode(given[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes) == (n, len(given[row.doc_id].encode()))
        assert row.over_limit == (n > 2048)


def test_counts_are_stored(spark, library, tmp_path):
    rows = [*odd_rows(), (300, "İstanbul ΣΑΣ ǅ ﬁ ① ½ don't WE'LL"), (301, "a  b\n\nc"), (302, "a b c")]
    docs = documents(spark, rows, extra=True).withColumnRenamed("digest", "n_tokens")
    cache = f"file://{tmp_path}/cache"
    for part in (docs.limit(5), docs, docs, docs.limit(0)):
        found = tokencounts.counted(part, WORDS, cache).collect()
        assert len(found) == part.count()
        texts = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
        for row in found:
            if row.doc_id is not None:
                ids = library[WORDS].encode(texts[row.doc_id] or "", add_special_tokens=False).ids
                assert row.n_tokens == len(ids), texts[row.doc_id]
    stored = spark.read.parquet(cache)
    # One count per distinct content; texts that differ in white space share it.
    assert stored.count() == stored.select("digest").distinct().count()
    assert stored.count() < len(rows) - 5


@settings(max_examples=60, deadline=None)
@hypothesis_given(st.lists(st.text(alphabet="abIĲſßẞÅÉé'sllT 09½①.,-\ńİ日", max_size=40), max_size=10))
def test_counts_equal_the_library(library, texts):
    want = [len(e.ids) for e in library[WORDS].encode_batch(texts, add_special_tokens=False)]
    assert tokencounts.Counter(WORDS).count(texts) == want


# ---- lines


def test_line_dedup_equals_sql(spark):
    connection = compare.connect(SF)
    sql = queries.ORACLES["op2_line_dedup"]
    assert compare.differences(queries.op2_line_dedup(spark, SF), connection, sql) == []


def test_line_dedup_cases(spark):
    rows = [
        (1, "a\nb\nc\nd"),
        (2, "x\na\nb\nc\nd\ny"),
        (3, "a\nb"),
        (4, None),
        (5, ""),
        (6, "q\nr\ns\nq\nr\ns"),
        (7, "a\nb\nc"),
        (8, "\n\n\n\n"),
        (9, "\n\n\n\n"),
        (None, "a\nb\nc\nz"),
        (10, "m\nn\no"),
        (10, "m\nn\no"),
    ]
    docs = documents(spark, rows, extra=True)
    found = linededup.dedup_lines(docs, count="gone")
    assert found.columns == [*docs.columns, "gone"]
    got = sorted(((r.doc_id or 99, r.text, r.gone) for r in found.collect()), key=str)
    want = [
        (1, "a\nb\nc\nd", 0),
        (2, "x\ny", 4),
        (3, "a\nb", 0),
        (4, None, 0),
        (5, "", 0),
        (6, "q\nr\ns", 3),
        (7, "", 3),
        (8, "\n\n\n\n", 0),
        (9, "\n\n\n\n", 0),
        (99, "z", 3),
        (10, "m\nn\no", 0),
        (10, "m\nn\no", 0),
    ]
    assert got == sorted(want, key=str)
    assert linededup.dedup_lines(docs.limit(0)).count() == 0
    assert linededup.dedup_lines(documents(spark, odd_rows())).count() == len(odd_rows())


# ---- near duplicates


def as_groups(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_near_dedup_of_documents(spark, given):
    assert as_groups(queries.op3_near_dedup(spark, SF)) == groups(given)


def test_near_dedup_of_planted_groups(spark):
    """Chains, large groups of near copies, copies, and short texts, with shared passages."""
    source = random.Random(3)
    new = lambda n: [f"w{source.randrange(10**6)}" for _ in range(n)]
    texts, passage = [], new(60)
    base = new(120)
    for _ in range(120):  # near copies of one text
        copy = list(base)
        for at in source.sample(range(120), source.randrange(4)):
            copy[at] = new(1)[0]
        texts.append(copy)
    step = new(200)
    for _ in range(12):  # a chain: neighbours are linked, its ends are not
        step = step[12:] + new(12)
        texts.append(step)
    texts += [passage + new(source.randrange(20, 200)) for _ in range(60)]
    texts += [new(source.randrange(1, 12)) for _ in range(60)]
    texts += [base] * 30 + [["one"], ["one"], ["a", "b"], ["A", "b"]]
    source.shuffle(texts)
    rows = {i: " ".join(t) for i, t in enumerate(texts)} | {9000: None, 9001: "", 9002: " \n"}
    docs = documents(spark, rows.items(), extra=True)
    assert as_groups(neardup.grouped(docs)) == groups(rows)
    kept = neardup.dedup(docs)
    assert kept.columns == docs.columns
    heads = {d for d, (_, least) in groups(rows).items() if d == least}
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(heads)


def test_near_dedup_of_odd_rows(spark):
    rows = odd_rows()
    found = neardup.grouped(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    assert all(r.kept and r.component_id is None for r in found if r.doc_id is None)
    assert {r.component_id for r in found if r.doc_id in range(100, 105)} == {100}
    assert neardup.grouped(documents(spark, rows).limit(0)).count() == 0
    assert neardup.dedup(documents(spark, rows)).count() == len(rows) - 4 - 1


def test_near_dedup_of_ids_with_several_texts(spark):
    a, b, c, d = (" ".join(f"{letter}{i}" for i in range(40)) for letter in "abcd")
    near = b.rsplit(" ", 1)[0] + " end"
    rows = [(3, a), (5, a), (5, b), (9, near), (20, c), (21, c), (21, ""), (21, None)]
    rows += [(30, d), (30, "some other words"), (40, ""), (40, None), (41, "a b"), (41, "a b")]
    docs = documents(spark, rows)
    found = neardup.grouped(docs).collect()
    least = {3: 3, 5: 3, 9: 3, 20: 20, 21: 20, 30: 30, 40: 40, 41: 41}
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == set(least.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert sorted(r.doc_id for r in neardup.dedup(docs).collect()) == sorted(set(least.values()))


def test_signature_estimates_similarity():
    source = np.random.default_rng(2)
    both, a, b = (source.integers(0, 1 << 62, n).astype(np.uint64) for n in (300, 50, 50))
    x, y = (neardup.super_min_hash(np.concatenate([both, own])) for own in (a, b))
    assert abs((x == y).mean() - 300 / 400) < 0.12
    ranks = np.sort(np.floor(neardup.super_min_hash(a[:1])))
    assert ranks.tolist() == list(range(neardup.COMPONENTS))


def test_signature_does_not_depend_on_blocks(monkeypatch):
    elements = words.randoms(5, 0, 1000)
    whole = neardup.super_min_hash(elements)
    monkeypatch.setattr(neardup, "ELEMENTS", 7)
    assert (neardup.super_min_hash(elements) == whole).all()


@settings(max_examples=60, deadline=None)
@hypothesis_given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ \t\n\x0b\x0c\r\x85é", max_size=30)), max_size=12))
def test_word_hashes(texts):
    from tests.llm.data import words as plain

    for block in (1, 3, 1 << 20):
        words.BLOCK, kept = block, words.BLOCK
        hashes, starts = words.word_hashes(*words.text_bytes(pa.array(texts, pa.string())))
        words.BLOCK = kept
        want = [plain(t) for t in texts]
        assert np.diff(starts).tolist() == [len(w) for w in want]
        names = dict(zip(hashes.tolist(), (w for own in want for w in own), strict=True))
        assert [names[h] for h in hashes.tolist()] == [w for own in want for w in own]
        assert len(set(names.values())) == len(names)


def test_word_hashes_of_long_words():
    text = "x" * (words.PLACES + 7)
    hashes, starts = words.word_hashes(*words.text_bytes(pa.array([f"{text} {text}y {text}", *ODD_TEXTS])))
    assert starts[1] == 3 and hashes[0] == hashes[2] != hashes[1]
