"""Byte-level BPE by last tokens along a trie, and its inverse.

The encoding of a text's prefix is known by its last token alone: that token's length tells
which shorter prefix comes before it. A token can be the last one exactly if the last
token before it and the token itself stay apart when the merges are run on the two, and
for each prefix this holds for just one of the tokens that it ends with. So a trie of words
is encoded by one walk, depth first: each node gets its last token from those of its
ancestors, and prefixes that words share are computed once.

The distinct words of a stretch of text are sorted, which puts them in the order of a
depth-first walk of their trie; the stack holds the states on the path to the current
node. A step back to where two words part is a cut of the stack. Tokens that a prefix ends
with come from an automaton over the vocabulary's bytes.

Merges are read from a tokenizer file; nothing is trained. Words already encoded by a task
are kept up to a bound, beyond which they are forgotten and encoded again.
"""

from __future__ import annotations

import json
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from collarlake.llm.tables import freed, importable

# How the file format splits texts, and how it writes bytes as characters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Below this code point the classes of the two regular expression engines agree.
AGREED = 0x250
STRETCH = 1 << 21
REMEMBERED = 150_000
PAIRS = 500_000
SCRIPT_RANGE = regex.compile(rf"[^\x00-\u{AGREED - 1:04x}]")


def byte_of_character() -> dict[str, int]:
    """The format writes bytes that do not print as the characters from 256 on."""
    rest = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}


def loaded(path: str) -> tuple[dict, dict[int, bytes], dict[str, int]]:
    """The model of a tokenizer file, the bytes of its tokens, and its special tokens."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    as_byte = byte_of_character()
    tokens = {i: bytes(as_byte[c] for c in t) for t, i in data["model"]["vocab"].items()}
    return data["model"], tokens, {t["content"]: t["id"] for t in data["added_tokens"]}


@lru_cache(maxsize=4)
def texts_of(path: str) -> list[bytes]:
    """The bytes of each token by id, all that decoding needs."""
    _, tokens, special = loaded(path)
    tokens |= {i: t.encode() for t, i in special.items()}
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


class Vocabulary:
    """Tokens, how they split, and which pairs of them may stand side by side."""

    def __init__(self, path: str) -> None:
        model, self.bytes_of, self.special = loaded(path)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b, c = (model["vocab"][t] for t in (left, right, left + right))
            self.rank[a, b] = rank
            if c not in self.parts:
                self.parts[c] = (a, b)
                self.made[c] = rank
        self.apart: dict[int, bool] = {}  # by pair, whether its tokens may stand side by side
        self._automaton()
        self.split = regex.compile(SPLIT)
        self.specials = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special))) + ")")
            if self.special
            else None
        )

    def _automaton(self) -> None:
        """States are prefixes of tokens; ``ends`` has the tokens that a state ends with,
        longest first, as (id, length)."""
        step: dict[int, int] = {}
        own: list[int | None] = [None]
        for i, token in self.bytes_of.items():
            state = 0
            for byte in token:
                key = state << 8 | byte
                if key not in step:
                    step[key] = len(own)
                    own.append(None)
                state = step[key]
            if self._keeps(i):
                own[state] = i
        children: list[list[tuple[int, int]]] = [[] for _ in own]
        for key, to in step.items():
            children[key >> 8].append((key & 255, to))
        back = [0] * len(own)
        ends: list[tuple] = [()] * len(own)
        queue = deque((to, byte, 0, 1) for byte, to in children[0])
        while queue:
            state, byte, parent, length = queue.popleft()
            if parent or length > 1:
                link = back[parent]
                while link and (link << 8 | byte) not in step:
                    link = back[link]
                back[state] = step.get(link << 8 | byte, 0)
            mine = ((own[state], length),) if own[state] is not None else ()
            ends[state] = mine + ends[back[state]]
            queue.extend((to, b, state, length + 1) for b, to in children[state])
        self.step, self.back, self.ends = step, back, ends

    def _keeps(self, token: int) -> bool:
        """Whether the merges make a token's own bytes into that token."""
        if token not in self.parts:
            return len(self.bytes_of[token]) == 1
        return self._fits(*self.parts[token], self.made[token])

    def _fits(self, a: int, b: int, below: int) -> bool:
        """Whether no merge across the seam of a and b comes before rank ``below``, and
        before the merges that make them: the merges are undone from the last one on, and
        the tokens at the seam may not merge at any moment when both are there."""
        rank, parts, made = self.rank, self.parts, self.made
        while True:
            # The merge of the seam would have to come before any later use of its sides.
            if (r := rank.get((a, b))) is not None and r < below:
                return False
            last_a, last_b = made.get(a, -1), made.get(b, -1)
            if last_a < 0 and last_b < 0:
                return True
            # Of equal ranks the left one is merged first, so the right one is undone first.
            if last_a > last_b:
                below = min(below, last_a)
                a = parts[a][1]
            else:
                below = min(below, last_b + 1)
                b = parts[b][0]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Token ids of each word, as little-endian 32-bit numbers."""
        step, back, ends, apart = self.step, self.back, self.ends, self.apart
        if len(apart) > PAIRS:
            apart.clear()
        seen = apart.get
        out = {}
        states, last, sizes = [0], [-1], [0]  # along the path, by depth
        before = b""
        for word in sorted(words):
            depth = _shared(word, before)
            del states[depth + 1 :], last[depth + 1 :], sizes[depth + 1 :]
            state = states[depth]
            for at, byte in enumerate(word[depth:], depth):
                while (to := step.get(state << 8 | byte)) is None and state:
                    state = back[state]
                state = to or 0
                for token, size in ends[state]:
                    if size > at:
                        break
                    key = last[at + 1 - size] << 20 | token
                    if (fits := seen(key)) is None:
                        fits = apart[key] = self._fits(key >> 20, token, 1 << 30)
                    if fits:
                        break
                else:
                    raise ValueError("the vocabulary has no token for a byte")
                states.append(state)
                last.append(token)
                sizes.append(size)
            ids = []
            at = len(word)
            while at:
                ids.append(last[at])
                at -= sizes[at]
            out[word] = array("I", ids[::-1]).tobytes()
            before = word
        return out


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    differ = int.from_bytes(a[:most], "big") ^ int.from_bytes(b[:most], "big")
    return most - (differ.bit_length() + 7) // 8


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts in stretches; remembers the words that it has met, up to a bound."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.vocabulary = vocabulary(path)
        self.known: dict[str, bytes] = {}
        self.library = None

    def words(self, text: str) -> list[str | int]:
        """A text's words in order; a special token stands as its id."""
        specials = self.vocabulary.specials
        if specials is None or "<" not in text:
            return self._plain(text)
        found: list[str | int] = []
        for i, part in enumerate(specials.split(text)):
            found += [self.vocabulary.special[part]] if i % 2 else self._plain(part)
        return found

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not SCRIPT_RANGE.search(text):
            return self.vocabulary.split.findall(text)
        if self.library is None:
            from tokenizers import Regex, pre_tokenizers

            self.library = pre_tokenizers.Split(Regex(SPLIT), "isolated")
        return [part for part, _ in self.library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [self.words(text) for text in texts]
        new = set(chain.from_iterable(words)).difference(self.known)
        plain = [word for word in new if type(word) is str]
        if len(self.known) > REMEMBERED:
            self.known = {}
            plain = [word for word in set(chain.from_iterable(words)) if type(word) is str]
        raw = [word.encode() for word in plain]
        ids = self.vocabulary.encode_words(raw)
        self.known.update(zip(plain, map(ids.__getitem__, raw), strict=True))
        for i in self.vocabulary.special.values():
            self.known[i] = array("I", [i]).tobytes()
        return [b"".join(map(self.known.__getitem__, own)) for own in words]


def _with_column(
    df: DataFrame, name: str, kind: T.DataType, leave: str | None
) -> tuple[T.StructType, list[str]]:
    fields = [f for f in df.schema.fields if f.name not in (name, leave)]
    return T.StructType([*fields, T.StructField(name, kind)]), [f.name for f in fields]


def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep_text: bool = True
) -> DataFrame:
    """``df`` with the token ids of a column of texts, packed as little-endian unsigned
    32-bit numbers.

    ``path`` is a tokenizer file that every worker can open. Special tokens that a text
    contains become their ids, as the file format's library does by default. A null or
    empty text has no ids. A column named like ``ids`` is replaced. ``keep_text`` False leaves
    the texts out, which saves their way back from the workers.
    """
    importable(df.sparkSession)
    schema, names = _with_column(df, ids, T.BinaryType(), None if keep_text else text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            column, at = batch.column(text), 0
            while at < len(column):
                stop = _stop(column, at)
                found = encoder.encode([t or "" for t in column.slice(at, stop - at).to_pylist()])
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(found, pa.binary())],
                    names=[*names, ids],
                )
                at = stop

    return df.mapInArrow(freed(run), schema)


def _stop(column: pa.Array, at: int) -> int:
    """The end of a run of whole texts from ``at`` on, of about STRETCH bytes."""
    size = 0
    while at < len(column) and size < STRETCH:
        value = column[at]
        size += value.as_buffer().size if value.is_valid else 0
        at += 1
    return at


def decode(
    df: DataFrame, path: str, ids: str = "ids", text: str = "decoded", keep_ids: bool = True
) -> DataFrame:
    """``df`` with the text of a column of packed ids, special tokens as they are written.
    Bytes that are no UTF-8 become replacement characters. Null ids have a null text; an id
    that the vocabulary lacks adds nothing. A column named like ``text`` is replaced."""
    importable(df.sparkSession)
    schema, names = _with_column(df, text, T.StringType(), None if keep_ids else ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = texts_of(path)
        for batch in batches:
            found = []
            for value in batch.column(ids):
                if not value.is_valid:
                    found.append(None)
                    continue
                own = array("I")
                own.frombytes(value.as_buffer())
                if own and max(own) >= len(table):
                    own = [i for i in own if i < len(table)]
                found.append(b"".join(map(table.__getitem__, own)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(found, pa.string())],
                names=[*names, text],
            )

    return df.mapInArrow(freed(run), schema)
