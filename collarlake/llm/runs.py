"""Runs of repeated words, found in a grammar of each text.

A run is a stretch of consecutive words that has a smallest period, is at least four
periods (and six words) long, and cannot be extended to either side.

The numbers of a text's words are compressed by Re-Pair: pairs of neighbouring symbols
that occur repeatedly become nonterminals, the frequent ones first. Where pairs overlap, the more
frequent one is taken, so that many pairs are replaced in one pass; a pair that was
replaced before gets the same nonterminal again. What is left without repeated pairs is
joined in a balanced way, so that one nonterminal derives the whole text.

A run that is not within one side of the lowest nonterminal around it crosses its boundary.
So the runs that cross the boundary of a nonterminal are looked for once, at its first
place. Such a run has two periods on one side, that is, a square that ends or begins at the
boundary: periods to try are distances to equal pairs of words, and fingerprints of
stretches, checked on the words at last, give the run's ends. Runs of a nonterminal are
translated to all places where it was derived. A run that is cut off at the end of
a nonterminal lies in a longer one of the same period and is merged into it.

Texts are taken whole and in stretches of a few MB, a long one on its own. A text needs
some 300 bytes of a worker's memory for a word. No step grows with the square of a text: a
boundary has at most a quarter of its nonterminal's length of periods to try, of which
those at equal pairs of words are tried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from collarlake.llm.tables import importable

LEAST = 6
PERIODS = 4
STRETCH = 1 << 21
CANDIDATES = 1 << 20  # tried at once
KIND = "array<struct<start:bigint,length:bigint,period:bigint>>"

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525003)


class Grammar:
    """Nonterminals of a stretch of texts. By nonterminal: its first place, its boundary, its
    end. ``made`` and ``at``: every derivation, as nonterminal and place, of those of Re-Pair.

    ``words`` are the numbers of the words of all texts, ``text`` the number of each one's text.
    """

    def __init__(self, words: np.ndarray, text: np.ndarray) -> None:
        n = len(words)
        self.terminals = int(words.max()) + 1 if n else 0
        self.size = np.ones(self.terminals + n, np.int64)
        self.next = self.terminals
        self.first: list[np.ndarray] = []
        self.split: list[np.ndarray] = []
        self.made: list[np.ndarray] = []
        self.at: list[np.ndarray] = []
        self.rule_keys = np.zeros(0, np.int64)
        self.rule_ids = np.zeros(0, np.int64)
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None
        seq, pos, doc = words.astype(np.int64), np.arange(n), text.astype(np.int64)
        rest = []
        while len(seq):
            seq, pos, doc, done = self._replaced(seq, pos, doc)
            rest.append(done)
        if rest:
            seq, pos, doc = map(np.concatenate, zip(*rest, strict=True))
        while len(seq):
            seq, pos, doc = self._halved(seq, pos, doc)

    def _replaced(self, seq, pos, doc):
        """One pass of Re-Pair. Texts without a repeated pair are done."""
        places = np.flatnonzero(doc[1:] == doc[:-1])
        # A pair of symbols of one text as a number.
        bits = int(self.next).bit_length()
        key = (doc[places] - doc[0] << 2 * bits) | seq[places] << bits | seq[places + 1]
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.cumsum(fresh) - 1
        count = np.diff(np.flatnonzero(fresh), append=len(key))
        if self.pairs is None:
            self.pairs = places[order], group  # at first, symbols are words
        weight = np.where(count > 1, count * len(count) + np.arange(len(count)), 0)
        rank = np.zeros(len(seq) + 1, np.int64)  # of the pair that begins at a place, shifted
        rank[places[order] + 1] = weight[group]
        own = rank[1:]
        best = np.flatnonzero((own > 0) & (own >= rank[:-1]) & (own >= np.append(rank[2:], 0)))
        busy = np.zeros(int(doc[-1] - doc[0]) + 1, bool)
        busy[doc[best] - doc[0]] = True
        if len(best):
            # Neighbouring places are of one pair of equal symbols: every second is taken.
            begins = np.ones(len(best), bool)
            begins[1:] = np.diff(best) > 1
            head = np.maximum.accumulate(np.where(begins, np.arange(len(best)), 0))
            best = best[(np.arange(len(best)) - head) % 2 == 0]
            seq[best] = self._rules(seq[best], seq[best + 1], pos[best])
            self.made.append(seq[best])
            self.at.append(pos[best])
            keep = np.ones(len(seq), bool)
            keep[best + 1] = False
            seq, pos, doc = seq[keep], pos[keep], doc[keep]
        active = busy[doc - doc[0]]
        done = seq[~active], pos[~active], doc[~active]
        return seq[active], pos[active], doc[active], done

    def _rules(self, left, right, pos):
        """The nonterminals of pairs, new ones where a pair has none yet."""
        # Of a fixed width, since symbols become more.
        key, first, which = np.unique(left << 31 | right, return_index=True, return_inverse=True)
        slot = np.searchsorted(self.rule_keys, key)
        known = slot < len(self.rule_keys)
        known[known] = self.rule_keys[slot[known]] == key[known]
        ids = np.empty(len(key), np.int64)
        ids[known] = self.rule_ids[slot[known]]
        new = ~known
        ids[new] = self._add(left[first[new]], right[first[new]], pos[first[new]])
        self.rule_keys = np.insert(self.rule_keys, slot[new], key[new])
        self.rule_ids = np.insert(self.rule_ids, slot[new], ids[new])
        return ids[which]

    def _add(self, left, right, pos):
        ids = np.arange(self.next, self.next + len(left))
        self.size[ids] = self.size[left] + self.size[right]
        self.first.append(pos)
        self.split.append(pos + self.size[left])
        self.next += len(left)
        return ids

    def _halved(self, seq, pos, doc):
        """Join neighbours of a text, two by two; texts of one symbol are done."""
        heads = np.ones(len(doc), bool)
        heads[1:] = doc[1:] != doc[:-1]
        head = np.maximum.accumulate(np.where(heads, np.arange(len(doc)), 0))
        even = (np.arange(len(doc)) - head) % 2 == 0
        paired = np.append(even[:-1] & ~heads[1:], False)
        left = np.flatnonzero(paired)
        if not len(left):
            return seq[:0], pos[:0], doc[:0]
        seq = seq.copy()
        seq[left] = self._add(seq[left], seq[left + 1], pos[left])
        alone = heads & np.append(heads[1:], True)
        keep = even & ~alone
        return seq[keep], pos[keep], doc[keep]

    def nonterminals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place, boundary and end of each, from the first nonterminal on."""
        if not self.first:
            return (np.zeros(0, np.int64),) * 3
        first = np.concatenate(self.first)
        return first, np.concatenate(self.split), first + self.size[self.terminals : self.next]


class Prints:
    """Fingerprints of stretches of words, equal for equal stretches."""

    def __init__(self, words: np.ndarray) -> None:
        self.sums, self.powers = [], []
        n = len(words)
        for prime, base in zip(PRIMES, BASES, strict=True):
            power = np.ones(n + 1, np.int64)
            done, factor = 1, base % prime
            while done < n + 1:
                take = min(done, n + 1 - done)
                power[done : done + take] = power[:take] * factor % prime
                done, factor = done + take, factor * factor % prime
            # Numbers of words, scattered.
            value = (words.astype(np.int64) + 1) * 48271 % prime
            sums = np.zeros(n + 1, np.int64)
            np.cumsum(value * power[:n] % prime, out=sums[1:])
            self.sums.append(sums % prime)
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches from a and from b, which is further on, are equal."""
        equal = np.ones(len(a), bool)
        for prime, sums, power in zip(PRIMES, self.sums, self.powers, strict=True):
            x = (sums[a + length] - sums[a]) % prime * power[b - a] % prime
            equal &= x == (sums[b + length] - sums[b]) % prime
        return equal

    def before(self, a, b, most) -> np.ndarray:
        """How many words before a and before b are equal, ``most`` at most."""
        return self._longest(lambda k: self.same(a - k, b - k, k), most)

    def after(self, a, b, most) -> np.ndarray:
        return self._longest(lambda k: self.same(a, b, k), most)

    @staticmethod
    def _longest(holds, most) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low


def _expanded(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """begin, begin + 1, ... as often as counted, with the number of each one's row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)


def _in_chunks(count: np.ndarray) -> Iterator[slice]:
    """Rows such that their counts add up to about CANDIDATES."""
    ends = np.cumsum(count)
    begin = 0
    while begin < len(count):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + CANDIDATES, "right")))
        yield slice(begin, stop)
        begin = stop


def boundary_runs(words: np.ndarray, grammar: Grammar) -> list[np.ndarray]:
    """Runs within a nonterminal that cross its boundary: number of the nonterminal, start,
    end and period, at its first place."""
    first, split, end = grammar.nonterminals()
    wide = np.flatnonzero(end - first >= LEAST)
    if not len(wide) or grammar.pairs is None:
        return [np.zeros(0, np.int64)] * 4
    places, group = grammar.pairs
    slot = np.full(len(words) + 1, -1, np.int64)
    slot[places] = np.arange(len(places))
    width = len(words) + 1
    sorted_pairs = group * width + places
    first, split, end = first[wide], split[wide], end[wide]
    prints = None
    found = []
    for leftwards in (True, False):
        side = split - first if leftwards else end - split
        most = np.minimum(side // 2, (end - first) // PERIODS)
        anchor = split - 2 if leftwards else split
        rows = np.flatnonzero(side >= 3)
        mine = slot[anchor[rows]]
        # Equal pairs of words are side by side in the order of pairs; the next one is near
        # for few boundaries.
        other = np.clip(mine - 1 if leftwards else mine + 1, 0, len(places) - 1)
        apart = np.abs(places[other] - anchor[rows])
        near = (group[other] == group[mine]) & (other != mine) & (apart <= most[rows])
        rows, mine = rows[near], mine[near]
        if not len(rows):
            continue
        limit = anchor[rows] + (-most[rows] if leftwards else most[rows])
        reach = group[mine] * width + limit
        if leftwards:
            begin = np.searchsorted(sorted_pairs, reach, "left")
            count = mine - begin
        else:
            begin = mine + 1
            count = np.searchsorted(sorted_pairs, reach, "right") - begin
        if prints is None:
            prints = Prints(words)
        for part in _in_chunks(count):
            which, at = _expanded(begin[part], count[part])
            row = rows[part][which]
            q = np.abs(places[at] - anchor[row])
            p, b, e = first[row], split[row], end[row]
            if leftwards:
                inside = b - 2 - q >= p
                row, q, p, b, e = (x[inside] for x in (row, q, p, b, e))
                square = prints.same(b - 2 * q, b - q, q)
                row, q, p, b, e = (x[square] for x in (row, q, p, b, e))
                start = b - 2 * q - prints.before(b - 2 * q, b - q, b - 2 * q - p)
                stop = b + prints.after(b - q, b, e - b)
            else:
                inside = b + q + 2 <= e
                row, q, p, b, e = (x[inside] for x in (row, q, p, b, e))
                square = prints.same(b, b + q, q)
                row, q, p, b, e = (x[square] for x in (row, q, p, b, e))
                start = b - prints.before(b, b + q, b - p)
                stop = b + 2 * q + prints.after(b + q, b + 2 * q, e - b - 2 * q)
            long = (stop - start >= np.maximum(LEAST, PERIODS * q)) & (start < b) & (stop > b)
            found.append(np.stack([wide[row], start, stop, q])[:, long])
    if not found:
        return [np.zeros(0, np.int64)] * 4
    found = np.concatenate(found, axis=1)
    # Multiples of a run's period have the same ends.
    found = found[:, np.lexsort((found[3], found[2], found[1], found[0]))]
    same = np.zeros(found.shape[1], bool)
    same[1:] = (found[:3, 1:] == found[:3, :-1]).all(axis=0)
    return list(_checked(words, found[:, ~same]))


def _checked(words: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Runs whose words do have the period; fingerprints could be mistaken."""
    _, start, stop, q = found
    good = np.ones(found.shape[1], bool)
    count = stop - start - q
    for part in _in_chunks(count):
        which, at = _expanded(start[part], count[part])
        differ = words[at] != words[at + q[part][which]]
        good[part] = np.bincount(which, differ, minlength=part.stop - part.start) == 0
    if not good.all():
        raise ArithmeticError("two different stretches of words have the same fingerprints")
    return found


def runs_of(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Start, end and period of all runs of a stretch of texts, ordered by start and period."""
    grammar = Grammar(words, text)
    number, start, stop, q = boundary_runs(words, grammar)
    if not len(number):
        return np.zeros((3, 0), np.int64)
    first = grammar.nonterminals()[0]
    begin = start - first[number]
    length = stop - start
    # Every place where these nonterminals were derived.
    made = np.concatenate(grammar.made) - grammar.terminals if grammar.made else np.zeros(0, np.int64)
    at = np.concatenate(grammar.at) if grammar.at else made
    has = np.zeros(len(first), bool)
    has[number] = True
    keep = has[made]
    made, at = made[keep], at[keep]
    # Those of the balanced part have one place, their first.
    single = has.copy()
    single[made] = False
    single = np.flatnonzero(single)
    made, at = np.concatenate([made, single]), np.concatenate([at, first[single]])
    order = np.argsort(made, kind="stable")
    made, at = made[order], at[order]
    low, high = np.searchsorted(made, number, "left"), np.searchsorted(made, number, "right")
    which, slot = _expanded(low, high - low)
    start = at[slot] + begin[which]
    stop, q = start + length[which], q[which]
    # A run that lies in another of its period is a part of it.
    order = np.lexsort((-stop, start, q))
    start, stop, q = start[order], stop[order], q[order]
    width = len(words) + 1
    reached = np.maximum.accumulate(q * width + stop)  # of shorter periods: always less
    whole = np.ones(len(q), bool)
    whole[1:] = (q * width + stop)[1:] > reached[:-1]
    start, stop, q = start[whole], stop[whole], q[whole]
    order = np.lexsort((q, start))
    return np.stack([start, stop, q])[:, order]


def _stretch(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Runs of each text, and each text without what its runs repeat."""
    split = [text.split() for text in texts]  # at 0x20 and 0x09 to 0x0D
    counts = np.array([len(own) for own in split], np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    flat = pa.array(list(chain.from_iterable(split)), pa.binary())
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(split)), counts)
    start, stop, q = runs_of(words, text)
    dropped = np.zeros(len(words) + 1, np.int32)
    np.add.at(dropped, start + q, 1)
    np.add.at(dropped, stop, -1)
    dropped = np.cumsum(dropped) > 0
    owner = text[start] if len(start) else start
    ends = np.searchsorted(owner, np.arange(len(split) + 1))
    fields = [start - offsets[owner], stop - start, q]
    found = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()),
        pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in fields], names=["start", "length", "period"]
        ),
    )
    for i in np.unique(owner).tolist():
        gone = dropped[offsets[i] : offsets[i + 1]].tolist()
        split[i] = [word for word, out in zip(split[i], gone, strict=True) if not out]
    return found, pa.array([b" ".join(own) for own in split], pa.binary()).cast(pa.string())


def detect(
    df: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed"
) -> DataFrame:
    """``df`` without its column of texts, but with the runs of each text's words and the
    text without them.

    Words are what is between bytes 0x20 and 0x09 to 0x0D. ``runs`` is an array of start (number
    of a word), length and period, by start, then period. A word goes if any run
    contains it after that run's first period; ``collapsed`` has the others, joined by one space.
    A null, empty or blank text has no runs and an empty ``collapsed``. Repeated rows come
    back as often as they came; columns named like the two results are replaced.
    """
    importable(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name not in (text, runs, collapsed)]
    names = [f.name for f in fields]
    kinds = T.StructType.fromDDL(f"`{runs}` {KIND}, `{collapsed}` string").fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text).cast(pa.large_binary())
            at = 0
            while at < len(column):
                stop = _stop(column, at)
                texts = [t or b"" for t in column.slice(at, stop - at).to_pylist()]
                part = batch.slice(at, stop - at)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), *_stretch(texts)],
                    names=[*names, runs, collapsed],
                )
                at = stop

    return df.mapInArrow(run, T.StructType([*fields, *kinds]))


def _stop(column: pa.Array, at: int) -> int:
    """The end of a run of whole texts from ``at`` on, of at most STRETCH bytes; a longer text
    stands alone."""
    begin, size = at, 0
    while at < len(column):
        value = column[at]
        size += value.as_buffer().size if value.is_valid else 0
        if size > STRETCH and at > begin:
            break
        at += 1
    return at
