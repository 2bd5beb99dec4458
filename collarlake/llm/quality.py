"""A quality classifier from trusted positives and unlabelled text.

Positive-unlabelled learning: with f the log odds, l the logistic loss and p the prior of
good documents, the risk is p E_pos[l(f)] + max(0, E_all[l(-f)] - p E_pos[l(-f)]). The second
part estimates the loss on bad documents without seeing any; it cannot be negative, and
where its estimate gets negative the step goes back up (non-negative risk). Labelled
documents of bad quality are not used at all.

The prior is estimated from the positives and all texts. Half of the positives make a linear
ranking; above any score t, the share of all documents is at least p times that of the good
ones, which the other half of the positives shows. The least ratio of the two shares, where
both are known well enough, is the estimate.

Features do not depend on the language: frequencies of pairs of character classes, and how
much words, their pairs and triples, and lines repeat. A pass over the texts turns each
into about 140 bytes. Learning reads only those, all of them: each step is a job that sums
gradient and curvature over all documents in Spark, and returns sums of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collarlake.llm.tables import Saved, freed, importable
from collarlake.llm.words import mix, text_bytes, word_hashes

STEPS = 12
RIDGE = 5.0  # strength of the pull to zero, as a number of documents
LIMIT = 10.0
BINS = 1000
DOUBT = 0.1  # chance that a share is further from the truth than the estimate allows for

# Classes of bytes. 0 is lower case and what is not named here.
CLASSES = [
    bytes(range(ord("A"), ord("Z") + 1)),
    b"0123456789",
    b" \t",
    b"\n\r\v\f",
    b".",
    b",;:",
    b"!?",
    b"'\"-()",
    b"|/\\<>[]{}_=+~`^",
    b"*&%$#@",
    bytes(range(0x80, 0x100)),
]
CLASS_OF = np.zeros(256, np.uint8)
for number, members in enumerate(CLASSES, 1):
    CLASS_OF[list(members)] = number
KINDS = len(CLASSES) + 1
SHAPES = 13
FEATURES = KINDS * KINDS + SHAPES
PIECE = 1 << 20
SHORT = 100


def _repeated(hashes: np.ndarray) -> float:
    return 1.0 - len(np.unique(hashes)) / len(hashes) if len(hashes) else 0.0


def _squash(x: float, half: float) -> float:
    return x / (x + half)


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES bytes per text, all from the whole text."""
    data, offsets = text_bytes(column)
    words, starts = word_hashes(data, offsets)
    out = np.zeros((len(column), FEATURES), np.uint8)
    for row in range(len(column)):
        own = data[offsets[row] : offsets[row + 1]]
        if not len(own):
            continue
        pairs = np.zeros(KINDS * KINDS)
        for at in range(0, len(own), PIECE):  # pieces overlap in a byte
            kind = CLASS_OF[own[at : at + PIECE + 1]].astype(np.int64)
            pairs += np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS * KINDS)
        share = np.sqrt(pairs / (len(own) + SHORT))  # a short text's shares say less
        w = words[starts[row] : starts[row + 1]]
        two = mix(w[:-1] * np.uint64(3)) + w[1:]
        three = mix(two[:-1]) + w[2:]
        ends = np.flatnonzero(own == 10)
        bounds = np.concatenate([[0], ends + 1, [len(own)]])
        lengths = np.diff(bounds)
        # A line's hash: bytes times odd numbers by their place in the line.
        place = np.arange(len(own)) - np.repeat(bounds[:-1], lengths)
        value = (own.astype(np.uint64) + np.uint64(1)) * mix(place.astype(np.uint64))
        sums = np.add.reduceat(value, bounds[:-1][lengths > 0])
        counts = np.unique(w, return_counts=True)[1] if len(w) else np.zeros(1)
        shape = [
            _squash(len(w), 100),
            _squash(len(own) / max(1, len(w)), 6),
            _repeated(w),
            _repeated(w) * _squash(100, len(w)),
            _repeated(two),
            _repeated(three),
            counts.max() / max(1, len(w)),
            np.sort(counts)[-3:].sum() / max(1, len(w)),
            _squash(len(ends), 5),
            _squash(len(own) / len(lengths), 100),
            _repeated(sums),
            float(len(own) < 100),
            _squash(len(own), 1000),
        ]
        out[row] = np.round(255 * np.clip(np.concatenate([share, shape]), 0, 1))
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), _binary(features(batch.column("text")))],
            names=["doc_id", "x"],
        )


def featurised(docs: DataFrame) -> DataFrame:
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(freed(_featurise), "doc_id long, x binary")


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    """The features of a batch, between 0 and 1."""
    flat = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8)
    return flat.reshape(-1, FEATURES) / 255.0


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(f, -500, 500)))


def _sums(x: DataFrame, function, flag: str = "positive") -> np.ndarray:
    """Add up, in Spark, the vector that ``function`` gives for each batch of features, with
    the flags of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = function(_rows(batch), np.asarray(batch.column(flag).to_pylist(), bool))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], names=["k", "v"]
            )

    parts = x.select("x", flag).mapInArrow(run, "k long, v double")
    # As many numbers as ``function`` gives for a batch, however many batches there are.
    found = {row.k: row.v for row in parts.groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return np.array([found[k] for k in range(len(found))])


@dataclass
class Model:
    """Weights of standardised features. Values far from the mean count as LIMIT deviations:
    a rare pair of characters alone decides nothing."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -LIMIT, LIMIT)
        return np.hstack([z, np.ones((len(z), 1))])

    def of(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.standard(x) @ self.weights)

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.of(features(column) / 255.0)


def trusted(labels: DataFrame, allowed: Column) -> DataFrame:
    """(doc_id, good) for labelled documents that may be learnt from."""
    return labels.where(allowed & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("good")
    )


def _ranking(rows: DataFrame, model: Model) -> np.ndarray | None:
    """Weights that rank the first half of the positives above all documents: one Newton
    step of the logistic loss. None without positives in that half."""

    def sums(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
        z = model.standard(x)
        zp = z[pos]
        return np.concatenate([z.sum(axis=0), zp.sum(axis=0), (z.T @ z).ravel(), (zp.T @ zp).ravel()])

    total = _sums(rows, sums, "first")
    size = FEATURES + 1
    every, good = total[:size], total[size : 2 * size]
    n, n_good = every[-1], good[-1]
    if not n_good:
        return None
    curve, curve_good = total[2 * size :].reshape(2, size, size)
    ridge = RIDGE / n_good * np.append(np.ones(size - 1), 1e-6) + 1e-6
    return np.linalg.solve((curve / n + curve_good / n_good) / 8 + np.diag(ridge), (good / n_good - every / n) / 4)


def least_ratio(every: np.ndarray, good: np.ndarray) -> float:
    """The prior from the counts of all documents and of good ones by rising score: the ratio
    of their shares above the score where it is least, with what chance may add to it."""
    n, n_good = every.sum(), good.sum()
    share, share_good = np.cumsum(every[::-1]) / n, np.cumsum(good[::-1]) / n_good
    chance = np.sqrt(np.log(4 / DOUBT) / 2)
    most = np.full(len(share), np.inf)
    met = share_good > 0
    most[met] = (share[met] + chance * (n**-0.5 + n_good**-0.5)) / share_good[met]
    at = int(most.argmin())
    return float(np.clip(share[at] / share_good[at], 1 / (n + 2), 1 - 1 / (n + 2)))


def _prior(rows: DataFrame, model: Model) -> float:
    ranking = _ranking(rows, model)
    if ranking is None:
        return model.prior

    def sums(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
        score = _sigmoid(model.standard(x) @ ranking)
        counts = [np.histogram(part, BINS, (0, 1))[0] for part in (score, score[pos])]
        return np.concatenate(counts).astype(np.float64)

    every, good = _sums(rows, sums, "second").reshape(2, BINS)
    return least_ratio(every, good) if good.sum() else model.prior


def fit(x: DataFrame, labels: DataFrame, saved: Saved, steps: int = STEPS) -> Model:
    """Learn from ``x`` (doc_id, x), all documents, and ``labels`` (doc_id, good).

    Only documents with good = 1 are used; they should be like other good documents. Without
    positives or without documents the score is 0.5 for all; the prior is 0.5 if a half of
    the positives is empty.
    """
    model = Model(np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES + 1), 0.5)
    good = labels.where("good = 1").select("doc_id", F.lit(True).alias("positive"))
    positive = F.coalesce("positive", F.lit(False))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    rows = saved.write(
        x.join(good, "doc_id", "left").select(
            "x",
            positive.alias("positive"),
            (positive & half).alias("first"),
            (positive & ~half).alias("second"),
        ),
        "learn",
    )
    moments = _sums(
        rows,
        lambda x, pos: np.concatenate([[len(x), pos.sum()], x.sum(axis=0), (x * x).sum(axis=0)]),
    )
    if not len(moments) or not moments[1]:
        return model
    n, n_pos = moments[:2]
    model.mean = moments[2 : 2 + FEATURES] / n
    spread = np.sqrt(np.maximum(moments[2 + FEATURES :] / n - model.mean**2, 0))
    model.scale = np.where(spread > 1e-3, 1 / np.maximum(spread, 1e-3), 0.0)
    prior = model.prior = _prior(rows, model)
    model.weights[-1] = np.log(prior / (1 - prior))
    size = FEATURES + 1

    def at(w: np.ndarray):
        def sums(x: np.ndarray, pos: np.ndarray) -> np.ndarray:
            z = model.standard(x)
            f = z @ w
            s = _sigmoid(f)
            up = np.logaddexp(0, f)  # l(-f)
            down = up - f  # l(f)
            zp, sp = z[pos], s[pos]
            return np.concatenate(
                [
                    [up.sum(), up[pos].sum(), down[pos].sum()],
                    z.T @ s,
                    zp.T @ sp,
                    zp.sum(axis=0),
                    ((z * (s * (1 - s))[:, None]).T @ z).ravel(),
                ]
            )

        return _sums(rows, sums)

    w = model.weights
    ridge = RIDGE / n_pos * np.append(np.ones(size - 1), 1e-6)
    best, best_risk = w, np.inf
    for _ in range(steps):
        total = at(w)
        up, up_pos, down_pos = total[0] / n, total[1] / n_pos, total[2] / n_pos
        g_up = total[3 : 3 + size] / n
        g_up_pos = total[3 + size : 3 + 2 * size] / n_pos
        z_pos = total[3 + 2 * size : 3 + 3 * size] / n_pos
        curve = total[3 + 3 * size :].reshape(size, size) / n + np.diag(ridge + 1e-6)
        bad = up - prior * up_pos
        risk = prior * down_pos + max(bad, 0.0) + 0.5 * float(ridge @ (w * w))
        if risk < best_risk:
            best, best_risk = w, risk
        if bad >= 0:
            gradient = prior * (g_up_pos - z_pos) + g_up - prior * g_up_pos + ridge * w
        else:
            gradient = -(g_up - prior * g_up_pos)
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 4.0 / max(float(np.abs(step).max()), 1e-9))
        if float(np.abs(step).max()) < 1e-3:
            break
        w = w - step
    saved.drop([rows])
    model.weights = best
    return model


def scored(x: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) from (doc_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.of(_rows(batch)))],
                names=["doc_id", "score"],
            )

    return x.mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents with a score of ``least`` or more, with all their columns. A null text
    is scored as an empty one."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column("text")) >= least))

    return docs.mapInArrow(freed(run), docs.schema)
