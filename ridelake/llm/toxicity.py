"""Operator 6: toxicity by non-negative positive-unlabelled learning.

The learner sees confirmed toxic documents (P) and unlabelled text (U: every row of the
training fold, whatever its label, which it doesn't look at). With the class prior
``pi`` the risk of a scorer f under the logistic loss l is

    pi * E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi * E_P[l(f, -)])

whose second term, the corrected risk on negatives, is kept from going below
zero: where it would, only the confirmed examples pull. ``pi`` is the
share of toxic labels among all labels of the training fold, counted over all
of them. A document is the set of its words and of their first letters (which
catches inflected forms), hashed into ``BUCKETS``; a linear scorer in numpy learns
a weight for each bucket that at least ``LEAST_SUPPORT`` confirmed documents hold,
and ``LEAST_LIFT`` times as large a share of them as of the unlabelled ones.

Only the confirmed examples are a bounded sample (at most ``POSITIVES`` labelled ids,
chosen by hash). All unlabelled text is read: one pass counts the buckets, one turns
each document into the set of its kept buckets, of which the distinct ones
are written with their numbers of documents, which is all the risk needs. Each step of
the fit is a pass over that table, in which every task returns its part of risk
and gradient (for at most ``BUCKETS`` weights); with a weight decay the unclamped risk
is convex, so L-BFGS needs a few dozen steps. Nothing of a document reaches the driver.
Every whole text is then scored in one pass, without a shuffle.

Defined results: null, empty and wordless texts hold no word and get the
scorer's base score; every row is scored by its text alone; labels without id or
value are not learned from, of several labels of one id the smallest value
counts, and of several rows of one id one is learned from as confirmed; without a
confirmed document every score is 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import carrying, fresh, map_arrow, materialize, summed, texts, whole_row
from ridelake.llm.quality import held_out, one_an_id, training_labels

BUCKETS = 1 << 20
STEMS = (4, 5, 6)  # bytes of a longer word's beginning
POSITIVES = 3000
LEAST_SUPPORT = 10
LEAST_LIFT = 3.0
DECAY = 1e-4
STEPS = 60
MEMORY = 10  # pairs of differences that L-BFGS keeps
FLAT = 1e-4  # the fit ends when a step lowers the risk by less than this share, or at as small a gradient
THRESHOLD = 0.5
P, U = 1, 0
_HELD = 100_000  # distinct sets that a task counts before it gives them out

# A-Z become a-z; letters, digits and bytes beyond ASCII stay; the rest parts words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def buckets_of(text: bytes | None) -> np.ndarray:
    """Distinct buckets of a text's words and of the stems of its longer words."""
    words = set(text.translate(_FOLD).split()) if text else set()
    stems = {w[:n] + b"^" for n in STEMS for w in words if len(w) > n}
    crc = zlib.crc32
    found = np.fromiter((crc(w) for part in (words, stems) for w in part), np.uint32, len(words) + len(stems))
    return np.unique(found & np.uint32(BUCKETS - 1)).astype(np.int32)


class Scorer:
    def __init__(self, weights: np.ndarray, base: float):
        self.weights, self.base = weights, base

    def score(self, text: bytes | None) -> float:
        z = self.base + float(self.weights[buckets_of(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def parts_of(weights: np.ndarray, sets: list[bytes], counts: np.ndarray) -> np.ndarray:
    """For weighted sets of columns (int32 from 1 on; weight 0 is the base): the number of
    documents, the sums of l(f, -) and of f, then of each column's derivative of
    l(f, -), then of each column's occurrences."""
    sizes = np.fromiter((len(s) // 4 for s in sets), np.int64, len(sets))
    columns = np.frombuffer(b"".join(sets), "<i4").astype(np.int64)
    z = np.full(len(sets), weights[0])
    filled = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[filled]
    if len(starts):
        z[filled] += np.add.reduceat(weights[columns], starts)
    pull = counts / (1 + np.exp(-np.clip(z, -500, 500)))
    slopes = np.bincount(columns, np.repeat(pull, sizes), len(weights))
    held = np.bincount(columns, np.repeat(counts.astype(float), sizes), len(weights))
    slopes[0], held[0] = pull.sum(), counts.sum()
    return np.concatenate([[counts.sum(), (counts * np.logaddexp(0, z)).sum(), (counts * z).sum()], slopes, held])


def risk(weights: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The non-negative risk, with the weights' decay, and its gradient, from the ``parts_of`` both."""
    k = len(weights)
    n_p, minus_p, z_p = positive[:3]
    n_u, minus_u, _ = unlabelled[:3]
    slope_p, held_p, slope_u = positive[3:3 + k] / n_p, positive[3 + k:] / n_p, unlabelled[3:3 + k] / n_u
    value = prior * (minus_p - z_p) / n_p  # l(f, +) = l(f, -) - f
    gradient = prior * (slope_p - held_p)
    negative = minus_u / n_u - prior * minus_p / n_p
    if negative >= 0:  # else the corrected risk is held at zero: only confirmed examples pull
        value += negative
        gradient = gradient + slope_u - prior * slope_p
    own = np.concatenate([[0.0], weights[1:]])
    return float(value + decay / 2 * (own @ own)), gradient + decay * own


def minimise(function, start: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """L-BFGS with halved steps until the value falls enough."""
    w = start
    value, gradient = function(w)
    first, moves, turns = np.linalg.norm(gradient), [], []
    for _ in range(steps):
        if np.linalg.norm(gradient) <= FLAT * first:
            break
        d, alphas = gradient.copy(), []
        for m, t in zip(reversed(moves), reversed(turns)):
            alphas.append((m @ d) / (m @ t))
            d -= alphas[-1] * t
        d *= (moves[-1] @ turns[-1]) / (turns[-1] @ turns[-1]) if moves else 1 / max(first, 1e-300)
        for m, t, alpha in zip(moves, turns, reversed(alphas)):
            d += (alpha - (t @ d) / (m @ t)) * m
        slope, size = -(gradient @ d), 1.0
        if slope >= 0:
            d, slope, moves, turns = gradient, -(gradient @ gradient), [], []
        for _ in range(8):
            after, turned = function(w - size * d)
            if after <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        move, turn, fell = -size * d, turned - gradient, value - after
        w, value, gradient = w + move, after, turned
        if fell <= FLAT * abs(value):
            break
        if move @ turn > 1e-12 * (turn @ turn):
            moves, turns = [*moves, move][-MEMORY:], [*turns, turn][-MEMORY:]
    return w


def _support(kept: np.ndarray | None):
    """(bucket, documents that hold it), of the ``kept`` buckets only; at -1 the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in texts(batch):
                counts[buckets_of(text)] += 1  # distinct in a document
                n += 1
        found = np.flatnonzero(counts if kept is None else counts * kept)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], found]).astype(np.int32)),
                                              pa.array(np.concatenate([[n], counts[found]]).astype(np.int64))], names=["bucket", "n"])
    return run


def _sets(column: np.ndarray, kind: int):
    """The documents' sets of kept columns, with how many documents have each."""

    def batch_of(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(found), pa.int32()), pa.array(list(found), pa.binary()),
                                           pa.array(list(found.values()), pa.int64())], names=["kind", "columns", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, int] = {}
        for batch in batches:
            for text in texts(batch):
                own = column[buckets_of(text)]
                own = np.sort(own[own > 0]).astype("<i4").tobytes()
                found[own] = found.get(own, 0) + 1
                if len(found) >= _HELD:
                    yield batch_of(found)
                    found = {}
        if found:
            yield batch_of(found)
    return run


def _counts(df: DataFrame, kept: np.ndarray | None) -> tuple[np.ndarray, int]:
    """Documents by bucket (at most ``BUCKETS`` rows), and all documents."""
    rows = map_arrow(df.select("text"), _support(kept), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts, n = np.zeros(BUCKETS, np.int64), 0
    for r in rows:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            counts[r["bucket"]] = r["n"]
    return counts, n


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, prior: float | None = None,
          least_support: int = LEAST_SUPPORT, decay: float = DECAY, steps: int = STEPS) -> Scorer | None:
    """The scorer, or None without a confirmed toxic document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    confirmed = training_labels(labels.filter(F.col("toxic") == 1), "toxic", positives)  # at most ``positives`` rows
    if prior is None:
        fold = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        prior = fold.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return None
    prior = min(0.9, prior)
    positive = materialize(one_an_id(own.join(confirmed, "doc_id"), "label").select("text"), "confirmed")
    unlabelled = own.filter(F.col("doc_id").isNotNull() & ~held_out())
    support, n_p = _counts(positive, None)
    if not n_p:
        return None
    enough = support >= min(least_support, max(1, n_p // 20))
    common, n_u = _counts(unlabelled, enough)
    kept = np.flatnonzero(enough & (support / n_p >= LEAST_LIFT * common / n_u))
    column = np.zeros(BUCKETS, np.int32)
    column[kept] = np.arange(1, len(kept) + 1)

    found = None
    for kind, rows in ((P, positive), (U, unlabelled)):
        part = map_arrow(rows.select("text"), _sets(column, kind), "kind int, columns binary, n long")
        found = part if found is None else found.unionByName(part)
    found = materialize(found.groupBy("kind", "columns").agg(F.sum("n").alias("n")), "toxic-sets")
    tasks = found.rdd.getNumPartitions()

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        def of(batches):
            total = np.zeros((2, 3 + 2 * len(weights)))
            for batch in batches:
                kinds = np.asarray(batch.column(0))
                sets, n = batch.column(1).to_pylist(), np.asarray(batch.column(2))
                for kind in (P, U):
                    here = np.flatnonzero(kinds == kind)
                    if len(here):
                        total[kind] += parts_of(weights, [sets[i] for i in here.tolist()], n[here])
            return total

        both = summed(found, of, tasks)
        return risk(weights, both[P], both[U], prior, decay)

    start = np.zeros(len(kept) + 1)
    start[0] = np.log(prior / (1 - prior))
    learned = minimise(evaluate, start, steps)
    weights = np.zeros(BUCKETS, np.float32)
    weights[kept] = learned[1:]
    return Scorer(weights, float(learned[0]))


def score_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` with a double column ``score`` (or a longer name where that is taken)."""
    name = fresh(docs.columns, "score")
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, **options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = sent.value
        for batch in batches:
            scores = [scorer.score(t) if scorer else 0.0 for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    base = docs.select(whole_row(docs),
                       F.col("text").cast("string").alias("text"))
    scored = map_arrow(base, run, carrying(base, "score double"))
    return scored.select("row.*", F.col("score").alias(name))


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_toxicity(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
