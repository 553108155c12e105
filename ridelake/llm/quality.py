"""Operator 5: quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded:
character-class shares, word lengths and repetition beside the mean of learned
vectors of its (hashed) words go through a hidden layer. Gated attention,
learned from document labels alone, weighs the passages; the score is a
logistic function of the weighted mean of their encodings.

The model is fitted with Adam in numpy on a bounded, documented sample: at most
``SAMPLE`` labelled documents, chosen by a hash of their id, whole texts, none of
the held-out fold (crc32 of the id as text, modulo 5, is 0). Features are
computed in Spark tasks; only those of the sample reach the driver. Every whole
text is then scored in one pass, without a shuffle.

Defined results: null and empty texts are one empty passage and get a score;
every row is scored by its text alone, so repeated rows agree; labels without
id or value are not learned from, of several labels of one id the smallest
value counts, and of several rows of one id one is learned from; without any usable label every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import carrying, fresh, map_arrow, row_key, texts, whole_row

PASSAGE = 64
BUCKETS = 8192
WORD_DIMS = 8
HIDDEN = 24
ATTENTION = 12
SAMPLE = 5000
EPOCHS = 12
RATE = 0.01
THRESHOLD = 0.3
SEED = 7
GROUP_WORDS = 400_000

# byte classes: 0 blank, 1 lower, 2 upper, 3 digit, 4 other ASCII, 5 beyond ASCII
_CLASS = np.array([5 if b >= 128 else 1 if 97 <= b <= 122 else 2 if 65 <= b <= 90 else 3 if 48 <= b <= 57
                   else 0 if b <= 32 else 4 for b in range(256)], np.uint8)
STATS = 9


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def encode_passages(docs: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For several documents: word buckets, first word of each passage, surface
    features of each passage, first passage of each document."""
    lists = [(d.split() or [b""]) if d else [b""] for d in docs]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    words = [w for ws in lists for w in ws]
    n = len(words)
    hashes = np.fromiter(map(zlib.crc32, words), np.uint32, n)
    per_doc = -(-sizes // PASSAGE)
    doc_first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    passage_doc = np.repeat(np.arange(len(lists)), per_doc)
    in_doc = np.arange(per_doc.sum()) - doc_first[passage_doc]
    first = (np.cumsum(sizes) - sizes)[passage_doc] + in_doc * PASSAGE
    counts = np.diff(np.append(first, n))

    lengths = np.fromiter(map(len, words), np.int64, n)
    text = np.frombuffer(b" ".join(words) + b" ", np.uint8)  # each word and one blank
    kinds = _CLASS[text]
    at = np.cumsum(lengths + 1) - lengths - 1
    byte_first = at[first]
    total = np.diff(np.append(byte_first, len(text))).astype(np.float64)
    shares = [np.add.reduceat(kinds == k, byte_first, dtype=np.int64) / total for k in (1, 2, 3, 4, 5)]
    # repetition: distinct words, the commonest word, words equal to the one before
    which = np.repeat(np.arange(len(first)), counts)
    order = np.sort((which.astype(np.uint64) << np.uint64(32)) | hashes)
    new = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
    runs = np.diff(np.append(new, n))
    run_passage = (order[new] >> np.uint64(32)).astype(np.int64)
    run_first = np.flatnonzero(np.concatenate([[True], run_passage[1:] != run_passage[:-1]]))
    distinct = np.diff(np.append(run_first, len(new))) / counts
    commonest = np.maximum.reduceat(runs, run_first) / counts
    same = np.concatenate([[False], hashes[1:] == hashes[:-1]])
    same[first] = False
    echoed = np.add.reduceat(same, first, dtype=np.int64) / counts
    mean_length = np.add.reduceat(lengths, first) / counts / 10
    stats = np.stack([*shares, distinct, commonest, echoed, mean_length], axis=1).astype(np.float32)
    return (hashes % np.uint32(BUCKETS)).astype(np.int32), first, stats, doc_first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class GatedAttention:
    """The model; ``weights`` holds all that is learned."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        wide = STATS + WORD_DIMS
        self.weights = {"words": draw(BUCKETS, WORD_DIMS), "w": draw(wide, HIDDEN), "b": np.zeros(HIDDEN, np.float32),
                        "v": draw(HIDDEN, ATTENTION), "u": draw(HIDDEN, ATTENTION), "a": draw(ATTENTION, 1)[:, 0],
                        "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}
        self.mean, self.scale = np.zeros(STATS, np.float32), np.ones(STATS, np.float32)

    def forward(self, buckets: np.ndarray, first: np.ndarray, stats: np.ndarray, doc_first: np.ndarray) -> dict:
        p = self.weights
        counts = np.diff(np.append(first, len(buckets))).astype(np.float32)
        per_doc = np.diff(np.append(doc_first, len(first)))
        x = np.concatenate([(stats - self.mean) / self.scale,
                            np.add.reduceat(p["words"][buckets], first, axis=0) / counts[:, None]], axis=1)
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = (t * s) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, doc_first), per_doc))
        att = e / np.repeat(np.add.reduceat(e, doc_first), per_doc)
        z = np.add.reduceat(att[:, None] * h, doc_first, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "att": att, "z": z, "counts": counts, "per_doc": per_doc,
                "score": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, bag: tuple, labels: np.ndarray) -> dict[str, np.ndarray]:
        buckets, first, _, doc_first = bag
        p, f = self.weights, self.forward(*bag)
        g = ((f["score"] - labels) / len(labels)).astype(np.float32)
        per = lambda a: np.repeat(a, f["per_doc"], axis=0)
        dz = g[:, None] * p["c"]
        dh = f["att"][:, None] * per(dz)
        datt = (per(dz) * f["h"]).sum(axis=1)
        de = f["att"] * (datt - per(np.add.reduceat(f["att"] * datt, doc_first)))
        dt, ds = de[:, None] * p["a"] * f["s"], de[:, None] * p["a"] * f["t"]
        dt, ds = dt * (1 - f["t"] ** 2), ds * f["s"] * (1 - f["s"])
        dh = dh + dt @ p["v"].T + ds @ p["u"].T
        dpre = dh * (1 - f["h"] ** 2)
        dx = (dpre @ p["w"].T)[:, STATS:] / f["counts"][:, None]
        spread = np.repeat(dx, f["counts"].astype(np.int64), axis=0)
        words = np.stack([np.bincount(buckets, spread[:, k], BUCKETS) for k in range(WORD_DIMS)], axis=1)
        return {"words": words.astype(np.float32), "w": f["x"].T @ dpre, "b": dpre.sum(axis=0), "v": f["h"].T @ dt,
                "u": f["h"].T @ ds, "a": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ g, "d": g.sum(keepdims=True)}

    def fit(self, bags: list[tuple], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE,
            batch: int = 64, decay: float = 1e-4, seed: int = SEED) -> None:
        """``bags``: (buckets, first, stats) of each document."""
        stats = np.concatenate([b[2] for b in bags])
        self.mean, self.scale = stats.mean(axis=0), stats.std(axis=0) + np.float32(1e-3)
        rng, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(bags), batch):
                chosen = order[at:at + batch]
                step += 1
                grads = self.gradients(join_bags([bags[i] for i in chosen]), labels[chosen])
                for k, g in grads.items():
                    g = g + decay * self.weights[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.weights[k] = (self.weights[k] - rate * (m[k] / (1 - 0.9 ** step))
                                       / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)


def join_bags(bags: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = np.cumsum([0] + [len(b[0]) for b in bags])
    passages = np.cumsum([0] + [len(b[1]) for b in bags])
    return (np.concatenate([b[0] for b in bags]), np.concatenate([b[1] + w for b, w in zip(bags, words, strict=False)]),
            np.concatenate([b[2] for b in bags]), passages[:-1])


def groups_of(docs: list[bytes | None], most: int = GROUP_WORDS * 6) -> Iterator[list[bytes | None]]:
    """Runs of documents of about ``most`` bytes, or one document."""
    held, size = [], 0
    for d in docs:
        if held and size + len(d or b"") > most:
            yield held
            held, size = [], 0
        held.append(d)
        size += len(d or b"")
    if held:
        yield held


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch), strict=True):
            buckets, first, stats, _ = encode_passages([text])
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc]), pa.array([label], pa.int32()),
                 *(pa.array([a.tobytes()], pa.binary()) for a in (buckets, first, stats))],
                names=["doc_id", "label", "buckets", "first", "stats"])


def training_labels(labels: DataFrame, value: str, sample: int, seed: int = SEED) -> DataFrame:
    """(doc_id, label) of at most ``sample`` ids outside the held-out fold, chosen by hash."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(value).cast("int").alias("label"))
    usable = usable.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    once = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    return once.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)


def one_an_id(rows: DataFrame, mark: str) -> DataFrame:
    """doc_id, ``mark`` and the text of one row of each (the one with the smallest
    key), so that an id on any number of rows is learned from once."""
    return rows.groupBy("doc_id", mark).agg(F.min_by("text", row_key()).alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> GatedAttention | None:
    chosen = training_labels(labels, "quality", sample)  # at most ``sample`` rows
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = one_an_id(own.join(F.broadcast(chosen), "doc_id"), "label")
    found = map_arrow(rows, _features, "doc_id long, label int, buckets binary, first binary, stats binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["doc_id"], bytes(r["buckets"])))
    bags = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["first"], np.int64),
             np.frombuffer(r["stats"], np.float32).reshape(-1, STATS)) for r in found]
    model = GatedAttention()
    model.fit(bags, np.array([r["label"] for r in found], np.float32), epochs)
    return model


def score_texts(model: GatedAttention | None, docs: list[bytes | None]) -> np.ndarray:
    if model is None or not docs:
        return np.full(len(docs), 0.5)
    out = [model.forward(*encode_passages(group))["score"] for group in groups_of(docs)]
    return np.clip(np.concatenate(out).astype(np.float64), 0.0, 1.0)


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` with a double column ``score`` (or a longer name where that is taken)."""
    name = fresh(docs.columns, "score")
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample, epochs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score_texts(sent.value, texts(batch)))], names=["row", "score"])

    base = docs.select(whole_row(docs),
                       F.col("text").cast("string").alias("text"))
    scored = map_arrow(base, run, carrying(base, "score double"))
    return scored.select("row.*", F.col("score").alias(name))


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    scored = score_quality(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, columns as given."""
    scored = score_quality(docs, labels)
    name = scored.columns[-1]
    return scored.filter(F.col(name) >= threshold).drop(name)
