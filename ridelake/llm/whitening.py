"""Operator 13: whitening of embeddings by Jacobi-Davidson.

Vectors become whole numbers (floor of 256 times each entry); each distinct one counts
once. They are written to the shared folder in packed blocks, and the covariance V of
their entries is never formed: all that is asked of the corpus is V times a few
vectors, a pass over the blocks in which each task centres its rows (exactly, by the
whole part of the mean, then by the rest) and returns one small matrix.

On the driver stand only matrices as long as a vector. A subspace is kept with its
products; its Rayleigh-Ritz pairs are the current guesses. For the wanted pairs that
haven't converged, the correction equation

    (I - QQ') (V - e I) (I - QQ') t = -r,   Q: locked vectors and the guess itself

is solved roughly by a few steps of MINRES, all pairs side by side, so a step costs one
pass whatever their number; the corrections widen the subspace. A leading pair is
locked once its residual is down to the rounding of double precision, and the rest
goes on in the complement, until all wanted pairs are locked. Equal eigenvalues do no
harm: the subspace is then complete earlier and any orthonormal basis is right.

Defined results: null vectors and those with null or non-finite entries are dropped
(an empty one holds none); of unequal lengths the shorter ones are taken as filled up with zeros;
numbers beyond 64 bits stop at their ends; repeated rows are returned each, repeated
vectors count once; components without variance are left out (constant vectors or an
empty table give no rows); a deviation beyond 64 bits is null; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import map_arrow, materialize

SCALE = 256
COMPONENTS = 4
INNER_STEPS = 10
SUBSPACE = 40  # columns kept at most before a restart
GUARD = 2  # guesses beyond the wanted ones that a restart keeps
TOLERANCE = 64 * np.finfo(float).eps  # of the largest eigenvalue
MAX_ROUNDS = 300
SEED = 29
VALUES = 1 << 20  # numbers that a task holds at once
TASK_BYTES = 32 << 20  # of packed vectors to a task of a pass
PARTIALS = 256  # task results that the driver adds up; more are first added up in tasks

_WIDTHS = ("<i2", "<i4", "<i8")


def whole_numbers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of whole numbers) of the usable vectors of a list column; shorter ones
    are filled up with zeros, matrices have about ``VALUES`` entries at most."""
    valid = np.asarray(column.is_valid())
    lengths = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    flat = column.flatten()
    entries = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
    starts = np.cumsum(lengths) - lengths
    at = 0
    while at < len(valid):
        end, longest = at, 0
        while end < len(valid) and (end == at or max(longest, lengths[end]) * (end + 1 - at) <= VALUES):
            longest = max(longest, lengths[end])
            end += 1
        here = np.arange(at, end)
        inside = np.arange(longest)[None, :] < lengths[here][:, None]
        values = np.zeros((len(here), longest))
        values[inside] = entries[starts[at]:starts[at] + int(lengths[at:end].sum())]
        usable = valid[here] & np.isfinite(values).all(axis=1)
        scaled = np.floor(values[usable] * SCALE)
        top = float(2 ** 63)
        numbers = np.where(scaled >= top, 2 ** 63 - 1, np.where(scaled < -top, -2 ** 63, 0)).astype(np.int64)
        fits = (scaled < top) & (scaled >= -top)
        numbers[fits] = scaled[fits].astype(np.int64)
        yield here[usable], numbers
        at = end


def pack(row: np.ndarray) -> bytes:
    """A vector's one form: no zeros at the end, the narrowest width, named by the first byte."""
    filled = np.flatnonzero(row)
    row = row[:filled[-1] + 1] if len(filled) else row[:0]
    low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
    kind = next(k for k, w in enumerate(_WIDTHS) if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
    return bytes([kind]) + row.astype(_WIDTHS[kind]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _WIDTHS[raw[0]], offset=1).astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, numbers in whole_numbers(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array([pack(r) for r in numbers], pa.binary())], names=["x"])


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums by dimension as two halves (entry = high * 2**32 + low); at -1 its rows."""
    n, high, low = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            x = unpack(raw)
            if len(x) > len(high):
                high, low = (np.concatenate([h, np.zeros(len(x) - len(h), np.int64)]) for h in (high, low))
            high[:len(x)] += x >> 32
            low[:len(x)] += x & 0xFFFFFFFF
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(high)), pa.int32()), pa.array([0, *high.tolist()]), pa.array([n, *low.tolist()])],
            names=["dimension", "high", "low"])


def _as_blocks(length: int, middle: np.ndarray):
    """Many vectors to a row, less the whole part of the mean, as one matrix."""
    most = max(1, VALUES // max(1, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            for at in range(0, len(found), most):
                x = np.zeros((len(found[at:at + most]), length), np.int64)
                for row, raw in zip(x, found[at:at + most], strict=True):
                    own = unpack(raw)
                    row[:len(own)] = own
                block = centred_whole(x, middle)
                kind = next((k for k, w in enumerate(_WIDTHS) if block.dtype != float and block.size and
                             np.iinfo(w).min <= block.min() and block.max() <= np.iinfo(w).max), 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int32()), pa.array([kind], pa.int32()),
                     pa.array([block.astype((*_WIDTHS, "<f8")[kind]).tobytes()], pa.binary())], names=["n", "kind", "x"])
    return run


def centred_whole(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """``x`` less the whole numbers ``middle``; in doubles only where 64 bits don't hold it."""
    if len(x) and max(abs(int(x.min())), abs(int(x.max())), max(map(abs, middle.tolist()), default=0)) >= 2 ** 62:
        return (x.astype(object) - middle.astype(object)).astype(float)
    return x - middle


class Passes:
    """Passes over the written blocks; ``count`` counts them."""

    def __init__(self, blocks: DataFrame, tasks: int, length: int, rest: np.ndarray):
        self.blocks, self.tasks, self.length, self.rest, self.count = blocks, tasks, length, rest, 0

    def sum(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``of(centred rows)``, a small matrix, over all blocks, always added up in one order."""
        length, rest = self.length, self.rest
        self.count += 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for n, kind, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    x = np.frombuffer(raw, (*_WIDTHS, "<f8")[kind]).reshape(n, length).astype(float) - rest
                    own = of(x)
                    total = own if total is None else total + own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary()),
                                                  pa.array([list(total.shape)], pa.list_(pa.int32()))], names=["part", "shape"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = [(bytes(p), tuple(s)) for b in batches for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            if found:
                whole = sum(np.frombuffer(p, "<f8").reshape(s) for p, s in sorted(found))
                yield pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary()),
                                                  pa.array([list(whole.shape)], pa.list_(pa.int32()))], names=["part", "shape"])

        schema = "part binary, shape array<int>"
        parts = map_arrow(self.blocks, run, schema)
        if self.tasks > PARTIALS:
            parts = map_arrow(parts.repartition(math.isqrt(self.tasks), F.xxhash64("part")), add, schema)
        found = sorted((bytes(r["part"]), tuple(r["shape"])) for r in parts.collect())
        return sum(np.frombuffer(p, "<f8").reshape(s) for p, s in found)


def _without(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``v`` without its share in the orthonormal columns ``q``, taken off twice for rounding."""
    for _ in range(2):
        v = v - q @ (q.T @ v)
    return v


def widened(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Orthonormal columns that ``new`` adds to the orthonormal ``basis``."""
    kept = np.zeros((len(basis), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if size == 0 or not np.isfinite(size):
            continue
        left = _without(np.hstack([basis, kept]), column / size)
        if np.linalg.norm(left) > 1e-8:
            left = _without(np.hstack([basis, kept]), left / np.linalg.norm(left))
            kept = np.hstack([kept, (left / np.linalg.norm(left))[:, None]])
    return kept


def corrections(product: Callable[[np.ndarray], np.ndarray], locked: np.ndarray, guesses: np.ndarray,
                values: np.ndarray, residuals: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on each guess's projected correction equation; a step costs one product for all."""

    def project(v: np.ndarray) -> np.ndarray:
        v = _without(locked, v)
        return v - guesses * (guesses * v).sum(axis=0)

    def safe(a: np.ndarray, by: np.ndarray) -> np.ndarray:
        return a / np.where(by == 0, 1.0, by) * (by != 0)

    v = project(-residuals)
    start = beta = np.linalg.norm(v, axis=0)
    v, v_old = safe(v, beta), np.zeros_like(v)
    x, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    c = c_old = np.ones(len(values))
    s = s_old = np.zeros(len(values))
    left = beta
    for _ in range(steps):
        image = project(product(v) - v * values)
        alpha = (v * image).sum(axis=0)
        image = image - v * alpha - v_old * beta
        after = np.linalg.norm(image, axis=0)
        delta = c * alpha - c_old * s * beta
        rho = np.hypot(delta, after)
        direction = safe(v - w_old * (s_old * beta) - w * (s * alpha + c_old * c * beta), rho)
        c_old, s_old, c, s = c, s, safe(delta, rho), safe(after, rho)
        x = x + direction * (c * left)
        left = -s * left
        w_old, w, v_old, v, beta = w, direction, v, safe(image, after), after
        if np.all(np.abs(left) <= 0.01 * start):
            break
    return project(x)


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], length: int, wanted: int = COMPONENTS,
                  steps: int = INNER_STEPS, subspace: int = SUBSPACE, tolerance: float = TOLERANCE,
                  seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the largest eigenvalues, falling, of the symmetric
    operator behind ``product``, which is given matrices of ``length`` rows."""
    wanted = min(wanted, length)
    rng = np.random.default_rng(seed)
    locked, values, errors = np.zeros((length, 0)), np.zeros(0), np.zeros(0)
    basis = widened(locked, rng.normal(size=(length, wanted + GUARD)))
    images = product(basis)
    least, since = math.inf, 0
    for _ in range(MAX_ROUNDS):
        small = basis.T @ images
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        guesses, images = basis @ turn, images @ turn
        residuals = _without(locked, images - guesses * theta)
        norms = np.linalg.norm(residuals, axis=0)
        size = max([0.0, *np.abs(theta), *np.abs(values)])
        # rounding ends the descent: nothing is left to add, or no round has halved the residual for long
        since = 0 if len(norms) and norms[0] < least / 2 else since + 1
        least = min(least, norms[0]) if len(norms) and since else norms[0] if len(norms) else math.inf
        complete = locked.shape[1] + basis.shape[1] >= length
        ended = complete or since >= 6 and least <= 1e-10 * size
        ready = 0
        while ready < min(len(theta), wanted - locked.shape[1]) and (norms[ready] <= tolerance * size or ended):
            ready += 1
            ended = complete
        if ready:
            locked = np.hstack([locked, widened(locked, guesses[:, :ready])])
            values, errors = np.append(values, theta[:ready]), np.append(errors, norms[:ready])
            least, since = math.inf, 0
        theta, guesses, images, residuals = theta[ready:], guesses[:, ready:], images[:, ready:], residuals[:, ready:]
        if len(values) == wanted:
            if not len(theta) or theta[0] <= values.min() + tolerance * size:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order], errors[order]
            # a larger one has come up behind: the smallest locked pair is looked for again
            keep = np.arange(wanted) != values.argmin()
            locked, values, errors = locked[:, keep], values[keep], errors[keep]
        if basis.shape[1] > subspace:  # restart with the best guesses
            kept = 2 * wanted + GUARD
            theta, guesses, images, residuals = theta[:kept], guesses[:, :kept], images[:, :kept], residuals[:, :kept]
        open_ = slice(0, wanted - len(values))
        new = np.zeros((length, 0))
        if len(theta):
            new = corrections(product, locked, guesses[:, open_], theta[open_], residuals[:, open_], steps)
        new = widened(np.hstack([locked, guesses]), new)
        if not new.shape[1]:
            new = widened(np.hstack([locked, guesses]), rng.normal(size=(length, 1)))
        basis = np.hstack([guesses, new])
        images = np.hstack([images, product(new)]) if new.shape[1] else images
    raise RuntimeError(f"no convergence in {MAX_ROUNDS} rounds: residuals {norms[:wanted]}")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue, residual
    for every usable row of (vec_id, embedding) and every component that has variance."""
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.col("embedding").cast("array<double>").alias("embedding"))
    fit = materialize(map_arrow(own.select("embedding"), _packed, "x binary").groupBy("x").agg(F.lit(1).alias("one")).select("x"),
                      "fit-vectors")
    wide = "decimal(38,0)"
    sums = {r["dimension"]: (int(r["high"]), int(r["low"])) for r in map_arrow(
        fit, _measures, "dimension int, high long, low long").groupBy("dimension").agg(
            F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect()}
    n = sums.pop(-1, (0, 0))[1]
    length = len(sums)
    total = [(sums[d][0] << 32) + sums[d][1] for d in range(length)]
    middle = [s // n for s in total]
    over = [s - n * m for s, m in zip(total, middle, strict=True)]  # 0 to n - 1
    whole, rest = np.array(middle, np.int64), np.array([o / n for o in over])

    tasks = max(1, -(-n * length * 2 // TASK_BYTES))
    blocks = materialize(map_arrow(fit.coalesce(tasks), _as_blocks(length, whole), "n int, kind int, x binary"), "fit-blocks")
    passes = Passes(blocks, tasks, length, rest)
    values, bases, residuals, trace, error = np.zeros(0), np.zeros((length, 0)), np.zeros(0), 0.0, 0.0
    if length:
        trace = float(passes.sum(lambda x: np.array([[(x * x).sum()]]))[0, 0]) / n
        values, bases, residuals = leading_pairs(lambda b: passes.sum(lambda x: x.T @ (x @ b)) / n, length, components)
        some = values > length * TOLERANCE * max(values[0], 0.0)
        values, bases, residuals = values[some], bases[:, some], residuals[some]
    turned = bases / np.sqrt(values)
    if len(values):
        def moments(x: np.ndarray) -> np.ndarray:
            z = x @ turned
            return np.vstack([z.T @ z, z.sum(axis=0)[None]])

        found = passes.sum(moments) / n
        covariance = found[:-1] - np.outer(found[-1], found[-1])
        error = float(np.abs(covariance - np.eye(len(values))).max())
    explained = (values / trace).tolist() if len(values) else []
    over_ints = np.array(over, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches if k else ():
            ids = batch.column(0).to_pylist()
            for rows, numbers in whole_numbers(batch.column(1)):
                x = np.zeros((len(rows), length), np.int64)
                width = min(length, numbers.shape[1])  # beyond are zeros only
                x[:, :width] = numbers[:, :width]
                y = centred_whole(x, whole)
                far = ((n * y.astype(float) - np.array(over, float)) ** 2).sum(axis=1)
                deviation: list[int | None] = [None] * len(x)
                plain = np.flatnonzero(far < 2.0 ** 62)
                own = ((n * y[plain].astype(np.int64) - np.array(over, np.int64)) ** 2).sum(axis=1) if len(plain) else []
                for i, d in zip(plain.tolist(), own, strict=True):
                    deviation[i] = int(d)
                for i in np.flatnonzero(far >= 2.0 ** 62).tolist():
                    d = int(((n * (x[i].astype(object) - whole.astype(object)) - over_ints) ** 2).sum())
                    deviation[i] = d if d < 2 ** 63 else None
                z = (y.astype(float) - rest) @ turned
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([ids[r] for r in rows.tolist()], object), k), pa.int64()),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array([n] * (m * k), pa.int64()),
                     pa.array([d for d in deviation for _ in range(k)], pa.int64()), pa.array(z.reshape(-1)),
                     pa.array(explained * m, pa.float64()), pa.array([error] * (m * k)),
                     pa.array(values.tolist() * m, pa.float64()), pa.array(residuals.tolist() * m, pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue", "residual"])

    return map_arrow(own, run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                               "identity_error double, eigenvalue double, residual double")
