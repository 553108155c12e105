"""Operator 3: nearest neighbours by cosine through randomly rotated one-bit codes.

Every vector, scaled to length one, is turned by a fixed random rotation into
``CODE_BITS`` dimensions (zero-padded, so shorter vectors get longer codes) and
kept as the signs of its coordinates, packed, with one correction scalar: the
inner product of the vector and its own code. A query's coordinates are
rounded to ``QUERY_BITS`` bits, so its inner product with a code is a handful of
bit counts. Divided by the correction scalar this estimates the cosine; the
error bound, ``EPSILON`` standard deviations, gives a lower and an upper bound.
Only vectors whose upper bound reaches the k-th best lower bound are reranked by
exact cosine in double precision.

Every row is indexed and every stated query meets every row of its length:
vectors are dealt, each length by itself, into groups as large as a task may hold
(``GROUP_BYTES``, but as many as the cluster has cores where there are vectors
enough); each group is one task. The queries, a stated fraction of the rows, go to every
group of their length as a stream, once for each ``GROUP_BYTES`` of vectors (that, and the
comparison of each query with each code, grows with queries times rows, as the search
asks for). Each group answers with its k best, which are merged per query. Distinct
lengths, a few numbers (at most the square root of twice all entries), are all
that reaches the driver.

Defined results: rows with a null id, a null vector, an empty one, a zero one or
one with null or non-finite components take no part; vectors of different
lengths are no neighbours, so each length is searched by itself; equal scores go
to the smaller id; exactly repeated query rows are answered once, repeated
candidates are candidates each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import map_arrow

CODE_BITS = 256
QUERY_BITS = 6
EPSILON = 3.0
GROUP_BYTES = 32 << 20  # of vectors, in doubles, that a task holds
MOST_LENGTHS = 1_000_000  # that are sent to every task; beyond them the planner joins by shuffle
LEAST_GROUP = 4096  # vectors; smaller groups aren't made for the sake of more tasks
SEED = 20240229


@lru_cache(maxsize=4)
def rotation(dims: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` x ``dims`` matrix with orthonormal columns."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, max(dims, 1))))
    return q * np.sign(np.diag(r))


def code_length(dims: int, bits: int) -> int:
    return max(bits, -(-dims // 64) * 64)


class Codes:
    """One-bit codes of a group of vectors."""

    def __init__(self, vectors: np.ndarray, bits: int = CODE_BITS, seed: int = SEED):
        self.bits = code_length(vectors.shape[1], bits)
        self.turn = rotation(vectors.shape[1], self.bits, seed)
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        turned = (vectors / self.norms[:, None]) @ self.turn.T
        self.words = np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64)
        self.ones = np.bitwise_count(self.words).sum(axis=1).astype(np.float64)
        # inner product of a vector and its code, both of length one
        self.fit = np.abs(turned).sum(axis=1) / np.sqrt(self.bits)

    def bounds(self, query: np.ndarray, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
        """Estimated cosines of one query (length one) with all vectors, and the error bounds."""
        q = self.turn @ query
        low, high = q.min(), q.max()
        unit = (high - low) / ((1 << QUERY_BITS) - 1) or 1.0
        levels = np.rint((q - low) / unit).astype(np.uint8)
        # <signs, q> = 2 * sum over set bits - sum over all, in the rounded q
        dot = np.zeros(len(self.words))
        for b in range(QUERY_BITS):
            plane = np.packbits(levels >> b & 1, bitorder="little").view(np.uint64)
            dot += float(1 << b) * np.bitwise_count(self.words & plane).sum(axis=1)
        signs = 2.0 * (unit * dot + low * self.ones) - (unit * float(levels.sum()) + low * self.bits)
        fit = np.maximum(self.fit, 1e-9)
        estimate = signs / np.sqrt(self.bits) / fit
        error = epsilon * np.sqrt(np.maximum(0.0, 1 - fit * fit)) / fit / np.sqrt(max(1, self.bits - 1)) + unit
        return estimate, error


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact cosines; each row is summed alone, so equal vectors get equal scores."""
    dot = (vectors * query).sum(axis=1)
    return dot / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def search_group(codes: Codes, ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray,
                 k: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k nearest of a group to one query, itself left out."""
    estimate, error = codes.bounds(query / np.sqrt((query * query).sum()), epsilon)
    other = ids != query_id
    lower = np.where(other, estimate - error, -np.inf)
    k_here = min(k, len(ids))
    least = np.partition(lower, len(ids) - k_here)[len(ids) - k_here]
    chosen = np.flatnonzero(other & (estimate + error >= least))
    score = cosines(query, vectors[chosen])
    order = np.lexsort((ids[chosen], -score))[:k]
    return ids[chosen][order], score[order]


def _search(k: int, bits: int, epsilon: float, seed: int):
    """Rows come sorted by group, its vectors first; its queries are a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, vectors, codes = None, None, None, None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            vec_ids = batch.column(2).to_numpy()
            embeddings = batch.column(3)
            edge = np.flatnonzero((np.diff(groups) != 0) | (np.diff(asks) != 0)) + 1
            out: list[tuple] = []
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(groups)], strict=True):
                if b == a:
                    continue
                # of one group, so of one length
                rows = embeddings.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b - a, -1)
                if groups[a] != group:
                    group, held, codes = groups[a], [], None
                if not asks[a]:
                    held.append((vec_ids[a:b], rows))
                    continue
                if codes is None and held:
                    ids = np.concatenate([h[0] for h in held])
                    vectors = np.concatenate([h[1] for h in held])
                    held, codes = [], Codes(vectors, bits, seed)
                if codes is not None:
                    for q in range(a, b):
                        near, score = search_group(codes, ids, vectors, int(vec_ids[q]), rows[q - a], k, epsilon)
                        out += [(int(vec_ids[q]), int(i), float(s)) for i, s in zip(near, score, strict=True)]
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                    names=["query_id", "vec_id", "score"])
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
                       & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, is_query, k: int = 5, group_vectors: int | None = None,
            bits: int = CODE_BITS, epsilon: float = EPSILON, seed: int = SEED) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest other rows of every
    row for which ``is_query`` (a condition on vec_id) holds. ``group_vectors`` sets the
    size of a group by itself."""
    spark = vectors.sparkSession
    rows = usable(vectors).withColumn("length", F.size("embedding"))
    parts, first = [], 0
    for r in rows.groupBy("length").count().orderBy("length").collect():
        most = group_vectors or max(1, GROUP_BYTES // (8 * r["length"]))
        n = -(-r["count"] // most)
        if not group_vectors:
            n = max(n, min(spark.sparkContext.defaultParallelism, -(-r["count"] // LEAST_GROUP)))
        parts.append((r["length"], n, first))
        first += n
    lengths = spark.createDataFrame(parts, "length int, parts int, first int")
    # 12 bytes a length; nearly all rows may share one, so they aren't dealt by it
    rows = rows.join(F.broadcast(lengths) if len(parts) <= MOST_LENGTHS else lengths, "length")
    # by a hash of the id and the vector, so equal vectors or ids do not meet in one group
    base = rows.select((F.col("first") + F.pmod(F.xxhash64("vec_id", "embedding"), "parts")).cast("int").alias("group"),
                       F.lit(False).alias("asks"), "vec_id", "embedding")
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "embedding"])
    queries = queries.select(F.explode(F.sequence(F.col("first"), F.col("first") + F.col("parts") - 1)).alias("group"),
                             F.lit(True).alias("asks"), "vec_id", "embedding")
    dealt = base.unionByName(queries).repartitionById(max(1, first), F.col("group")).sortWithinPartitions("group", "asks")
    found = map_arrow(dealt, _search(k, bits, epsilon, seed), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
