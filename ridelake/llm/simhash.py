"""Operator 7: SimHash near-duplicates joined through anchor points.

Fingerprint: A-Z in lower case, words parted by ASCII white space, shingles of
``SHINGLE`` words, each hashed by XXH64 (seed 42); a bit is 1 if it is set in
more than half of the hashes.

Join: a covering code chooses the anchors. The 64 bits are cut into three
segments; two fingerprints at most ``d`` bits apart are at most ``d // 3``
apart in one of them. In a segment, 15 bits are covered by the perfect Hamming
code of length 15 (every word is within one bit of exactly one codeword) and
the other bits stand for themselves, so the anchors cover the segment with
radius 1. A fingerprint has its home at the anchor that covers it and goes to
every anchor within 1 + d // 3 bits of its segment. The anchor that covers one
of a linked pair is thus also met by the other; at each anchor the homes are
compared with all that came there. Equal fingerprints are compared once, and an
anchor's links are reduced to a spanning forest before they leave the task. An
anchor with many homes is split into parts of about ``PART_HOMES`` homes, each
of which meets all that came to the anchor as a stream.

Defined results: null, empty and wordless texts have fingerprint zero, linked
like any other; repeated rows and rows with one id are each answered; a row
without id counts for links but never names a component, and a component of
such rows alone has a null id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import map_arrow, materialize, row_key, texts, whole_row
from ridelake.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PART_HOMES = 2048
SEGMENTS = ((0, 21), (21, 21), (42, 22))
BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles."""
    words = text.lower().split() if text else []  # bytes: only A-Z and ASCII spaces
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    a, b = starts[:n].tolist(), last.tolist()
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a[at:at + BLOCK], b[at:at + BLOCK], strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], names=["doc_id", "key", "print"])
    return run


def _syndromes() -> np.ndarray:
    """For each 15-bit word the position (1 to 15) of the bit that a codeword lacks, or 0."""
    words = np.arange(1 << 15, dtype=np.uint32)
    out = np.zeros(1 << 15, np.uint8)
    for bit in range(15):
        out ^= (((words >> bit) & 1) * (bit + 1)).astype(np.uint8)
    return out


def _patterns(bits: int, weight: int) -> np.ndarray:
    """All error patterns of at most ``weight`` of ``bits`` bits."""
    found = {0}
    for _ in range(weight):
        found |= {p | 1 << b for p in found for b in range(bits)}
    return np.array(sorted(found), np.uint64)


class Anchors:
    def __init__(self, max_bits: int):
        self.syndrome = _syndromes()
        reach = 1 + max_bits // len(SEGMENTS)
        self.patterns = [_patterns(n, reach) for _, n in SEGMENTS]

    def homes(self, prints: np.ndarray) -> list[np.ndarray]:
        """Per segment, the key of the anchor that covers each fingerprint."""
        out = []
        for s, (at, n) in enumerate(SEGMENTS):
            part = (prints >> np.uint64(at)) & np.uint64((1 << n) - 1)
            lacks = self.syndrome[part & np.uint64(0x7FFF)]
            flip = np.where(lacks > 0, np.uint64(1) << (np.maximum(lacks, 1) - 1).astype(np.uint64), np.uint64(0))
            out.append((part ^ flip) | np.uint64(s << 32))
        return out

    def reached(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per segment: (place in ``prints``, key) for every anchor within reach."""
        for s, (at, n) in enumerate(SEGMENTS):
            part = (prints >> np.uint64(at)) & np.uint64((1 << n) - 1)
            near = part[:, None] ^ self.patterns[s][None, :]
            i, j = np.nonzero(self.syndrome[near & np.uint64(0x7FFF)] == 0)
            yield i, near[i, j] | np.uint64(s << 32)


def _home_keys(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(max_bits)
        for batch in batches:
            keys = np.concatenate(anchors.homes(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["anchor"])
    return run


def _replicas(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(max_bits)
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(prints), 4096):
                some = prints[at:at + 4096]
                homes = anchors.homes(some)
                for s, (i, keys) in enumerate(anchors.reached(some)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(some[i].view(np.int64)),
                         pa.array(homes[s][i] == keys)], names=["anchor", "print", "home"])
    return run


class Forest:
    """Union-find over the places of one part's homes."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
        return i != j


def _compare(homes: np.ndarray, others: np.ndarray, max_bits: int, forest: Forest) -> list[tuple[int, int]]:
    """Links that join up what is near: each near other to one home, and, where
    that joins two parts of the forest, to further homes."""
    links = []
    step = max(1, (1 << 20) // max(1, len(homes)))
    for at in range(0, len(others), step):
        some = others[at:at + step]
        o, h = np.nonzero(np.bitwise_count(some[:, None] ^ homes[None, :]) <= max_bits)
        last = -1
        for i, j in zip(o.tolist(), h.tolist(), strict=True):
            if i != last:
                last, first = i, j
                if some[i] != homes[j]:
                    links.append((int(some[i]), int(homes[j])))
            elif forest.join(first, j) and some[i] != homes[j]:
                links.append((int(some[i]), int(homes[j])))
    return links


def _links(max_bits: int):
    """Rows come sorted by (anchor, part), homes first; the rest of a run is a stream."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, homes, others, forest = None, np.zeros(0, np.uint64), [], Forest(0)
        out: list[tuple[int, int]] = []
        for batch in batches:
            anchor, part, prints, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            prints = prints.view(np.uint64)
            edge = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(anchor)], strict=True):
                if b == a:
                    continue
                run_key = (int(anchor[a]), int(part[a]))
                if run_key != current:
                    current, homes = run_key, np.zeros(0, np.uint64)
                is_home = home[a:b]
                n = int(np.count_nonzero(is_home))
                if n:
                    homes = np.concatenate([homes, prints[a:a + n]])
                    forest = Forest(len(homes))
                if len(homes) and b - a > n:
                    out += _compare(homes, prints[a + n:b], max_bits, forest)
            if len(out) > 50_000:
                yield _out(out, schema)
                out = []
        if out:
            yield _out(out, schema)
    return run


def _out(links: list[tuple[int, int]], schema: pa.Schema) -> pa.RecordBatch:
    pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, part_homes: int = PART_HOMES) -> DataFrame:
    """Links (a, b) between the distinct fingerprints in ``print``, enough of
    them to join up all that are at most ``max_bits`` apart."""
    spark = prints.sparkSession
    homes = map_arrow(prints.select("print"), _home_keys(max_bits), "anchor long")
    crowded = materialize(
        homes.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > part_homes)
        .select("anchor", F.ceil(F.col("n") / part_homes).cast("int").alias("parts")), "crowded-anchors")
    replicas = map_arrow(prints.select("print"), _replicas(max_bits), "anchor long, print long, home boolean")
    # 16 bytes a row; beyond a million crowded anchors the planner joins by shuffle
    few = crowded.limit(1_000_001).count() <= 1_000_000
    parted = replicas.join(F.broadcast(crowded) if few else crowded, "anchor", "left")
    number = F.coalesce("parts", F.lit(1))
    own = F.pmod(F.xxhash64("print"), number).cast("int")
    # a home is compared in its own part, and it comes to every part as another
    rows = parted.select(
        "anchor", "print", F.explode(F.concat(
            F.transform(F.sequence(F.lit(0), number - 1), lambda p: F.struct(p.alias("part"), F.lit(False).alias("home"))),
            F.when(F.col("home"), F.array(F.struct(own.alias("part"), F.lit(True).alias("home"))))
            .otherwise(F.array().cast("array<struct<part:int,home:boolean>>")))).alias("at"))
    rows = rows.select("anchor", F.col("at.part").alias("part"), "print", F.col("at.home").alias("home"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(width, "anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
    return map_arrow(dealt, _links(max_bits), "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                       part_homes: int = PART_HOMES) -> DataFrame:
    """doc_id, key (of the row), fingerprint, component_id and group (never
    null, equal within a component) of every row."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"),
                         F.col("text").cast("string").alias("text"))
    rows = materialize(map_arrow(chosen, _fingerprints(shingle), "doc_id long, key binary, print long"), "fingerprints")
    prints = materialize(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(link_fingerprints(prints, max_bits, part_homes))
    grouped = (prints.join(roots, prints["print"] == roots["node"], "left")
               .select("print", "least", F.coalesce("root", "print").alias("group")))
    named = grouped.join(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "group").drop("least")
    return rows.join(named, "print").select(
        "doc_id", "key", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id", "group")


def simhash_report(docs: DataFrame) -> DataFrame:
    return simhash_components(docs).select("doc_id", "fingerprint", "component_id")


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without near-duplicates of an earlier id, columns as given;
    of each component the row with the smallest id (then key) stays."""
    found = simhash_components(docs, **options)
    keepers = found.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first")).select("first.key")
    with_key = docs.select(row_key().alias("key"), whole_row(docs))
    kept = with_key.join(keepers, "key", "left_semi")
    # rows of one id and text share a key: the one with the smallest hash of all columns (maps,
    # which have none, aside) stays; if that ties, they are alike
    hashed = [F.col("row").getField(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return kept.groupBy("key").agg(F.min_by("row", F.xxhash64(*hashed)).alias("row")).select("row.*")
