"""Operator 10: benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (an item of
fewer words is one window). A window's tokens are its shingles of ``shingle``
words. As a window must be contained whole, one token of each window is a
sufficient prefix: the rarest, by how many documents hold the token, counted
over all documents. Documents join on those prefix tokens only. A match puts the
window at one place in the document (positional bound), which must lie inside
it (length bound); there the window's words are compared one by one.

Windows, tokens, counts and prefixes are tables; nothing of an item passes through
the driver. The one thing sent to the scan of the documents is a bit filter of
``FILTER_BITS`` bits, whatever the benchmark's size, that says which tokens it may hold:
a document gives out, for every place whose token passes, the token's hash and the words
around it (all that any window there could cover). The filter lets too much through and
nothing too little, and hashes only pair rows up: what counts is the comparison of the
words. Documents are scanned twice, once for the candidates and once for the answer.

Defined results: null, empty or wordless texts have no words and no hits;
wordless items have no window; equal items each count (by ``item_id``; an item
without id has no name and only hits); repeated document rows are answered
alike; empty tables give zero hits or no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ridelake.llm.common import fresh, map_arrow, materialize, texts, whole_row

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 1 << 26
PORTION = 8 << 20  # bytes of texts that a task looks at together

# A-Z become a-z; 0-9, a-z and all bytes of other characters stay; the rest parts words
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd: of the rolling hash


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@F.arrow_udf(LongType())
def n_words_of(text: pa.Array) -> pa.Array:
    return pa.array([len(words_of(t)) for t in text.cast(pa.large_binary()).to_pylist()], pa.int64())


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` of the words' hashes."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    for i in range(n):
        out = (out + hashes[i:len(hashes) - n + 1 + i]) * _STEP
        out ^= out >> np.uint64(29)
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def filter_places(tokens: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each token in a filter of ``n_bits`` (a power of two)."""
    mask = np.uint64(n_bits - 1)
    return tokens & mask, (tokens >> np.uint64(32)) & mask


def _item_windows(window: int, shingle: int):
    """An item's windows: their words, their tokens' hashes, the item's name."""
    schema = pa.schema([("window", pa.binary()), ("words", pa.int32()), ("tokens", pa.list_(pa.int64())), ("item", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                words = words_of(text)
                n = min(window, len(words))
                size = min(shingle, n)
                tokens = rolled(_hashes(words), size).view(np.int64) if words else ()
                for at in range(len(words) - n + 1 if words else 0):
                    rows.append((b" ".join(words[at:at + n]), n, tokens[at:at + n - size + 1].tolist(), item))
                    if len(rows) == 1 << 14:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return run


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(documents, texts) of ``PORTION`` bytes, or one text."""
    docs, found, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
            if text:
                docs.append(doc)
                found.append(text)
                held += len(text)
                if held >= PORTION:
                    yield docs, found
                    docs, found, held = [], [], 0
    if docs:
        yield docs, found


def _candidates(bits: np.ndarray, sizes: list[int], window: int):
    """Every place of a document whose token may be one of the benchmark's: the token, how many words
    stand before the place, the words around it, and whether the document had it before."""
    schema = pa.schema([("doc", pa.binary()), ("token", pa.int64()), ("place", pa.int32()), ("around", pa.binary()),
                        ("own", pa.int32()), ("first", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, found in _portions(batches):
            raw = np.frombuffer(b"\n".join(t.translate(_FOLD) for t in found), np.uint8)
            inside = (raw != 32) & (raw != 10)
            edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
            starts, ends = edges[::2], edges[1::2]
            if not len(starts):
                continue
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])]).dictionary_encode()
            names, ids = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            hashes = _hashes(names)[ids]
            doc = np.searchsorted(np.flatnonzero(raw == 10), starts)
            begin = np.searchsorted(doc, np.arange(len(docs) + 1))  # first word of each document
            rows: list[tuple] = []
            for size in sizes:
                if len(ids) < size:
                    continue
                tokens = rolled(hashes, size)
                one, two = filter_places(tokens, 8 * len(bits))
                hit = (bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8)) & (
                    bits[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8)) & 1
                places = np.flatnonzero(hit.astype(bool) & (doc[:len(tokens)] == doc[size - 1:]))
                seen = set()
                for p in places.tolist():
                    d, token = int(doc[p]), int(tokens[p].view(np.int64))
                    low, high = max(int(begin[d]), p - window + 1), min(int(begin[d + 1]), p + window)
                    rows.append((docs[d], token, p - int(begin[d]), b" ".join([names[i] for i in ids[low:high].tolist()]),
                                 p - low, int((d, token) not in seen)))
                    seen.add((d, token))
                    if len(rows) == 1 << 14:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    return run


def _summary(spans: list[tuple[int, int]], names: list[str]) -> tuple[int, int, str]:
    """Words hit, items, and the digest of the items' names."""
    hit, end = 0, 0
    for a, b in sorted(spans):
        hit += max(0, b - max(a, end))
        end = max(end, b)
    return hit, len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_summary([(x["a"], x["b"]) for x in s], i or []) for s, i in zip(
            *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("spans", "items")), strict=True)]
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.string())], names=["doc", "n_hit", "n_items", "items_sha256"])


def token_filter(tokens: DataFrame) -> np.ndarray:
    """The bit filter of (token) rows, as bytes; at most ``FILTER_BITS`` / 64 words are gathered."""
    mask = FILTER_BITS - 1
    places = tokens.select(F.explode(F.array(F.col("token").bitwiseAND(F.lit(mask)),
                                             F.shiftrightunsigned("token", 32).bitwiseAND(F.lit(mask)))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    if words.num_rows:
        out[np.asarray(words["slot"])] = np.asarray(words["bits"])
    return out.astype("<i8").view(np.uint8)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated added (as one struct
    column ``hits``, or a longer name where that is taken)."""
    return _flag(docs, docs, benchmark, window, shingle)


def _flag(docs: DataFrame, kept: DataFrame, benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """``decontaminate``, with only the columns of ``kept`` (of ``docs``) beside the hits."""
    name = fresh(kept.columns, "hits")
    # a hit depends on the text alone, so equal texts are one document here
    base = docs.select(whole_row(kept), F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)).alias("doc"),
                       F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text"))
    listed = materialize(map_arrow(items, _item_windows(window, shingle), "window binary, words int, tokens array<bigint>, item string"),
                         "item-windows")
    windows = listed.groupBy("window", "words").agg(F.any_value("tokens").alias("tokens"))
    tokens = windows.select("window", "words", F.posexplode("tokens").alias("at", "token"))
    # at most ``shingle`` of them
    sizes = sorted(r[0] for r in listed.select(F.least("words", F.lit(shingle))).distinct().collect())
    sent = docs.sparkSession.sparkContext.broadcast(token_filter(tokens.select("token")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _candidates(sent.value, sizes, window)(batches)

    found = map_arrow(base.select("doc", "text"), scan, "doc binary, token long, place int, around binary, own int, first int")
    # copies of a text are one from here on, and count as many as they are
    found = materialize(found.groupBy("doc", "token", "place", "around", "own").agg(F.sum("first").alias("first")), "token-places")
    documents_with = found.groupBy("token").agg(F.sum("first").alias("n"))
    prefixes = (tokens.join(documents_with, "token").groupBy("window", "words")
                .agg(F.count("*").alias("met"), F.min(F.struct("n", "token", "at")).alias("rarest"))
                # a window of which any token is in no document is in none
                .filter(F.col("met") == F.col("words") - F.least("words", F.lit(shingle)) + 1)
                .select("window", "words", "rarest.token", "rarest.at"))
    start = F.col("own") - F.col("at")
    around = F.split(F.col("around").cast("string"), " ")
    held = F.array_join(F.slice(around, F.greatest(start, F.lit(0)) + 1, F.col("words")), " ")
    hits = (found.join(prefixes, "token").filter(start >= 0)
            .filter(held == F.col("window").cast("string"))
            .select("doc", "window", (F.col("place") - F.col("at")).cast("long").alias("a"),
                    (F.col("place") - F.col("at") + F.col("words")).cast("long").alias("b")))
    hits = materialize(hits, "window-hits")
    spans = hits.groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    named = (hits.select("doc", "window").distinct().join(listed.filter("item IS NOT NULL").select("window", "item").distinct(), "window")
             .groupBy("doc").agg(F.collect_set("item").alias("items")))
    per_document = map_arrow(spans.join(named, "doc", "left").select("doc", "spans", "items"), _finish,
                             "doc binary, n_hit long, n_items long, items_sha256 string")
    # hits grow with the documents, so this is a merge by design, at every size alike
    counted = base.select("row", "doc", n_words_of("text").alias("n_words"))
    joined = counted.join(materialize(per_document, "document-hits").hint("merge"), "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    result = F.struct("n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                      F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))
    return joined.select("row.*", result.alias(name))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    flagged = _flag(own, own.select("doc_id"), benchmark, window, shingle)
    return flagged.select("doc_id", f"{flagged.columns[-1]}.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of the benchmark, columns as given."""
    flagged = decontaminate(docs, benchmark, **options)
    name = flagged.columns[-1]
    return flagged.filter(~F.col(f"{name}.contaminated")).drop(name)
