"""Operator 2: line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``window`` lines chooses lines; a chunk ends
before and after each chosen line (and every ``longest`` lines where none is chosen). With
a window of one line a chunk within a repeated passage hangs on the passage's own lines
alone, whatever has been put before or after it. At a passage's borders the lines
that aren't chosen share a chunk with strange ones, so every text is chunked under
``seeds`` independent choices: a line is lost only where no choice parts it from the
strangers. All chunks' digests are grouped over the corpus; those that occur once go
back to their documents, and every line of another chunk is a candidate.

Neighbouring candidate chunks are joined. Of the joined runs of two and more lines,
each pair of neighbouring filled lines, with what stands between them, is compared with
those of the whole corpus byte by byte (grouped by hash and bytes). Of equal pairs the
earliest by (doc_id, key of the row, place) is kept, the others go; overlapping pairs go
as one run. So nothing goes that isn't repeated, and equal digests alone never remove
anything. In both rounds only what is single or kept goes back to documents, so a group
of any size is only ever aggregated.

Defined results: null text stays null; empty texts, single lines (with blank lines
around them too) and runs of blank lines are left as they are, and a line feed at a text's
end starts no line; the first occurrence of every line stays; rows repeated as a
whole are one document, so they keep the same pairs; a row without id ranks after all
ids; an empty table gives no rows. ``n_removed`` counts the pairs of lines that went.
``n_chars``, where it is a column, is set to the new length of texts that lost one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import RANK_BYTES, carrying, document_rank, map_arrow, materialize, texts, whole_row

_BATCH_BYTES = 4 << 20
_WEIGHT = 0x9E3779B97F4A7C15  # odd: of the rolling hash


@dataclass(frozen=True)
class Chunking:
    window: int = 1
    divisor: int = 2  # of so many lines one is chosen
    seeds: int = 6  # at most 8
    longest: int = 64

    def __post_init__(self):
        if self.window < 1 or not 1 <= self.seeds <= 8 or not 1 <= self.divisor <= 128 or self.longest < 1:
            raise ValueError("window and longest from 1, seeds from 1 to 8, divisor from 1 to 128")


def lines_of(text: bytes) -> tuple[list[bytes], list[int]]:
    """The lines, and where each starts in bytes (one more: past the last line feed)."""
    parts = text.removesuffix(b"\n").split(b"\n")
    starts = [0]
    for part in parts:
        starts.append(starts[-1] + len(part) + 1)
    return parts, starts


def chunks_of(parts: list[bytes], how: Chunking) -> list[tuple[int, int]]:
    """(first, last) line of the distinct chunks under all seeds, without those of blank lines only."""
    rolled = [xxhash.xxh64_intdigest(p) for p in parts]
    if how.window > 1:  # over the window that ends with each line
        rolled = [sum(h * _WEIGHT ** back for back, h in enumerate(reversed(rolled[max(0, i + 1 - how.window):i + 1]))) % 2 ** 64
                  for i in range(len(rolled))]
    divisor, longest, found = how.divisor, how.longest, set()
    for shift in range(0, 8 * how.seeds, 8):  # each choice has eight bits of its own
        start = 0
        for i, h in enumerate(rolled):
            if not (h >> shift & 255) % divisor:
                if start < i:
                    found.update((a, min(a + longest, i) - 1) for a in range(start, i, longest))
                found.add((i, i))
                start = i + 1
        if start < len(parts):
            found.update((a, min(a + longest, len(parts)) - 1) for a in range(start, len(parts), longest))
    before = list(accumulate((1 if p.strip() else 0 for p in parts), initial=0))  # filled lines
    return sorted(c for c in found if before[c[1] + 1] > before[c[0]])


def pairs_in(parts: list[bytes], starts: list[int], length: int, among: set[int] | None = None) -> list[tuple[int, int, int]]:
    """(place, start, end) of the pairs of neighbouring filled lines, places from 0 over all of
    them; with ``among`` only pairs of those lines. An end is past the second line's feed."""
    filled = [i for i, p in enumerate(parts) if p.strip()]
    return [(k, starts[a], min(length, starts[b + 1])) for k, (a, b) in enumerate(zip(filled, filled[1:]))
            if among is None or a in among and b in among]


def _emit(rows: list[tuple[bytes, bytes]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], schema=schema)


def _in_batches(found: Iterator[tuple[bytes, bytes]], names: list[str]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.binary()) for n in names])
    rows, held = [], 0
    for row in found:
        rows.append(row)
        held += 64 + len(row[1])
        if held >= _BATCH_BYTES:
            yield _emit(rows, schema)
            rows, held = [], 0
    if rows:
        yield _emit(rows, schema)


def _digests(how: Chunking):
    """Every chunk: its rank (document, then place) and digest."""

    def rows(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                if text and b"\n" in text:  # else there are no two lines
                    parts, _ = lines_of(text)
                    for place, (a, b) in enumerate(chunks_of(parts, how)):
                        yield doc + place.to_bytes(4, "big"), hashlib.blake2b(b"\n".join(parts[a:b + 1]), digest_size=16).digest()

    return lambda batches: _in_batches(rows(batches), ["rank", "digest"])


def _places(found: list[bytes] | None) -> set[int]:
    return {int.from_bytes(f, "big") for f in found or ()}


def candidates_in(text: bytes, single: set[int], how: Chunking) -> list[tuple[int, int, int]]:
    """The pairs of neighbouring lines in the joined chunks that aren't single."""
    parts, starts = lines_of(text)
    among = {i for place, (a, b) in enumerate(chunks_of(parts, how)) if place not in single for i in range(a, b + 1)}
    return pairs_in(parts, starts, len(text), among)


def _candidates(how: Chunking):
    """Every candidate pair: its rank and bytes, without the last line feed, so that a
    pair at a text's end equals one inside."""

    def rows(batches):
        for batch in batches:
            for doc, text, alone in zip(batch.column(0).to_pylist(), texts(batch), batch.column(2).to_pylist(), strict=True):
                if text and b"\n" in text:
                    for place, a, b in candidates_in(text, _places(alone), how):
                        yield doc + place.to_bytes(4, "big"), text[a:b].removesuffix(b"\n")

    return lambda batches: _in_batches(rows(batches), ["rank", "raw"])


def _apply(how: Chunking):
    def one(text: bytes | None, alone: list[bytes] | None, keeps: list[bytes] | None) -> tuple[str | None, int]:
        if text is None or b"\n" not in text:
            return text if text is None else text.decode(), 0
        kept = _places(keeps)
        gone = [(a, b) for place, a, b in candidates_in(text, _places(alone), how) if place not in kept]
        if not gone:
            return text.decode(), 0
        left, at = [], 0
        for a, b in gone:
            left.append(text[at:a])  # nothing where pairs overlap
            at = b
        left.append(text[at:])
        new = b"".join(left)
        if at == len(text) and not text.endswith(b"\n"):
            new = new.removesuffix(b"\n")  # the line feed before a removed end
        return new.decode(), len(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alone, keeps = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("alone", "keeps"))
            done = [one(*row) for row in zip(texts(batch), alone, keeps, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row")), pa.array([d[0] for d in done], pa.string()),
                 pa.array([d[1] for d in done], pa.int64())], names=["row", "text", "n_removed"])
    return run


def _by_document(ranks: DataFrame, name: str) -> DataFrame:
    """The places of (rank) rows, gathered by document."""
    return ranks.groupBy(F.substring("rank", 1, RANK_BYTES).alias("doc")).agg(
        F.collect_list(F.substring("rank", RANK_BYTES + 1, 4)).alias(name))


def _mark(docs: DataFrame, how: Chunking) -> DataFrame:
    """row (struct of all columns), text (what is left), n_removed."""
    keyed = docs.select(document_rank().alias("doc"), F.col("text").cast("string").alias("text"), whole_row(docs))
    chunks = map_arrow(keyed.select("doc", "text"), _digests(how), "rank binary, digest binary")
    groups = chunks.groupBy("digest").agg(F.min("rank").alias("rank"), F.count("*").alias("n"))
    alone = materialize(_by_document(groups.filter("n = 1"), "alone"), "lone-chunks")
    searched = keyed.select("doc", "text").join(alone, "doc", "left").select("doc", "text", "alone")
    pairs = map_arrow(searched, _candidates(how), "rank binary, raw binary")
    first = pairs.groupBy(F.xxhash64("raw").alias("hash"), "raw").agg(F.min("rank").alias("rank"))
    kept = materialize(_by_document(first, "keeps"), "pair-keepers")
    # the text travels inside its row, once
    both = keyed.select("doc", "row").join(alone, "doc", "left").join(kept, "doc", "left").select(
        "row", F.col("row.text").cast("string").alias("text"), "alone", "keeps")
    return map_arrow(both, _apply(how), carrying(both, "text string, n_removed long"))


def remove_repeated_chunks(docs: DataFrame, **options) -> DataFrame:
    """The documents without repeated runs of lines, columns as given. Options: those of ``Chunking``."""
    done = _mark(docs, Chunking(**options))
    lost = F.col("n_removed") > 0

    def column(c: str):
        if c == "text":
            return F.col("text").alias(c)
        own = F.col("row").getField(c)
        if c == "n_chars":
            own = F.when(lost, F.length("text").cast(docs.schema[c].dataType)).otherwise(own)
        return own.alias(c)

    return done.select(*[column(c) for c in docs.columns])


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text left and number of removed pairs of lines, of every document."""
    done = _mark(docs.select("doc_id", "text"), Chunking(**options))
    return done.select(F.col("row.doc_id").cast("long").alias("doc_id"), "text", "n_removed")
