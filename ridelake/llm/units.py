"""Operator 4: removal of repeated lines, paragraphs or clauses by hash.

A document is parted into units that cover it without a gap: lines, paragraphs
(between empty lines), or clauses (up to a mark that ends one, or a line's end), each
with the marks and blanks behind it. Every unit that isn't blank is normalised (A-Z in
lower case, runs of ASCII white space to one blank, none at the ends) and digested. Over
the whole corpus, equal digests are one group, whose earliest occurrence, by
(doc_id, key of the row, place), is kept. The keepers go back to their documents: a unit
that is not its document's keeper is a repeat, so the (possibly very large) groups
themselves are never joined or gathered.

Repeats that follow each other are a run. A run of at least ``least_words`` words goes;
shorter ones, phrases that any two texts may share, stay. ``least_words`` of 1 removes
every repeat, unit by unit; how many there are is reported in any case. Clauses are the
finest units, so a passage that begins and ends inside lines is met but for its
two broken ends. A unit's words are those between blanks, or a word for every
``WORD_CHARS`` characters of its normal form where that is more, so scripts and strings
without blanks count like others.

The removed runs' original places (start, end in code points) are retained, as are
those of what is left; what is left is the text less those places.

Defined results: null text stays null, without units; empty texts and blank units are
left as they are; rows repeated as a whole are one document, so they keep the same
units; a row without id ranks after all ids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import RANK_BYTES, carrying, document_rank, fresh, map_arrow, materialize, texts, whole_row

LEAST_WORDS = 30
WORD_CHARS = 6
CLAUSE_ENDS = ".,;:!?。，、；：！？"
UNITS = {
    "line": re.compile(r"[^\n]*\n|[^\n]+"),
    "paragraph": re.compile(r"(?s:.)+?(?:\n(?:[ \t\r]*\n)+|\Z)"),
    "clause": re.compile(rf"[^\n{CLAUSE_ENDS}]+(?:[\n{CLAUSE_ENDS}][\n{CLAUSE_ENDS}\x20\x09-\x0D]*)?|[\n{CLAUSE_ENDS}][\n{CLAUSE_ENDS}\x20\x09-\x0D]*"),
}
_ROWS = 1 << 15  # units to an Arrow batch


def normal_form(unit: str) -> bytes:
    return b" ".join(unit.encode().lower().split())


def words_in(norm: bytes) -> int:
    """Words of a normal form: between blanks, or by its characters where that is more."""
    return max(norm.count(b" ") + 1, len(norm.decode()) // WORD_CHARS) if norm else 0


def _digests(unit: str):
    """The first of equal units of each document: digest, and rank (document, then place)."""
    schema = pa.schema([("digest", pa.binary()), ("rank", pa.binary())])
    parts = UNITS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, ranks = [], []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ranks, pa.binary())], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                seen = set()
                for place, m in enumerate(parts.finditer(text.decode()) if text else ()):
                    norm = normal_form(m.group())
                    digest = hashlib.blake2b(norm, digest_size=16).digest() if norm else None
                    if norm and digest not in seen:  # later ones can't be the earliest
                        seen.add(digest)
                        digests.append(digest)
                        ranks.append(doc + place.to_bytes(4, "big"))
                        if len(ranks) == _ROWS:
                            yield batch_of()
                            digests, ranks = [], []
        if ranks:
            yield batch_of()
    return run


def _spans(unit: str, least_words: int):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    result = pa.struct([("text", pa.string()), ("n_units", pa.int64()), ("n_repeated", pa.int64()), ("n_removed", pa.int64()),
                        ("removed", span), ("kept", span)])
    parts = UNITS[unit]

    def one(raw: bytes | None, keeps: list[bytes] | None) -> dict:
        if raw is None:
            return {"text": None, "n_units": 0, "n_repeated": 0, "n_removed": 0, "removed": [], "kept": []}
        text, own = raw.decode(), {int.from_bytes(k, "big") for k in keeps or ()}
        units = repeated = gone = 0
        removed, run, words = [], [], 0

        def close():
            nonlocal gone
            if run and words >= least_words:
                gone += len(run)
                removed.append((run[0].start(), run[-1].end()))

        for place, m in enumerate(parts.finditer(text)):
            norm = normal_form(m.group())
            if not norm:
                continue
            units += 1
            if place in own:
                close()
                run, words = [], 0
            else:
                repeated += 1
                run.append(m)
                words += words_in(norm)
        close()
        kept, at = [], 0
        for a, b in [*removed, (len(text), len(text))]:
            if at < a:
                kept.append((at, a))
            at = b
        return {"text": "".join(text[a:b] for a, b in kept), "n_units": units, "n_repeated": repeated, "n_removed": gone,
                "removed": [{"start": a, "end": b} for a, b in removed], "kept": [{"start": a, "end": b} for a, b in kept]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(t, k) for t, k in zip(texts(batch), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, result)], names=["row", "result"])
    return run


def remove_repeated_units(docs: DataFrame, unit: str = "clause", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with a struct column ``units`` (or a longer name where that is taken): the text
    left, the numbers of units, of repeats and of removed ones, removed and kept spans."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    name = fresh(docs.columns, "units")
    keyed = docs.select(whole_row(docs), document_rank().alias("doc"), F.col("text").cast("string").alias("text"))
    digests = map_arrow(keyed.select("doc", "text"), _digests(unit), "digest binary, rank binary")
    earliest = digests.groupBy("digest").agg(F.min("rank").alias("rank"))
    keepers = materialize(earliest.groupBy(F.substring("rank", 1, RANK_BYTES).alias("doc")).agg(
        F.collect_list(F.substring("rank", RANK_BYTES + 1, 4)).alias("keeps")), "unit-keepers")
    joined = keyed.join(keepers, "doc", "left").select("row", "text", "keeps")
    spans = "array<struct<start:bigint,end:bigint>>"
    done = map_arrow(joined, _spans(unit, least_words), carrying(
        joined, f"result struct<text:string,n_units:bigint,n_repeated:bigint,n_removed:bigint,removed:{spans},kept:{spans}>"))
    return done.select("row.*", F.col("result").alias(name))


def unit_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text left, numbers of units, repeats and removed ones, and the removed spans as text."""
    done = remove_repeated_units(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), **options)
    found = done.columns[-1]
    return done.select(
        "doc_id", *[F.col(f"{found}.{c}").alias(c) for c in ("text", "n_units", "n_repeated", "n_removed")],
        F.array_join(F.transform(f"{found}.removed", lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("removed"))
