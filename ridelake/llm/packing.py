"""Operator 1: harmonic packing of tokenised documents into fixed sequences.

Lengths are divided into reciprocal-capacity classes: class ``k`` holds pieces
of at most ``capacity // k`` tokens, and one of its bins takes exactly ``k``
pieces. Every worker (partition) fills the bins of each class on its own, in
one pass and without a shuffle.

A document's whole capacities become sequences of their own. Its rest stays
whole when ``k`` such pieces leave at most ``slack`` tokens of a bin empty;
otherwise a head of exactly ``capacity // (k + 1)`` tokens is cut off (that
class's bins leave next to nothing empty) and the tail is classed again. When
a worker's input ends, the pieces of its open bins (fewer than one bin a
class) are poured together into full sequences; what is left over is cut into
power-of-two sequences, which need no padding.

Defined results: null text counts as empty (its one token is the end id);
every row is packed, repeated rows and null ids included; an empty table gives
no rows; ties need no rule, a bin takes pieces in row order.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import map_arrow, partition_id

CAPACITY = 2048
SLACK = 12          # tokens a bin may leave empty before a piece is cut
END_ID = 1
CACHE_WORDS = 200_000
STEP_BYTES = 16 << 20

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def cut(rest: int, capacity: int = CAPACITY, slack: int = SLACK) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document rest below ``capacity``."""
    pieces = []
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack or capacity // (k + 1) == 0:
            pieces.append((k, rest))
            break
        head = capacity // (k + 1)
        pieces.append((k + 1, head))
        rest -= head
    return pieces


class Packer:
    """The open bins of one worker."""

    def __init__(self, first_sequence: int = 0, capacity: int = CAPACITY, slack: int = SLACK):
        self.capacity, self.sequence = capacity, first_sequence
        self.bins: dict[int, list[tuple]] = {}
        self.cut = lru_cache(maxsize=None)(lambda rest: cut(rest, capacity, slack))

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids) // 4, zlib.crc32(ids), total, self.sequence, offset
            offset += len(ids) // 4
        self.sequence += 1

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        """Rows of the sequences that the document's ids (uint32) complete."""
        total, start = len(ids) // 4, 0
        while total - start >= self.capacity:
            end = start + self.capacity
            yield from self._close([(doc_id, start, ids[4 * start:4 * end], total)])
            start = end
        for k, length in self.cut(total - start):
            end = start + length
            pieces = self.bins.setdefault(k, [])
            pieces.append((doc_id, start, ids[4 * start:4 * end], total))
            if len(pieces) == k:
                yield from self._close(self.bins.pop(k))
            start = end

    def finish(self) -> Iterator[tuple]:
        """Pours the open bins together; the remainder ends in power-of-two sequences."""
        left = [p for k in sorted(self.bins) for p in self.bins[k]]
        self.bins = {}
        tokens = sum(len(ids) // 4 for _, _, ids, _ in left)
        sizes = [self.capacity] * (tokens // self.capacity)
        rest = tokens % self.capacity
        sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        pieces, room = [], 0
        todo = iter(sizes)
        for doc, start, ids, total in left:
            while ids:
                room = room or next(todo)
                now, ids = ids[:4 * room], ids[4 * room:]
                pieces.append((doc, start, now, total))
                start += len(now) // 4
                room -= len(now) // 4
                if not room:
                    yield from self._close(pieces)
                    pieces = []


class WordEncoder:
    """Token ids of texts as little-endian uint32 bytes, computed word by word.

    The vocabulary never merges across white space, so a text's ids are the ids
    of its words joined. A step splits its texts, encodes each distinct word
    once and takes the ids of all places from those. Words of Latin letters
    with a tail of punctuation go straight to the merge model, remembered by
    their letters (at most ``CACHE_WORDS``); any other word goes through the
    whole tokenizer.
    """

    # letters whose lower case and composed form are the same in every library
    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?-@\\[-`{-~]*)")

    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.merge = self.tokenizer.model.tokenize
        # visible stand-ins of byte-level vocabularies: printable Latin-1 bytes
        # are themselves, the others follow from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.visible = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known: dict[str, bytes] = {"": b""}

    def _letters(self, letters: str) -> bytes:
        """Ids of a run of letters or of a run of punctuation."""
        ids = self.known.get(letters)
        if ids is None:
            shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.visible)
            get = self.id_bytes
            ids = b"".join([get[t.id] for t in self.merge(shown)])
            if len(self.known) >= CACHE_WORDS:
                self.known = {"": b""}
            self.known[letters] = ids
        return ids

    def word(self, word: str) -> bytes:
        m = self.PLAIN.fullmatch(word)
        if m is None:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        letters, tail = m.groups()
        ids = self._letters(letters.lower())
        return ids + self._letters(tail) if tail else ids

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of every text of a string column; null counts as empty."""
        column = pc.fill_null(column, "")
        for space in "\n\t\r":
            column = pc.replace_substring(column, space, " ")
        words = pc.split_pattern(column, " ")
        distinct = words.flatten().dictionary_encode()
        # none of the many small objects made here refer to each other
        gc.disable()
        try:
            of = pa.array([self.word(w) if w else b"" for w in distinct.dictionary.to_pylist()], pa.large_binary())
        finally:
            gc.enable()
        ids = of.take(distinct.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8) if len(ids) else np.zeros(1, np.int64)
        data = ids.buffers()[2]
        ends = places[words.offsets.to_numpy()]
        return [bytes(data[a:b]) if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[pa.Array]:
    """Slices of a text column of at most ``most`` bytes each, or of one text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield column.slice(at, end - at)
        at = end


@lru_cache(maxsize=2)
def encoder(tokenizer_path: str) -> WordEncoder:
    """One encoder a Python worker, kept between its tasks."""
    return WordEncoder(tokenizer_path)


def _pack(tokenizer_path: str, capacity: int, slack: int) -> Callable:
    end = np.array([END_ID], "<u4").tobytes()
    arrow = pa.schema([(n.split()[0], pa.int64()) for n in SCHEMA.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        packer = Packer(partition_id() << 40, capacity, slack)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=arrow)

        for batch in batches:
            rows: list[tuple] = []
            doc_ids = iter(batch.column(0).to_pylist())
            for part in steps(batch.column(1)):
                for ids in words.encode(part):
                    rows += packer.add(next(doc_ids), ids + end)
            if rows:
                yield out(rows)
        rows = list(packer.finish())
        if rows:
            yield out(rows)

    return pack


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   slack: int = SLACK) -> DataFrame:
    """One row per piece of a document: its place in the document (``start``,
    ``length``), checksum, and its place in a sequence (``sequence_id``, ``offset``)."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(chosen, _pack(tokenizer_path, capacity, slack), SCHEMA)
