"""Operator 11: phrase collocations from vertically partitioned suffix subtrees.

Every word of a piece starts a suffix, cut off after ``max_words`` words. The tree of
all suffixes is never built whole. Its prefixes are counted first: single words, and
wherever a prefix occurs more than ``budget`` times it is replaced by its extensions by
one word (one more scan a level, only for such prefixes), up to the full depth. The
prefixes in their order are filled into groups of ``budget`` occurrences each; a group
is a range of prefixes, so its first prefix names it, and only those bounds and
the prefixes above the budget (both at most occurrences / budget in number) go to the
tasks. One further scan sends every suffix to the group of its prefix, as counted
paths over a word list; each group's subtree is built by itself: equal suffixes become
one leaf, and a node's count is the sum of the leaves below it. Nodes above a
prefix that was extended have their counts from the partitioning.

Phrases are then scored with the counts of their parts, by joins on the nodes of at
least ``min_count`` occurrences (no part of a candidate has fewer).

Memory: a scanning task holds at most ``FLUSH`` bytes of texts or one text; a building task one
group, which has at most twice ``budget`` occurrences, except for a single path of full
depth, which the scans have already counted into one row each. ``budget`` is all
that should be raised for a larger corpus: groups are tasks.

Defined results: null text has no words; a null lang is ``und``; repeated rows all
count, as do empty pieces and texts (no words); ties are ordered by phrase in the order
of UTF-8 bytes; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import map_arrow, materialize, running_total, texts

MAX_WORDS = 3
MIN_COUNT = 10
INSIDE_PERCENT = 50
TOP = 2000
BUDGET = 1 << 21  # occurrences to a group, and of the most frequent prefix that is not extended
FLUSH = 8 << 20  # bytes
MERGE = 2 << 20  # paths that a building task gathers before it merges them
NO_LANG = "und"

END = 0
# A-Z become a-z, piece ends line feeds, tabs blanks
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))


class Words:
    """The words of some texts as numbers from 1 on into ``names``."""

    def __init__(self, joined: bytes):
        raw = np.frombuffer(joined.translate(_FOLD), np.uint8)
        inside = (raw != 32) & (raw != 10)
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
        coded = words.dictionary_encode()
        self.found = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64) + 1
        self.piece = np.searchsorted(np.flatnonzero(raw == 10), starts)

    def names(self) -> list[bytes]:
        return [b"", *self.found.to_pylist()]

    def suffixes(self, depth: int) -> list[np.ndarray]:
        """For every word its suffix, a column a depth; ``END`` after the piece's last."""
        columns = [self.ids]
        for d in range(1, depth):
            after = np.zeros(len(self.ids), np.int64)
            if len(after) > d:
                after[:-d] = np.where(self.piece[d:] == self.piece[:-d], self.ids[d:], END)
            columns.append(after)
        return columns


def leaves_of(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(first row, number of each row) of the distinct paths of equal columns, in order."""
    node = columns[0]
    if len(columns) == 1:
        return np.unique(node, return_index=True, return_inverse=True)[1:]
    for c in columns[1:]:
        _, first, node = np.unique(node << 32 | c, return_index=True, return_inverse=True)
    return first, node


def totals(columns: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct paths and how often they occur, or the sums of their weights."""
    first, node = leaves_of(columns)
    if weights is None:
        sums = np.bincount(node, minlength=len(first))
    else:
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, node, weights)
    return [c[first] for c in columns], sums


def _words_of(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[tuple[bytes, Words]]:
    """Texts of (lang, text) batches by lang, in portions of ``flush`` bytes or one text."""
    waiting: dict[bytes, list[bytes]] = defaultdict(list)
    held = 0
    for batch in batches:
        for lang, text in zip(texts(batch, "lang"), texts(batch), strict=True):
            if text:
                waiting[lang].append(text)
                held += len(text)
                if held >= flush:
                    for one, found in waiting.items():
                        yield one, Words(b"\n".join(found))
                    waiting.clear()
                    held = 0
    for one, found in waiting.items():
        yield one, Words(b"\n".join(found))


def _phrase(names: list[bytes], columns: list[np.ndarray], i: int) -> bytes:
    return b" ".join([names[c[i]] for c in columns if c[i] != END])


_PREFIX = pa.schema([("lang", pa.binary()), ("phrase", pa.binary()), ("whole", pa.bool_()), ("n", pa.int64())])


def _single_words(flush: int):
    """The words with their counts, portion by portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _words_of(batches, flush):
            n = len(words.found)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.binary()).take(pa.array(np.zeros(n, np.int32))), words.found, pa.array([True] * n),
                     pa.array(np.bincount(words.ids, minlength=n + 1)[1:], pa.int64())], schema=_PREFIX)
    return run


def _extensions(level: int, heavy: set[tuple[bytes, bytes]], flush: int):
    """Counted prefixes of ``level`` words (or one fewer, where the piece ends) below heavy ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _words_of(batches, flush):
            names, columns = words.names(), words.suffixes(level)
            own = {phrase for one, phrase in heavy if one == lang}
            leading = {phrase.split(b" ")[0] for phrase in own}
            some = np.array([w in leading for w in names], bool)[columns[0]]
            columns = [c[some] for c in columns]
            if not len(columns[0]):
                continue
            first, node = leaves_of(columns[:-1])
            below = np.array([_phrase(names, columns[:-1], i) in own for i in first.tolist()], bool)[node]
            below &= columns[level - 2] != END
            paths, n = totals([c[below] for c in columns])
            phrases = [_phrase(names, paths, i) for i in range(len(n))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.binary()), pa.array(phrases, pa.binary()), pa.array(paths[-1] != END),
                 pa.array(n, pa.int64())], schema=_PREFIX)
    return run


def prefix_key(lang: bytes, phrase: bytes) -> bytes:
    return lang + b"\0" + phrase


_BLOCK = pa.schema([("group", pa.int32()), ("lang", pa.binary()), ("words", pa.binary()), ("paths", pa.binary())])


def _blocks(depth: int, bounds: list[bytes], heavy: list[set], flush: int):
    """Counted suffixes, a block for each group and lang: its words, then a column a depth
    of their numbers, then the counts."""

    def groups_of(lang: bytes, columns: list[np.ndarray], names: list[bytes]) -> np.ndarray:
        # one word decides, unless it is a prefix that was extended
        extended = {phrase for many in heavy for one, phrase in many if one == lang}
        head = prefix_key(lang, b"")
        by_word = np.array([-1 if w in extended and depth > 1 else bisect_right(bounds, head + w) - 1 for w in names], np.int32)
        group = by_word[columns[0]]
        for level in range(2, depth + 1):
            open_ = np.flatnonzero(group < 0)
            if not len(open_):
                break
            part = [c[open_] for c in columns[:level]]
            first, node = leaves_of(part)
            own = np.empty(len(first), np.int32)
            for j, i in enumerate(first.tolist()):
                phrase = _phrase(names, part, i)
                longer = level < depth and part[-1][i] != END and phrase in extended
                own[j] = -1 if longer else bisect_right(bounds, head + phrase) - 1
            group[open_] = own[node]
        return group

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _words_of(batches, flush):
            if not len(words.ids):
                continue
            names = words.names()
            paths, n = totals(words.suffixes(depth))
            group = groups_of(lang, paths, names)
            order = np.argsort(group, kind="stable")
            ends = np.flatnonzero(np.diff(group[order], append=-2)) + 1
            rows, at = [], 0
            for end in ends.tolist():
                here = order[at:end]
                used, local = np.unique(np.stack([c[here] for c in paths]), return_inverse=True)
                table = np.concatenate([local.reshape(depth, -1), n[here][None]])  # all below 2**31
                rows.append((int(group[order[at]]), lang, b" ".join([names[u] for u in used.tolist()]),
                             table.astype("<i4").tobytes()))
                at = end
                if len(rows) == 64 or at == len(order):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)
                    rows = []
    return run


def _subtrees(depth: int, least: int, heavy: list[set], held: int):
    """The nodes of at least ``least`` occurrences and two words of one group's subtree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = defaultdict(count().__next__)
        assert number[b""] == END
        trees: dict[bytes, tuple[list[np.ndarray], np.ndarray]] = {}
        waiting: dict[bytes, list[np.ndarray]] = defaultdict(list)
        n_waiting = 0

        def merge():
            for lang, tables in waiting.items():
                if lang in trees:
                    tables.append(np.concatenate([np.stack(trees[lang][0]), trees[lang][1][None]]))
                both = np.concatenate(tables, axis=1)
                trees[lang] = totals(list(both[:-1]), both[-1])
            waiting.clear()

        for batch in batches:
            for lang, words, paths in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist()
                                            for c in ("lang", "words", "paths")), strict=True):
                numbers = np.array([number[w] for w in words.split(b" ")], np.int64)
                table = np.frombuffer(paths, "<i4").reshape(depth + 1, -1).astype(np.int64)
                table[:-1] = numbers[table[:-1]]
                waiting[lang].append(table)
                n_waiting += table.shape[1]
                if n_waiting >= held:
                    merge()
                    n_waiting = 0
        merge()
        names = list(number)
        for lang, (leaves, n) in trees.items():
            for level in range(2, depth + 1):
                inside = leaves[level - 1] != END
                paths, sums = totals([c[inside] for c in leaves[:level]], n[inside])
                rows = []
                for i in np.flatnonzero(sums >= least).tolist():
                    phrase = _phrase(names, paths, i)
                    if level == depth or (lang, phrase) not in heavy[level - 1]:
                        rows.append((lang, phrase, level, int(sums[i])))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.binary(), pa.int32(), pa.int64()), strict=True)],
                        names=["lang", "phrase", "n_words", "n"])
    return run


def phrase_counts(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                  budget: int = BUDGET, flush: int = FLUSH) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, n) of all phrases of 1 to ``max_words`` words that occur
    ``min_count`` times at least, and (lang, n) with the words of every lang."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                      F.col("text").cast("string").alias("text"))
    counted: list[DataFrame] = []
    heavy: list[set[tuple[bytes, bytes]]] = []
    for level in range(1, max_words + 1):
        above = heavy[-1] if heavy else set()
        if level > 1 and not above:
            heavy.append(set())
            continue
        scan = _extensions(level, above, flush) if level > 1 else _single_words(flush)
        found = map_arrow(own, scan, "lang binary, phrase binary, whole boolean, n long")
        found = materialize(found.groupBy("lang", "phrase", "whole").agg(F.sum("n").alias("n")), "phrase-prefixes")
        counted.append(found.withColumn("level", F.lit(level)))
        # at most occurrences / budget of them
        many = found.filter(F.col("whole") & (F.col("n") > budget)).collect() if level < max_words else []
        heavy.append({(bytes(r["lang"]), bytes(r["phrase"])) for r in many})

    prefixes = None
    for one in counted:
        kept = one.filter(~(F.col("whole") & (F.col("n") > budget) & (F.col("level") < max_words)))
        prefixes = kept if prefixes is None else prefixes.unionByName(kept)
    keyed = prefixes.select(F.concat("lang", F.lit(b"\0"), "phrase").alias("key"), "n")
    filled = running_total(keyed, ["key", "n"], "n", "phrase-groups")
    group = F.floor(F.col("before") / F.lit(budget))
    # one bound for each group: at most occurrences / budget of them
    bounds = sorted(bytes(r["key"]) for r in filled.groupBy(group.alias("group")).agg(F.min("key").alias("key")).collect())

    text = F.col("phrase").cast("string")
    words = counted[0].select(F.col("lang").cast("string").alias("lang"), text.alias("phrase"), "n")
    parts = [words.filter(F.col("n") >= min_count).select("lang", "phrase", F.lit(1).alias("n_words"), "n")]
    for one, many in zip(counted[1:], heavy[1:], strict=False):
        if many:  # counted whole by the partitioning; their subtrees lie in several groups
            parts.append(one.filter(F.col("whole") & (F.col("n") > max(budget, min_count - 1))).select(
                F.col("lang").cast("string").alias("lang"), text.alias("phrase"), F.col("level").alias("n_words"), "n"))
    if bounds and max_words > 1:
        blocks = map_arrow(own, _blocks(max_words, bounds, heavy, flush), "group int, lang binary, words binary, paths binary")
        nodes = map_arrow(blocks.repartitionById(len(bounds), F.col("group")).select("lang", "words", "paths"),
                          _subtrees(max_words, min_count, heavy, MERGE), "lang binary, phrase binary, n_words int, n long")
        parts.append(nodes.select(F.col("lang").cast("string").alias("lang"), text.alias("phrase"), "n_words", "n"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return materialize(every, "phrase-counts"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                 inside_percent: int = INSIDE_PERCENT, top: int | None = TOP, budget: int = BUDGET,
                 flush: int = FLUSH) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's best ``top`` phrases (None: of all)."""
    counts, sizes = phrase_counts(docs, max_words, min_count, budget, flush)
    phrases = counts.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("n").alias("a"))
    split = phrases.withColumn("w", F.split("phrase", " "))
    cuts = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.expr("slice(w, 1, k)"), " ").alias("left_part"),
        F.array_join(F.expr("slice(w, k + 1, size(w) - k)"), " ").alias("right_part"))
    first = counts.select("lang", F.col("phrase").alias("left_part"), F.col("n").alias("l"))
    rest = counts.select("lang", F.col("phrase").alias("right_part"), F.col("n").alias("r"))
    wide = "decimal(38,0)"
    scored = (cuts.join(first, ["lang", "left_part"]).join(rest, ["lang", "right_part"])
              .withColumn("score", F.expr(f"(cast(a as {wide}) * a * 1000000) div (cast(l as {wide}) * r)")))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # the most frequent candidate that holds a phrase
    inner = split.filter("n_words > 2").select(
        "lang", "a", "w", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size")).select(
        "lang", "a", "w", "size", F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("at")).select(
        "lang", F.array_join(F.expr("slice(w, at, size)"), " ").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (lowest.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent)))
    flat = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(by).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
