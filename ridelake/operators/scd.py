"""Slowly changing dimension, type 2, from a history of full snapshots.

A snapshot opens a new version when it is the key's first row, when the
previous snapshot's first tracked attribute is NULL, or when any tracked
attribute differs from the previous snapshot under SQL three-valued ``!=``
(so a NULL <-> value change alone does NOT open a version). Untracked
columns keep the values of the version's first snapshot. A version is
valid on ``[valid_from, next version's valid_from)``; the last one is open
(sentinel end, ``is_current = true``).

Plan: change detection (``lag``) and validity end (``lead``) share one
partitioning and ordering, so an ordinary key costs one Exchange + Sort.
A key whose history exceeds ``hot_key_rows`` would put all of it into one
window partition (one task); such *hot* keys are found by a cheap counting
pass and their rows are range-partitioned on (key, time) into contiguous
chunks of about ``hot_key_rows`` rows (sampled range bounds). Each chunk is
windowed on its own; the only cross-chunk facts needed -- the last snapshot
before a chunk and the first version after it -- come from two small
aggregates (one row per key and chunk) joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions.scalars import open_end, surrogate_key
from ridelake.session import ensure_checkpoint_dir

_PREV = "__prev_"
DEFAULT_HOT_KEY_ROWS = 2_000_000


def change_predicate(tracked: Sequence[str], prev_prefix: str = _PREV) -> Column:
    """``prev_first IS NULL OR a != prev_a OR ...`` with SQL NULL semantics;
    a NULL comparison counts as 'no change' (a WHERE keeps only TRUE)."""
    arms = [f"`{prev_prefix}{tracked[0]}` IS NULL"]
    arms += [f"`{c}` != `{prev_prefix}{c}`" for c in tracked]
    return F.expr("coalesce(" + " OR ".join(arms) + ", false)")


def finish_versions(versions: DataFrame, key: str, valid_from: str, sk_name: str,
                    columns: Sequence[str]) -> DataFrame:
    """Add surrogate key, closed/open validity end and the current flag."""
    return versions.select(
        surrogate_key(key, valid_from).alias(sk_name),
        *columns,
        valid_from,
        F.coalesce(F.col("__valid_to"), open_end()).alias("valid_to"),
        F.col("__valid_to").isNull().alias("is_current"),
    )


def _versions_one_window(base: DataFrame, key: str, tracked: Sequence[str], valid_from: str,
                         order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    with_prev = base.select("*", *[F.lag(c).over(w).alias(_PREV + c) for c in tracked])
    changes = with_prev.filter(change_predicate(tracked)).select(*base.columns)
    return changes.withColumn("__valid_to", F.lead(valid_from).over(w))


def _join_on_key_chunk(rows: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """LEFT join a (key, chunk) boundary table; NULL keys are a real group
    (as in a window partition), so the key comparison is null-safe."""
    s = small.withColumnRenamed(key, "__bk").withColumnRenamed("__c", "__bc")
    cond = rows[key].eqNullSafe(s["__bk"]) & (rows["__c"] == s["__bc"])
    return rows.join(s, cond, "left").drop("__bk", "__bc")


def _versions_chunked(base: DataFrame, key: str, tracked: Sequence[str], valid_from: str,
                      order: list[Column], chunks: int) -> DataFrame:
    """Same result as :func:`_versions_one_window` for keys with huge
    histories. The hot keys' rows are range-partitioned on (key, time) into
    ``chunks`` contiguous, sample-balanced ranges (Spark computes the range
    bounds once per shuffle, so retried tasks see the same assignment); the
    range is the chunk id, so per-task work is about rows/chunks however
    skewed a single key is."""
    # several branches read the chunk id: checkpoint once so all of them see
    # the same range bounds (separately planned range exchanges could sample
    # different bounds), which also cuts the lineage of the hot rows
    ensure_checkpoint_dir(base.sparkSession)
    b = (base.repartitionByRange(chunks, F.col(key), *order)
         .withColumn("__c", F.spark_partition_id())
         .checkpoint(eager=True))
    w = Window.partitionBy(key, "__c").orderBy(*order)
    per_key = Window.partitionBy(key).orderBy("__c")
    ordering = F.struct(*order)

    # Both boundary tables below have one row per (key, chunk) pair present in
    # the hot rows: chunks are contiguous (key, time) ranges, so there are at
    # most chunks + hot keys such pairs. Spark decides by their size how to join them.
    # last snapshot of the previous non-empty chunk (input-side aggregate)
    last = b.groupBy(key, "__c").agg(F.max_by(F.struct(*tracked), ordering).alias("__last"))
    prev_last = last.select(key, "__c", F.lag("__last").over(per_key).alias("__pl"))
    lagged = b.select("*", *[F.lag(c).over(w).alias(_PREV + c) for c in tracked],
                      F.row_number().over(w).alias("__rn"))
    fixed = _join_on_key_chunk(lagged, prev_last, key).select(
        *b.columns,
        *[F.when(F.col("__rn") == 1, F.col("__pl")[c]).otherwise(F.col(_PREV + c)).alias(_PREV + c)
          for c in tracked])
    kept = fixed.filter(change_predicate(tracked)).select(*b.columns)

    # first version of the next chunk that has one
    firsts = kept.groupBy(key, "__c").agg(F.min(ordering).alias("__fk"))
    next_first = firsts.select(key, "__c",
                               F.lead(F.col("__fk")[valid_from]).over(per_key).alias("__nb"))
    ver = kept.select("*", F.lead(valid_from).over(w).alias("__next"),
                      F.lead(F.lit(1)).over(w).alias("__has_next"))
    ver = _join_on_key_chunk(ver, next_first, key)
    valid_to = F.when(F.col("__has_next").isNotNull(), F.col("__next")).otherwise(F.col("__nb"))
    return ver.select(*base.columns, valid_to.alias("__valid_to"))


def _may_be_hot(base: DataFrame, hot_key_rows: int) -> bool:
    """False when the whole history has no more than ``hot_key_rows`` rows, so that no key
    needs counting by itself (both plans give the same rows). The rows are counted
    without reading a column; a history of fewer bytes than that isn't even counted."""
    size = base._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) > hot_key_rows and base.count() > hot_key_rows


def _hot_stats(hot_counts: DataFrame) -> tuple[int, int]:
    """(hot keys, rows of hot keys) from one aggregate job."""
    row = hot_counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    return int(row[0]), int(row[1])


def with_order(snapshots: DataFrame, ts: str, valid_from: str, tiebreak: Sequence[str] | None = None
               ) -> tuple[DataFrame, list[Column]]:
    """The snapshots with ``ts`` named ``valid_from`` and a final tiebreak ``__tb``, and
    the order of a key's snapshots. The tiebreak is a real column, so lag and lead see
    the same sort key and Spark sorts once for both windows."""
    renamed = snapshots.withColumnRenamed(ts, valid_from)
    base = renamed.withColumn(
        "__tb", F.expr("xxhash64(" + ", ".join(f"`{c}`" for c in renamed.columns) + ")"))
    return base, [F.col(valid_from)] + [F.col(c) for c in (tiebreak or [])] + [F.col("__tb")]


def versions_of(base: DataFrame, key: str, tracked: Sequence[str], valid_from: str, order: list[Column],
                hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS, max_chunks: int | None = None) -> DataFrame:
    """The rows of ``base`` that open a version, with ``__valid_to`` (NULL: open)."""
    if hot_key_rows is None or not _may_be_hot(base, hot_key_rows):
        return _versions_one_window(base, key, tracked, valid_from, order)
    counts = base.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot_counts = counts.filter(F.col("__n") > hot_key_rows)
    n_hot, hot_rows = _hot_stats(hot_counts)
    if n_hot == 0:
        return _versions_one_window(base, key, tracked, valid_from, order)
    hot = hot_counts.select(F.col(key).alias("__hk"))
    is_hot = base[key].eqNullSafe(hot["__hk"])  # a NULL key can be hot too
    n_chunks = int(max(2, -(-hot_rows // max(hot_key_rows, 1)) + 1))
    n_chunks = n_chunks if max_chunks is None else min(max_chunks, n_chunks)
    cold = _versions_one_window(base.join(hot, is_hot, "left_anti"), key, tracked,
                                valid_from, order)
    hot_v = _versions_chunked(base.join(hot, is_hot, "left_semi"), key, tracked,
                              valid_from, order, n_chunks)
    return cold.unionByName(hot_v)


def scd2(snapshots: DataFrame, key: str, tracked: Sequence[str], ts: str,
         valid_from: str = "valid_from", sk_name: str = "sk",
         tiebreak: Sequence[str] | None = None,
         hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
         max_chunks: int | None = None) -> DataFrame:
    """Versions of each ``key`` from its snapshot history.

    ``hot_key_rows=None`` skips hot-key detection (one window over every key;
    use when the history per key is known to be small). Otherwise keys with
    more snapshots than that are split as described in the module doc into
    about hot_rows / hot_key_rows chunks (at most ``max_chunks``, where given).
    Detection counts the rows, and the rows by key only where there are more than that;
    when no key is hot the plan is exactly the single-window one.
    """
    payload = [c for c in snapshots.columns if c != ts]
    base, order = with_order(snapshots, ts, valid_from, tiebreak)
    versions = versions_of(base, key, tracked, valid_from, order, hot_key_rows, max_chunks)
    return finish_versions(versions, key, valid_from, sk_name, payload)
