"""Top-1-per-key operators (priority dedup, latest row per key).

Plan shape: ``row_number() ... = 1`` is rewritten by Catalyst into a
WindowGroupLimit pair. The *partial* limit runs before the shuffle and keeps at
most one row per key per map partition, so a hot key (even one holding a third
of all rows) is cut down map-side; after the exchange each key carries at most
one row per input partition. No group is ever collected whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions.scalars import col_, year_month_sql

_RN = "__rn"


def row_fingerprint(df: DataFrame) -> Column:
    """Deterministic final tiebreak: identical rows tie, and then it does not
    matter which one is kept."""
    return F.expr("xxhash64(" + ", ".join(f"`{c}`" for c in df.columns) + ")")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row of each key under ``order`` (NULL keys form one
    group, as in SQL window partitions)."""
    ties = list(tiebreak) if tiebreak is not None else [row_fingerprint(df).asc()]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_priority(df: DataFrame, keys: Sequence[str], priority: Column,
                   recency: str, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: lowest ``priority`` first, then newest ``recency``
    (NULL recency last)."""
    return top_per_key(df, keys, [priority.asc(), F.col(recency).desc_nulls_last()], tiebreak)


def month_match_priority(month_col: str = "source_month", ts_col: str = "started_at") -> Column:
    """0 when the delivering file's month equals the event's month, else 1
    (also 1 when the event time is NULL)."""
    return F.expr(f"CASE WHEN CAST({month_col} AS STRING) = {year_month_sql(ts_col)} THEN 0 ELSE 1 END")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str,
                   tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Newest row per key by ``ts`` (NULL ts last)."""
    return top_per_key(df, keys, [col_(ts).desc_nulls_last()], tiebreak)
