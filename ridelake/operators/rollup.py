"""Aggregations. Each is a single groupBy, so Spark runs a partial
(map-side) aggregate before the shuffle: a hot group is pre-combined on
every map task and never travels whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """``GROUP BY keys`` with named measures (name -> aggregate expression)."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in measures.items()])


def count_where(pred: Column) -> Column:
    """``count(case when pred then 1 end)``: NULL predicate counts as false."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def distribution(df: DataFrame, col: str, count_name: str = "n",
                 pct_name: str = "pct", decimals: int = 2) -> DataFrame:
    """Count per value and its percentage of all rows, largest first.

    The grand total is a scalar subquery over the same per-value counts (Spark
    reuses their exchange), so the input is read once, nothing runs before the
    action, and no window or join has to see all values in one task, whatever
    the column's cardinality.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.agg(F.sum(count_name)).scalar()
    pct = F.round(F.col(count_name) * F.lit(100.0) / total, decimals)
    return counts.select(col, count_name, pct.cast("double").alias(pct_name)) \
        .orderBy(F.col(count_name).desc())


def duplicates(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """``GROUP BY keys HAVING count(*) > 1``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def distinct_values(df: DataFrame, col: str, drop_null: bool = True) -> DataFrame:
    out = df.select(col).distinct()
    return out.filter(F.col(col).isNotNull()) if drop_null else out


def cardinality(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    """Exact distinct count (one row)."""
    return df.agg(F.count_distinct(F.col(col)).alias(name))
