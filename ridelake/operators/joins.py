"""Dimension lookups, point-in-time join, and join-integrity detectors.

Join strategy (``strategy``):

* ``"auto"`` (default): no hint and no job of its own. Spark broadcasts the
  dimension side when its statistics (a written dimension table) or, during the
  run, its measured shuffle size are within ``autoBroadcastJoinThreshold``, and
  joins by sort and merge otherwise.
* ``"shuffle"``: always sort and merge.

Either way rows that can never match are salted (see :func:`_spread`), so the
plan that Spark chooses is safe from a pile of NULL keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 1024
MATCHES = 64  # stations in one row of the grouped lookup relation


def _hinted(dim: DataFrame, strategy: str) -> DataFrame:
    if strategy == "auto":
        return dim
    if strategy == "shuffle":
        return dim.hint("merge")
    raise ValueError(f"unknown join strategy {strategy!r}")


def _spread(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
            guard: Column | None, name: str, spread_by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, Column, list[str]]:
    """Both sides with join keys, their equality, and the names of the key columns.

    Rows that can never match (NULL key or guard false) get a NULL key plus a
    salt (a hash of ``spread_by``, all columns unless given, taken of those rows only)
    spreading them over ``SALT_BUCKETS`` partitions; matchable rows use
    salt 0, which is the only salt on the dimension side. A *matchable* hot
    key (one station with a large share of trips) is split at runtime by
    AQE's skew-join handling (``spark.sql.adaptive.skewJoin.enabled``, set
    by the session settings): the oversized left partition is cut into
    several tasks that each read the small matching dimension partition --
    sized by measured bytes, which a fixed replication factor cannot match."""
    can = F.lit(True) if guard is None else guard
    for lk, _ in on:
        can = can & F.col(lk).isNotNull()
    can = F.coalesce(can, F.lit(False))
    salt = F.when(can, F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in spread_by or left.columns]), F.lit(SALT_BUCKETS)) + 1)
    # the dimension's salt is always 0, but not a constant: "salt = 0" would be
    # folded into a residual filter and drop out of the hash partitioning
    zero = F.pmod(F.xxhash64(on[0][1]), F.lit(1).cast("long"))
    l2, r2, names, same = left, right, [name + "ls", name + "rs"], None
    for i, (lk, rk) in enumerate(on):
        ln, rn = f"{name}l{i}", f"{name}r{i}"
        l2, r2 = l2.withColumn(ln, F.when(can, F.col(lk))), r2.withColumn(rn, F.col(rk))
        names += [ln, rn]
    l2, r2 = l2.withColumn(name + "ls", salt), r2.withColumn(name + "rs", zero)
    for i in range(len(on)):
        own = l2[f"{name}l{i}"] == r2[f"{name}r{i}"]
        same = own if same is None else same & own
    return l2, r2, same & (l2[name + "ls"] == r2[name + "rs"]), names


def lookup(left: DataFrame, dim: DataFrame, on: Mapping[str, str],
           take: Mapping[str, str], guard: Column | None = None,
           strategy: str = "auto", prefix: str = "__d_", spread_by: Sequence[str] = ()) -> DataFrame:
    """LEFT lookup of ``take`` columns (dim column -> output name) on
    ``left[k] = dim[v]`` for each ``k: v`` in ``on``; ``guard`` (a predicate on
    the left row) restricts which rows may match at all."""
    right = dim.selectExpr(*[f"`{v}` AS `{prefix}k_{v}`" for v in on.values()],
                           *[f"`{src}` AS `{dst}`" for src, dst in take.items()])
    l2, r2, same, names = _spread(left, right, [(k, f"{prefix}k_{v}") for k, v in on.items()], guard, prefix + "key_", spread_by)
    out = l2.join(_hinted(r2, strategy), same, "left")
    return out.drop(*[f"{prefix}k_{v}" for v in on.values()], *names)


def current_versions(dim: DataFrame, columns: Sequence[str],
                     flag: str = "is_current") -> DataFrame:
    return dim.filter(F.col(flag)).select(*columns)


def station_lookup_table(cur: DataFrame) -> DataFrame:
    """One lookup relation for both match rules: every current version is
    listed under ``c:<code>`` and under ``n:<name>`` (one pass, explode)."""
    return cur.selectExpr(
        "explode(array(concat('c:', short_name), concat('n:', station_name))) AS __lk",
        "short_name", "station_name", "lat", "lon")


def trip_end_key_sql(station_id: str, station_name: str) -> str:
    """The code when the trip carries one, else its name: the two match
    rules are mutually exclusive per row, so one lookup per trip end does
    the work of a code join plus a guarded name join."""
    return (f"CASE WHEN `{station_id}` IS NOT NULL THEN concat('c:', `{station_id}`) "
            f"ELSE concat('n:', `{station_name}`) END")


def grouped_matches(table: DataFrame, key: str = "__lk") -> DataFrame:
    """The lookup relation with the rows of a key gathered as ``matches``, at most ``MATCHES`` in
    a row, so that a key of any number of stations is held by no task whole."""
    fields = [c for c in table.columns if c != key]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*fields)) - 1
    return (table.filter(F.col(key).isNotNull()).withColumn("__part", F.floor(place / MATCHES))
            .groupBy(key, "__part").agg(F.collect_list(F.struct(*fields)).alias("matches")).drop("__part"))


_FILLS = (("station_id", "short_name"), ("station_name", "station_name"), ("lat", "lat"), ("lng", "lon"))


def match_current(trips: DataFrame, dim: DataFrame, strategy: str = "auto",
                  ends: Sequence[str] = ("start", "end")) -> DataFrame:
    """``trips`` with what :func:`fill_matches` needs to fill each end: ``__{end}_n``, the rows that it
    makes of the trip, and ``__{end}_m``, their stations (NULL where the trip lacks nothing).

    Plan: one join per trip end against a single lookup relation, so the
    dimension is computed once and (when small) broadcast once -- the second
    end reuses the exchange. A trip of many matches is still one row here, so both
    shuffles move the trips as they came, whatever the joins make of them."""
    table = grouped_matches(station_lookup_table(
        current_versions(dim, ["station_name", "short_name", "lat", "lon"])))
    out = trips.selectExpr("*", *[f"{trip_end_key_sql(f'{e}_station_id', f'{e}_station_name')}"
                                  f" AS `__{e}_lk`" for e in ends])
    for end in ends:
        out = lookup(out, table, {f"__{end}_lk": "__lk"}, {"matches": f"__{end}_m"}, strategy=strategy,
                     prefix=f"__{end}_", spread_by=[c for c in ("ride_id",) if c in trips.columns])
        own = [f"`{end}_{c}` IS NOT NULL" for c, _ in _FILLS if f"{end}_{c}" in trips.columns]
        kept = [f"`{c}`" for c in out.columns if c not in (f"__{end}_lk", f"__{end}_m")]
        out = out.selectExpr(*kept, f"CASE WHEN `__{end}_m` IS NULL THEN 1 ELSE size(`__{end}_m`) END AS `__{end}_n`",
                             f"CASE WHEN NOT ({' AND '.join(own)}) THEN `__{end}_m` END AS `__{end}_m`")
    return out


def fill_matches(matched: DataFrame, ends: Sequence[str] = ("start", "end")) -> DataFrame:
    """The filled trips of :func:`match_current`: a row for each match of either end (one, if none).
    A trip's rows are counted through once, over its ends together."""
    sizes = [f"`__{end}_n`" for end in ends]
    out, fills = matched.selectExpr("*", f"explode(sequence(0, {' * '.join(sizes)} - 1)) AS `__i`"), {}
    for k, end in enumerate(ends):
        later = " * ".join(sizes[k + 1:]) or "1"
        place = f"CAST(`__i` DIV ({later}) % {sizes[k]} AS INT)"
        fills |= {f"{end}_{own}": f"coalesce(`{end}_{own}`, get(`__{end}_m`, {place}).{field}) AS `{end}_{own}`"
                  for own, field in _FILLS}
    added = {f"__{end}_{c}" for end in ends for c in ("n", "m")}
    return out.selectExpr(*[fills.get(c, f"`{c}`") for c in matched.columns if c not in added])


def enrich_current(trips: DataFrame, dim: DataFrame, strategy: str = "auto",
                   ends: Sequence[str] = ("start", "end")) -> DataFrame:
    """Fill trip-end station id/name/coordinates from the *current* station
    versions: own value first, then a match on the station code, then (only
    when the trip carries no code) a match on the station name.

    Duplicate current codes or names fan out exactly as two separate left joins
    would, but only after both joins (:func:`match_current`)."""
    return fill_matches(match_current(trips, dim, strategy, ends), ends)


def enrich_as_of(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                 ts: str, take: Mapping[str, str], valid_from: str = "valid_from",
                 valid_to: str = "valid_to", strategy: str = "auto",
                 time_bucket: str | None = None, span: DataFrame | None = None,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Point-in-time LEFT join: the dimension version whose half-open validity
    ``[valid_from, valid_to)`` contains the fact's ``ts`` (a boundary instant
    matches exactly one version).

    An equi-join on the key with a range residual (``strategy`` as for
    :func:`lookup`). With ``time_bucket`` ("month" or "day") the time becomes
    part of the equi-key: each version is repeated for the buckets it overlaps
    *within the facts' time span*, so a fact only meets the versions of its own
    bucket instead of a key's whole history. The span is a scalar subquery, part
    of the one plan; ``span`` names a cheaper frame with a ``ts`` column to take
    it from (the raw scan), which must cover the facts (for "sorted": their keys too).

    ``strategy="sorted"`` takes the sort-based as-of join
    (:mod:`ridelake.operators.asof`) instead, for keys with very many versions
    inside one bucket. All plans give the same rows.
    """
    from ridelake.operators.asof import asof_join_sorted, one_line
    dim = one_line(dim, dim_key, valid_from, valid_to, tiebreak)  # all plans below see the same line
    if strategy == "sorted":
        return asof_join_sorted(facts, dim, fact_key, ts, dim_key, take, valid_from, valid_to, span)
    right = dim.select(F.col(dim_key).alias("__pit_k"), F.col(valid_from).alias("__pit_from"),
                       F.col(valid_to).alias("__pit_to"),
                       *[F.col(s).alias(d) for s, d in take.items()])
    left, on = facts, [(fact_key, "__pit_k")]
    if time_bucket is not None:
        def bucket(c: Column) -> Column:
            d = F.to_date(c)
            return F.trunc(d, "month") if time_bucket == "month" else d

        step = F.expr("INTERVAL 1 MONTH") if time_bucket == "month" else F.expr("INTERVAL 1 DAY")
        times = (facts if span is None else span).select(F.col(ts).alias("__t"))
        lo, hi = times.agg(F.min("__t")).scalar(), times.agg(F.max("__t")).scalar()
        bounded = right.select("*", lo.alias("__lo"), hi.alias("__hi")).filter("__pit_to > __lo AND __pit_from <= __hi")
        first = bucket(F.greatest(F.col("__pit_from"), F.col("__lo")))
        last = bucket(F.least(F.col("__pit_to"), F.col("__hi")))
        right = bounded.withColumn("__pit_b", F.explode(F.sequence(first, last, step))).drop("__lo", "__hi")
        left = facts.withColumn("__pit_fb", bucket(F.col(ts)))
        on = [*on, ("__pit_fb", "__pit_b")]
    l2, r2, same, names = _spread(left, right, on, F.col(ts).isNotNull(), "__pit_key_")
    inside = (l2[ts] >= r2["__pit_from"]) & (l2[ts] < r2["__pit_to"])
    return l2.join(_hinted(r2, strategy), same & inside, "left").drop(
        "__pit_k", "__pit_from", "__pit_to", "__pit_b", "__pit_fb", *names)


def orphans(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Referential integrity: child rows with a non-NULL ``col`` value that has
    no ``parent[field]`` (left anti join; the parent side is de-duplicated
    first so it ships only distinct keys)."""
    keys = parent.select(F.col(field).alias("__parent_key")).distinct()
    c = child.filter(F.col(col).isNotNull())
    return c.join(keys, c[col] == keys["__parent_key"], "left_anti")


def fanout_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Keys that occur more than once after a join (duplicate matches)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)
