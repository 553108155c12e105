"""Sort-based point-in-time (as-of) join for dimensions too large to
broadcast or keys with very many versions.

Time is cut into hours. Facts and version starts meet by (key, hour), so a key
holding a third of all rows is spread over as many tasks as it has hours, and no
fact is ever compared with all versions of its key. Inside an hour,
``last(version, ignorenulls)`` over the running frame gives each fact the newest
version that started at or before it (a version starting at the same instant
sorts first, so the boundary instant belongs to the new version). Facts without
one take the key's last version from earlier hours: that carry table has a row
for every (key, hour) that facts or versions have, built from two aggregates, and
joining it reuses the window's partitioning. The facts are shuffled once, nothing is
checkpointed, and an hour is a function of the row alone, so a retried task sends every
row where the first attempt did.

Requires versions of one key not to overlap (:func:`one_line` sees to that).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 1024


def hour_of(ts: str | Column) -> Column:
    """Hours since the epoch by the wall clock, rising with ``ts`` (no zone enters)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_date(F.to_date(c)).cast("long") * 24 + F.hour(c)


def one_line(versions: DataFrame, dim_key: str, valid_from: str = "valid_from",
             valid_to: str = "valid_to", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Versions of which at most one is valid for a key at any instant: empty
    ones go, of several that start together the longest (then the first by
    ``tiebreak``, then one by the hash of the row) stays, and a version ends where the
    key's next one starts. The key need not be the one the versions were built for, so
    two stations that share a code are one line, in which the newer start wins.

    The next start is looked for inside the version's hour; the last version of
    an hour gets the first start of the key's next hour that has one. A window never
    holds more of a key than one hour, or one row an hour."""
    real = (versions.filter(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull()
                            & (F.col(valid_from) < F.col(valid_to)))
            .withColumn("__tie", F.xxhash64(*[F.col(c) for c in versions.columns]))
            .withColumn("__h", hour_of(valid_from)))
    start = Window.partitionBy(dim_key, "__h", valid_from).orderBy(F.desc(valid_to), *tiebreak, "__tie")
    first = real.withColumn("__n", F.row_number().over(start)).filter("__n = 1")
    inside = first.withColumn("__next", F.lead(valid_from).over(Window.partitionBy(dim_key, "__h").orderBy(valid_from)))
    # the first start of each hour needs no window: ties don't change it
    hours = real.groupBy(dim_key, "__h").agg(F.min(valid_from).alias("__first"))
    later = hours.select(F.col(dim_key).alias("__k"), F.col("__h").alias("__kh"),
                         F.lead("__first").over(Window.partitionBy(dim_key).orderBy("__h")).alias("__later"))
    joined = inside.join(later, (inside[dim_key] == later["__k"]) & (inside["__h"] == later["__kh"]), "left")
    following = F.coalesce("__next", "__later", valid_to)
    return (joined.withColumn(valid_to, F.least(F.col(valid_to), following))
            .select(*versions.columns))


def asof_join_sorted(facts: DataFrame, versions: DataFrame, fact_key: str, ts: str,
                     dim_key: str, take: Mapping[str, str], valid_from: str = "valid_from",
                     valid_to: str = "valid_to", cover: DataFrame | None = None) -> DataFrame:
    """LEFT as-of join: each fact gets the ``take`` columns (dim column ->
    output name) of the version with ``valid_from <= ts < valid_to``; facts
    without one (NULL key or time included) get NULLs. ``cover`` names a cheaper frame
    (a raw scan) that has every (key, time) of the facts, to take their hours from."""
    fact_struct = F.struct(*[F.col(c) for c in facts.columns])
    ver_struct = F.struct(*[F.col(s).alias(d) for s, d in take.items()],
                          F.col(valid_from).alias("__vfrom"), F.col(valid_to).alias("__vto"))
    fact_type = facts.select(fact_struct.alias("x")).schema["x"].dataType
    ver_type = versions.select(ver_struct.alias("x")).schema["x"].dataType
    # facts that can't match have no hour; they are spread by a salt
    can = F.col(fact_key).isNotNull() & F.col(ts).isNotNull()
    salt = F.when(can, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(SALT_BUCKETS)) + 1).cast("int")

    f_side = facts.select(F.when(can, F.col(fact_key)).alias("__k"), F.when(can, hour_of(ts)).alias("__h"), salt.alias("__salt"),
                          F.col(ts).alias("__t"), F.lit(1).alias("__kind"), fact_struct.alias("__fact"),
                          F.lit(None).cast(ver_type).alias("__ver"))
    starts = versions.filter(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull())
    v_side = starts.select(F.col(dim_key).alias("__k"), hour_of(valid_from).alias("__h"), F.lit(0).alias("__salt"),
                           F.col(valid_from).alias("__t"), F.lit(0).alias("__kind"),
                           F.lit(None).cast(fact_type).alias("__fact"), ver_struct.alias("__ver"))
    running = (Window.partitionBy("__k", "__h", "__salt").orderBy("__t", "__kind")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    met = (f_side.unionByName(v_side)
           .withColumn("__in", F.last("__ver", ignorenulls=True).over(running)).filter("__kind = 1"))

    # carry: the key's newest version from earlier hours, for every hour of its facts
    last_in = v_side.groupBy("__k", "__h").agg(F.max_by("__ver", "__t").alias("__lv"))
    asked = ((facts if cover is None else cover).filter(can).select(F.col(fact_key).alias("__k"), hour_of(ts).alias("__h"))
             .distinct().withColumn("__lv", F.lit(None).cast(ver_type)))
    before = (Window.partitionBy("__k").orderBy("__h")
              .rangeBetween(Window.unboundedPreceding, -1))
    carry = (last_in.withColumn("__ask", F.lit(False)).unionByName(asked.withColumn("__ask", F.lit(True)))
             .withColumn("__carry", F.last("__lv", ignorenulls=True).over(before))
             .filter("__ask").select("__k", "__h", "__carry"))

    out = met.join(carry, ["__k", "__h"], "left").withColumn("__v", F.coalesce("__in", "__carry"))
    hit = F.col("__t") < F.col("__v.__vto")
    return out.select(
        *[F.col(f"__fact.{c}").alias(c) for c in facts.columns],
        *[F.when(hit, F.col(f"__v.{d}")).alias(d) for d in take.values()])
