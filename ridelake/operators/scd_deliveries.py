"""A type 2 dimension that grows by delivery.

:func:`ridelake.operators.scd.scd2` windows the whole snapshot history. Here a run
reads only the new snapshots and the open versions (one row a key), closes and opens
versions, and leaves all closed versions where they are:

* what a version's successor is compared with is the key's *last snapshot*, which an open
  version therefore carries (``__head``: its order and tracked values). The head of a key is
  put before its new snapshots; the version that begins with it is the open one, and
  the rest are new;
* a key with a snapshot that is older than its head is *late*: its versions are built again
  from the history of that key alone (a semi join of the stored deliveries with the
  late keys), and its closed versions of earlier runs don't count any more.

Store, below ``root``: ``history/run=N`` and ``closed/run=N`` (the run's snapshots and
the versions it closed), ``rebuilt/run=N`` (its late keys), and ``open``, a published
version a run. A run becomes visible with its open versions, which are written last:
readers take nothing of later runs, and a failed run is written over by its repetition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ridelake.operators.scd import DEFAULT_HOT_KEY_ROWS, finish_versions, versions_of, with_order
from ridelake.sinks.writers import publish_version, published_version

_HEAD, _OPEN, _END = "__head", "__open", "__valid_to"


@dataclass(frozen=True)
class Dimension:
    """What a store holds: snapshots with ``key``, ``ts`` and ``tracked`` attributes."""

    root: str
    key: str
    tracked: Sequence[str]
    ts: str
    valid_from: str = "valid_from"
    sk_name: str = "sk"
    hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS


def _same(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on the key, NULL being a key like others."""
    return left.join(right, left[key].eqNullSafe(right["__k"]), how)


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("__k")).distinct()


def _read_runs(spark: SparkSession, path: str, schema: StructType, last: int) -> DataFrame:
    """Rows of the runs up to ``last``, with their ``run``."""
    full = StructType([*schema.fields, StructField("run", IntegerType())])
    return spark.read.schema(full).parquet(path).filter(F.col("run") <= last)


def deliver(dim: Dimension, snapshots: DataFrame, accept: Callable[[DataFrame], bool] | None = None) -> int | None:
    """Take a delivery of snapshots into the store; returns the number of the run. ``accept``,
    where given, sees the versions that the run has made or changed before they become
    visible; if it refuses them, they never do, and None is returned."""
    spark, key = snapshots.sparkSession, dim.key
    done = published_version(spark, f"{dim.root}/open")
    run = 0 if done is None else done + 1
    snapshots.write.mode("overwrite").parquet(f"{dim.root}/history/run={run}")
    new, order = with_order(spark.read.schema(snapshots.schema).parquet(f"{dim.root}/history/run={run}"), dim.ts, dim.valid_from)
    payload = [c for c in new.columns if c not in ("__tb", dim.valid_from)]
    version = StructType([f for f in new.schema.fields if f.name != "__tb"])
    open_type = StructType([*version.fields, StructField(_HEAD, StructType(
        [StructField("__at", new.schema[dim.valid_from].dataType), StructField("__tb", new.schema["__tb"].dataType),
         *[new.schema[c] for c in dim.tracked]]))])
    opened = (spark.createDataFrame([], open_type) if done is None
              else spark.read.schema(open_type).parquet(f"{dim.root}/open/version={done}"))

    # late: a snapshot before (or, at the same instant, ordered before) the key's last one
    earliest = new.groupBy(F.col(key).alias("__k")).agg(F.min(F.struct(F.col(dim.valid_from).alias("__at"), "__tb")).alias("__first"))
    met = _same(opened.select(key, _HEAD), earliest, key, "inner")
    late = met.filter(F.col("__first") < F.struct(f"{_HEAD}.__at", f"{_HEAD}.__tb")).select("__k")
    late.write.mode("overwrite").parquet(f"{dim.root}/rebuilt/run={run}")
    late = spark.read.schema(late.schema).parquet(f"{dim.root}/rebuilt/run={run}")

    # keys in time: their head, then their new snapshots
    touched = _keys(new, key)
    in_time = _same(new, late, key, "left_anti").withColumn(_OPEN, F.lit(None).cast(version))
    heads = _same(_same(opened, touched, key, "left_semi"), late, key, "left_anti")
    heads = heads.select(
        *[F.col(f"{_HEAD}.{c}").alias(c) if c in dim.tracked else F.col(c) for c in payload],
        F.col(f"{_HEAD}.__at").alias(dim.valid_from), F.col(f"{_HEAD}.__tb").alias("__tb"),
        F.struct(*[F.col(c) for c in version.names]).alias(_OPEN))
    base = in_time.unionByName(heads)
    found = [_built(dim, base, order, payload)]
    if not late.isEmpty():
        stored = _read_runs(spark, f"{dim.root}/history", snapshots.schema, run).drop("run")
        again, _ = with_order(stored, dim.ts, dim.valid_from)
        again = _same(again, late, key, "left_semi").withColumn(_OPEN, F.lit(None).cast(version))
        found.append(_built(dim, again, order, payload))
    versions = found[0] if len(found) == 1 else found[0].unionByName(found[1])

    closed = versions.filter(F.col(_END).isNotNull()).select(*version.names, _END)
    closed.write.mode("overwrite").parquet(f"{dim.root}/closed/run={run}")
    untouched = _same(opened, touched, key, "left_anti")
    still = versions.filter(F.col(_END).isNull()).select(*version.names, _HEAD)
    if accept is not None:
        changed = spark.read.schema(StructType([*version.fields, StructField(_END, version[dim.valid_from].dataType)])).parquet(
            f"{dim.root}/closed/run={run}").unionByName(still.drop(_HEAD).withColumn(_END, F.lit(None).cast(version[dim.valid_from].dataType)))
        if not accept(finish_versions(changed, key, dim.valid_from, dim.sk_name, payload)):
            return None
    publish_version(untouched.unionByName(still), f"{dim.root}/open", run)
    return run


def _built(dim: Dimension, base: DataFrame, order: list, payload: list[str]) -> DataFrame:
    """The versions of ``base``, with their ends and the last snapshot of their key."""
    rows = versions_of(base, dim.key, dim.tracked, dim.valid_from, order, dim.hot_key_rows)
    last = base.groupBy(F.col(dim.key).alias("__k")).agg(F.max_by(
        F.struct(F.col(dim.valid_from).alias("__at"), "__tb", *dim.tracked), F.struct(*order)).alias(_HEAD))
    kept = F.col(_OPEN).isNotNull()  # the version that was open before: as it was
    rows = rows.select(*[F.when(kept, F.col(f"{_OPEN}.{c}")).otherwise(F.col(c)).alias(c) for c in [*payload, dim.valid_from]], _END)
    return _same(rows, last, dim.key, "inner").drop("__k")


def read_dimension(spark: SparkSession, dim: Dimension, snapshot_schema: StructType) -> DataFrame:
    """All versions, as :func:`ridelake.operators.scd.scd2` gives them over all deliveries."""
    done = published_version(spark, f"{dim.root}/open")
    if done is None:
        raise FileNotFoundError(f"nothing has been delivered to {dim.root}")
    names = [dim.valid_from if f.name == dim.ts else f.name for f in snapshot_schema.fields]
    version = StructType([StructField(n, f.dataType) for n, f in zip(names, snapshot_schema.fields, strict=True)])
    ended = StructType([*version.fields, StructField(_END, version[dim.valid_from].dataType)])
    closed = _read_runs(spark, f"{dim.root}/closed", ended, done)
    rebuilt = (_read_runs(spark, f"{dim.root}/rebuilt", StructType([StructField("__k", version[dim.key].dataType)]), done)
               .groupBy("__k").agg(F.max("run").alias("__since")))
    valid = (_same(closed, rebuilt, dim.key, "left")
             .filter(F.col("__since").isNull() | (F.col("run") >= F.col("__since"))).select(*ended.names))
    still = spark.read.schema(version).parquet(f"{dim.root}/open/version={done}").withColumn(
        _END, F.lit(None).cast(version[dim.valid_from].dataType))
    payload = [n for n in names if n != dim.valid_from]
    return finish_versions(valid.unionByName(still), dim.key, dim.valid_from, dim.sk_name, payload)
