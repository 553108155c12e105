"""Table writers.

Layout: day partition directories, rows clustered inside each file by the
columns most queries filter on. Tables are dealt by day (:func:`by_day`); where the rows of a
partition grow as they are written (:func:`layout`), ``repartitionByRange`` on (day, cluster...) samples the key distribution, so a day holding a third of all rows is
split over many tasks instead of landing in one, and each task writes a
contiguous key range (few files per day, tight min/max stats for Parquet
row-group skipping).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ridelake.functions.scalars import ntz_literal, utc_now
from ridelake.session import list_names, move_path, path_exists, remove_path

OPEN_DAYS = 16  # day files that a task keeps open at once where its rows come in order


def add_run_timestamp(df: DataFrame, col: str, ts: datetime | str | None = None) -> DataFrame:
    """Constant load-run instant on every row (one value per query)."""
    if ts is None:
        value: Column = utc_now()
    else:
        value = ntz_literal(ts.strftime("%Y-%m-%d %H:%M:%S") if isinstance(ts, datetime) else ts)
    return df.withColumn(col, value)


def layout(df: DataFrame, day_col: str, cluster_cols: Sequence[str] = (),
           partitions: int | None = None) -> DataFrame:
    """Range-partition by (day, cluster..., row hash) and sort within
    partitions by (day, cluster...). The trailing deterministic row hash lets
    the sampled range bounds split even a single hot (day, cluster) value
    over several tasks; files stay clustered because the hash only orders
    rows *within* equal cluster values. (Deterministic, so a retried task
    routes every row exactly as the first attempt did.)"""
    keys = [day_col, *cluster_cols]
    spread = F.expr("xxhash64(" + ", ".join(f"`{c}`" for c in df.columns) + ")")
    range_keys = [F.col(k) for k in keys] + [spread]
    ranged = (df.repartitionByRange(partitions, *range_keys) if partitions
              else df.repartitionByRange(*range_keys))
    return ranged.sortWithinPartitions(*keys)


def by_day(df: DataFrame, day_col: str, cluster_cols: Sequence[str] = ()) -> DataFrame:
    """Deal the rows by day and sort within partitions by (day, cluster...). The sizes are those
    that the shuffle has measured: a day of many rows is split over several tasks, small ones are put
    together. Unlike :func:`layout` it takes no sample, for which a model's joins would run twice."""
    return df.hint("rebalance", F.col(day_col)).sortWithinPartitions(day_col, *cluster_cols)


def write_day_partitioned(df: DataFrame, path: str, day_col: str = "date_str",
                          cluster_cols: Sequence[str] = (), mode: str = "append",
                          partitions: int | None = None, load_col: str | None = None) -> None:
    """Write one directory per day in a single job.

    ``mode="append"`` adds files (re-running a month appends duplicates that
    staging dedup removes later); ``mode="overwrite_days"`` replaces only the
    directories present in ``df`` (dynamic partition overwrite: idempotent
    reloads, other days untouched). With ``load_col`` (the delivery a row came
    from) the directories are (load, day) pairs, so reloading one delivery
    never touches rows that another delivered for the same day. Rows are dealt as in
    :func:`by_day` unless ``partitions`` asks for a :func:`layout` of so many.
    """
    folders = [load_col, day_col] if load_col else [day_col]
    out = (layout(df, day_col, cluster_cols, partitions) if partitions
           else df.hint("rebalance", *folders).sortWithinPartitions(*folders, *cluster_cols))
    writer = out.write.partitionBy(*folders)
    if mode == "overwrite_days":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    writer.parquet(path)


def append_snapshot(df: DataFrame, path: str) -> None:
    """Keep history: every snapshot run appends, nothing is truncated."""
    df.write.mode("append").parquet(path)


@contextmanager
def _open_days(spark: SparkSession, most: int) -> Iterator[None]:
    """Let a task that writes keep the files of ``most`` days open, for which Spark then doesn't sort the rows
    by day once more (rows of further days are sorted); 0: the session's own setting."""
    if not most:
        yield
        return
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize_table(df: DataFrame, path: str, day_col: str | None = None,
                      cluster_cols: Sequence[str] = (), partitions: int | None = None,
                      replace_days: bool = False, days: Sequence[str] | None = None,
                      laid_out: bool = False, in_order: bool = False) -> None:
    """Full rebuild of a model table (optionally day-partitioned + clustered).
    With ``replace_days`` only the day folders present in ``df`` are replaced
    (incremental rebuild; other days untouched), and of ``days`` (yyyy-MM-dd),
    where given, those that ``df`` no longer has rows for are removed. Which days
    were written is observed by the writing job itself. ``laid_out`` says that
    ``df`` comes row by row from a table of the same layout, so it is only sorted
    within its partitions and not shuffled once more; ``in_order`` that its rows are
    sorted there as well, so they are written as they come. Writing the layer is also
    what cuts the lineage for the next layer."""
    if not day_col:
        df.write.mode("overwrite").parquet(path)
        return
    if in_order:
        out = df
    elif laid_out:
        out = df.sortWithinPartitions(day_col, *cluster_cols)
    else:
        out = layout(df, day_col, cluster_cols, partitions) if partitions else by_day(df, day_col, cluster_cols)
    written = Observation()
    if days is not None:
        out = out.observe(written, F.collect_set(F.col(day_col).cast("string")).alias("days"))
    # said either way, so the session's own setting never decides
    mode = "static" if not replace_days and days is None else "dynamic"
    with _open_days(df.sparkSession, OPEN_DAYS if in_order else 0):
        out.write.mode("overwrite").partitionBy(day_col).option("partitionOverwriteMode", mode).parquet(path)
    if days is not None:
        for day in sorted(set(days) - set(written.get.get("days", []))):
            remove_path(df.sparkSession, f"{path}/{day_col}={day}")


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions below ``root``, oldest first."""
    names = [n for n in list_names(spark, root) if n.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{root}/{n}/_SUCCESS"))


def published_version(spark: SparkSession, root: str) -> int | None:
    """The number of the newest complete version of a table, None before the first."""
    done = _versions(spark, root)
    return done[-1] if done else None


def publish_version(df: DataFrame, root: str, number: int | None = None) -> None:
    """Write ``df`` as the next version (or as version ``number``) of the table at ``root``. Readers
    (:func:`read_version`) see the version before until this one is complete, and
    a failed write leaves that one in place. The last two versions are kept, so
    a reader that has just chosen the older one can finish."""
    spark = df.sparkSession
    done = _versions(spark, root)
    number = number if number is not None else done[-1] + 1 if done else 0
    df.write.mode("overwrite").parquet(f"{root}/version={number}")
    for old in done[:-1]:
        remove_path(spark, f"{root}/version={old}")


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version of a table that ``publish_version`` writes."""
    done = _versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no version has been published at {root}")
    return spark.read.parquet(f"{root}/version={done[-1]}")


def promote(spark: SparkSession, staged: str, target: str, day_col: str | None = None,
            days: Sequence[str] | None = None) -> None:
    """Put a checked table in the place of the published one, by renames. With ``days`` only
    those day folders are replaced (or, where the staged table has none, removed). What
    was published before is moved aside first and removed last; a run that ends in
    between is repeated from the staged table's layer."""
    aside = f"{staged}.before"
    remove_path(spark, aside)
    if days is None:
        if path_exists(spark, target):
            move_path(spark, target, aside)
        move_path(spark, staged, target)
    else:
        for day in days:
            folder = f"{day_col}={day}"
            if path_exists(spark, f"{target}/{folder}"):
                move_path(spark, f"{target}/{folder}", f"{aside}/{folder}")
            if path_exists(spark, f"{staged}/{folder}"):
                move_path(spark, f"{staged}/{folder}", f"{target}/{folder}")
    remove_path(spark, aside)


def write_bucketed(df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int,
                   sort: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path`` in ``buckets`` buckets of the columns ``by``,
    one file each (the rows are dealt by the same hash first). Aggregations and joins on
    those columns, or more, then need no exchange. ``by`` should be fine enough for
    no single value to fill a bucket."""
    spark = df.sparkSession
    (df.repartition(buckets, *by).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *by).sortBy(*(sort or by)).format("parquet").saveAsTable(name))
    return spark.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema, by: Sequence[str], buckets: int,
                  sort: Sequence[str] = ()) -> DataFrame:
    """A table that ``write_bucketed`` has written, made known to this session's catalog."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema.fields)}) "
              f"USING parquet LOCATION '{path}' CLUSTERED BY ({', '.join(by)}) SORTED BY ({', '.join(sort or by)}) "
              f"INTO {buckets} BUCKETS")
    return spark.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Lazy, session-scoped view of a model."""
    df.createOrReplaceTempView(name)
    return df
