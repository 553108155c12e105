"""Spark session settings and shared-storage locations.

Every operator in the package is a DataFrame -> DataFrame function, so the
session is only needed by the job runners, the streaming helpers and tests.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on or benefit from. Safe to apply to an existing
# session: none of them changes a result, only the physical plan.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let the local-shuffle reader turn a runtime-small side into a broadcast.
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # delete checkpoint files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a large run, so every task's share fits executor
    memory and spills rarely.

    * scans split files into ``target_partition_bytes`` pieces;
    * the initial shuffle width is input / target (at least 2 waves of the
      cluster's cores); AQE then coalesces small partitions to
      the same advisory size and splits skewed join partitions above 4x it;
    * sides of a join up to 64 MB, by statistics or as measured during the
      run, are broadcast; the operators give no hints of their own.
    """
    width = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Apply runtime SQL settings (all of ``cluster_conf`` are runtime)."""
    for k, v in conf.items():
        spark.conf.set(k, v)


def get_spark(master: str | None = None, app: str = "ridelake",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the package's settings.

    On a cluster the master comes from spark-submit; ``master`` is only for
    local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if driver_memory:  # only effective when this call starts the JVM (local runs)
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on sessions that do not expose one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote (Connect) session
        return None


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``
    (or one already given to ``setCheckpointDir``)."""
    sc = _context(spark)
    if sc is None:
        try:
            return spark.conf.get("spark.checkpoint.dir", None) or None
        except Exception:  # noqa: BLE001
            return None
    value = sc.getConf().get("spark.checkpoint.dir", None)
    if not value:
        value = sc.getCheckpointDir()
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint root, setting a private one only when unset.

    The fallback exists for tests and single-machine runs; on a cluster the
    setting is provided and always wins.
    """
    root = checkpoint_root(spark)
    sc = _context(spark)
    if root is None:
        master = sc.master if sc is not None else ""
        if master and not master.startswith("local"):
            # executors cannot see a folder on the driver's disk
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="ridelake-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def _file_system(spark: SparkSession, path: str):
    """The file system that Spark would read ``path`` from, and the path there."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, none if it is not there."""
    fs, p = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder (its parent is made); fails if ``target`` is there."""
    fs, src = _file_system(spark, source)
    _, dst = _file_system(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, there as a whole or not at all (written aside, then renamed)."""
    fs, target = _file_system(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(aside, target):
        fs.delete(aside, False)
        raise OSError(f"could not put {path} in place")


def order_files(spark: SparkSession, path: str) -> int:
    """Give the files below ``path`` modification times a second apart, in the order of their
    names, so that a file stream takes them in that order; returns their number."""
    fs, p = _file_system(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", ".")))
    newest = int(time.time()) - 1
    for i, name in enumerate(names):
        at = (newest - len(names) + i) * 1000
        fs.setTimes(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, name), at, at)
    return len(names)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint root (never a local tmp dir
    when the cluster names one)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "ridelake", *parts, uuid.uuid4().hex)
