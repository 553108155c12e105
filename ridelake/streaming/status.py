"""Station-status feed on Structured Streaming.

Landed feed documents (JSON, one per line) are read as a file stream with a
bounded intake per micro-batch, flattened by the same stateless function as
the batch path, and appended to the bronze table by a checkpointed file sink
(the checkpoint commit replaces the queue acknowledgement and makes the
sink exactly-once across restarts; a failed batch is simply re-run from the
last committed offsets).

The latest status per station is kept as streaming aggregation state (one
row per station in the state store, checkpointed), not recomputed from the
whole history each cycle.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ridelake.plans.models import flatten_status
from ridelake.schemas import STATUS_DOC
from ridelake.session import path_exists
from ridelake.sinks.writers import publish_version

DEFAULT_TRIGGER = "300 seconds"
DEFAULT_MAX_FILES = 10


def stream_status(spark: SparkSession, landing_dir: str,
                  max_files_per_trigger: int = DEFAULT_MAX_FILES) -> DataFrame:
    """Streaming DataFrame of feed documents; at most ``max_files_per_trigger``
    new files per micro-batch (an empty poll simply produces no batch)."""
    return (spark.readStream.schema(STATUS_DOC)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .json(landing_dir))


def start_quarantine_stream(spark: SparkSession, landing_dir: str, quarantine_path: str,
                            checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                            available_now: bool = False,
                            max_files_per_trigger: int = DEFAULT_MAX_FILES) -> StreamingQuery:
    """Companion query over the same landed files: documents without a
    ``data`` section (including lines that are not JSON at all, kept as raw
    text) go to a quarantine table instead of disappearing. A separate,
    separately checkpointed query, so the bronze sink stays exactly-once."""
    schema = T.StructType(STATUS_DOC.fields + [T.StructField("_corrupt_record", T.StringType())])
    docs = (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(landing_dir))
    bad = docs.filter(F.col("data").isNull()).select(
        "last_updated", F.col("_corrupt_record").alias("raw"),
        F.col("_metadata.file_path").alias("source_file"))
    writer = (bad.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", quarantine_path))
    return _trigger(writer, trigger, available_now).start()


def valid_documents(docs: DataFrame) -> DataFrame:
    """Documents with a ``data`` section; the others belong to the quarantine
    stream, which the command line runs beside this one unless told not to."""
    return docs.filter(F.col("data").isNotNull())


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def start_status_stream(spark: SparkSession, landing_dir: str, bronze_path: str,
                        checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                        available_now: bool = False,
                        max_files_per_trigger: int = DEFAULT_MAX_FILES,
                        ingestion_at: Column | str | None = None, name: str | None = None) -> StreamingQuery:
    """Feed files -> flattened rows -> append to the bronze parquet table.

    ``ingestion_at`` defaults to the micro-batch's processing time (constant
    within a batch). A table that an earlier stream wrote keeps that stream's
    batch numbers; with another checkpoint its first batches would be taken for
    written and lost, so that is refused."""
    if path_exists(spark, f"{bronze_path}/_spark_metadata") and not path_exists(spark, f"{checkpoint}/commits"):
        raise ValueError(f"{bronze_path} was written by a stream with another checkpoint than {checkpoint}; "
                         "go on with that checkpoint or write to another table")
    docs = valid_documents(stream_status(spark, landing_dir, max_files_per_trigger))
    flat = flatten_status(docs, ingestion_at)
    writer = (flat.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", bronze_path))
    return _trigger(writer.queryName(name) if name else writer, trigger, available_now).start()


def latest_status_state(flat: DataFrame, key: str = "station_id",
                        ts: str = "ingestion_at") -> DataFrame:
    """Newest row per station as a streaming (or batch) aggregation:
    ``max_by`` over an ordering struct (ts, then every other column in
    order), i.e. ``ORDER BY ts DESC, ... DESC NULLS LAST`` -- deterministic,
    and rows that tie on everything are identical anyway."""
    payload = [c for c in flat.columns if c != key]
    order = F.struct(F.col(ts), *[F.col(c) for c in payload])
    latest = F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("latest")
    return flat.groupBy(key).agg(latest).select(key, *[F.col(f"latest.{c}").alias(c) for c in payload])


def start_latest_status_stream(spark: SparkSession, landing_dir: str, target_path: str,
                               checkpoint: str, trigger: str | None = DEFAULT_TRIGGER,
                               available_now: bool = False,
                               max_files_per_trigger: int = DEFAULT_MAX_FILES,
                               ingestion_at: Column | str | None = None) -> StreamingQuery:
    """Maintain the latest-status-per-station table. The state store holds
    one row per station; each micro-batch publishes the complete state as the
    next version of the (station-sized) table, so a reader
    (:func:`~ridelake.sinks.writers.read_version`) always finds a whole one and
    replaying a batch after a failure changes nothing."""
    docs = valid_documents(stream_status(spark, landing_dir, max_files_per_trigger))
    state = latest_status_state(flat=flatten_status(docs, ingestion_at))

    def publish(batch: DataFrame, batch_id: int) -> None:
        publish_version(batch, target_path)

    writer = (state.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, trigger, available_now).start()


def run_with_restarts(start: Callable[[], StreamingQuery], max_restarts: int = 3,
                      backoff_seconds: float = 30.0,
                      log: Callable[[str], None] = print, within_seconds: float = 3600.0) -> int:
    """Run a streaming query until it ends; when it fails for a reason that may pass
    (:func:`ridelake.streaming.report.is_transient`), report and start it again from its
    checkpoint (committed offsets make the restart resume exactly where the failed
    batch began). A failure that won't pass ends the run, and so do more than
    ``max_restarts`` restarts within ``within_seconds``; a stream that has run well for
    that long has all of them again. Returns the number of restarts used."""
    from ridelake.streaming.report import is_transient

    restarts, recent = 0, []
    while True:
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except Exception as exc:  # noqa: BLE001 - any query failure is reported
            if not is_transient(exc):
                log(f"stream failed for good: {exc!s:.300}")
                raise
            now = time.monotonic()
            recent = [t for t in recent if now - t < within_seconds]
            if len(recent) == max_restarts:
                log(f"stream failed: {exc!s:.300}; {max_restarts} attempts used up")
                raise
            recent.append(now)
            restarts += 1
            log(f"stream failed: {exc!s:.300}; restart {len(recent)}/{max_restarts} from checkpoint")
            time.sleep(backoff_seconds)


def await_bounded(query: StreamingQuery, timeout_seconds: float = 3600.0) -> None:
    """Wait for a (typically ``availableNow``) query to finish; stop it and
    fail loudly instead of hanging when it does not end in time."""
    finished = query.awaitTermination(timeout_seconds)
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.name or query.id} did not finish "
                           f"within {timeout_seconds:.0f}s")
