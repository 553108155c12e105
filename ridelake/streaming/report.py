"""What a stream did, as rows: starts, progress, failures, restarts.

A listener writes one small JSON file an event below the report's folder, so the report
outlives the driver and is read like any table. ``run_reported`` runs a stream with
restarts: failures that may pass (lost connections, timeouts, unreadable storage, lost
executors) are retried from the checkpoint, others end the run at once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ridelake.session import path_exists, write_text

ROW = StructType([
    StructField("at", DoubleType()), StructField("kind", StringType()), StructField("query", StringType()),
    StructField("run", StringType()), StructField("batch", LongType()), StructField("rows", LongType()),
    StructField("state_rows", LongType()), StructField("late_rows", LongType()), StructField("watermark", StringType()),
    StructField("milliseconds", LongType()), StructField("message", StringType())])

STARTED, PROGRESS, IDLE, ENDED, FAILED, RESTARTED = "started", "progress", "idle", "ended", "failed", "restarted"

# Names of errors, as they stand in messages, that may pass on a new attempt.
TRANSIENT = (
    "java.io.IOException", "java.net.", "TimeoutException", "TimeoutError", "ConnectionError",
    "ConnectionResetError", "ConnectionRefusedError", "BrokenPipeError", "OSError",
    "ExecutorLostFailure", "FetchFailedException", "BlockMissingException",
)


def is_transient(error: BaseException) -> bool:
    """Whether a failure may pass: by its type, or by the errors that its message names."""
    seen: BaseException | None = error
    while seen is not None:
        if isinstance(seen, (ConnectionError, TimeoutError, OSError)) and not isinstance(
                seen, (FileNotFoundError, PermissionError, NotADirectoryError, IsADirectoryError)):
            return True
        if any(name in str(seen) for name in TRANSIENT):
            return True
        seen = seen.__cause__
    return False


class StreamReport(StreamingQueryListener):
    """Rows of the queries named ``query`` below ``root``."""

    def __init__(self, spark: SparkSession, root: str, query: str):
        self.spark, self.root, self.query, self.runs = spark, root, query, set()

    def record(self, kind: str, **values) -> None:
        row = {"at": time.time(), "kind": kind, "query": self.query, **values}
        write_text(self.spark, f"{self.root}/{row['at']:017.6f}-{uuid.uuid4().hex}.json", json.dumps(row))

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.runs.add(str(event.runId))
            self.record(STARTED, run=str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) in self.runs:
            self.record(PROGRESS, run=str(p.runId), batch=p.batchId, rows=p.numInputRows, milliseconds=p.batchDuration,
                        state_rows=sum(s.numRowsTotal for s in p.stateOperators),
                        late_rows=sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
                        watermark=p.eventTime.get("watermark"))

    def onQueryIdle(self, event) -> None:
        if str(event.runId) in self.runs:
            self.record(IDLE, run=str(event.runId))

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            failed = event.exception is not None
            self.record(FAILED if failed else ENDED, run=str(event.runId), message=(event.exception or "")[:2000] or None)

    def wait(self, milliseconds: int = 60_000) -> None:
        """Until all events so far have been delivered."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(milliseconds)


def read_report(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, root):
        return spark.createDataFrame([], ROW)
    return spark.read.schema(ROW).json(root)


def run_reported(spark: SparkSession, start: Callable[[], StreamingQuery], root: str, query: str,
                 max_restarts: int = 3, within_seconds: float = 3600.0, backoff_seconds: float = 30.0) -> int:
    """Run the stream that ``start`` begins (under the name ``query``) to its end, as
    :func:`ridelake.streaming.status.run_with_restarts` does, with a report at ``root``."""
    from ridelake.streaming.status import run_with_restarts

    report = StreamReport(spark, root, query)
    spark.streams.addListener(report)
    try:
        return run_with_restarts(start, max_restarts, backoff_seconds, within_seconds=within_seconds,
                                 log=lambda message: report.record(RESTARTED if "restart" in message else FAILED, message=message))
    finally:
        report.wait()
        spark.streams.removeListener(report)
