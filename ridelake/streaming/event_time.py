"""Status reports by their own time: repeats and late reports, and windows.

Both operators keep state only behind a watermark: ``delay`` is how much older than
the newest report a report may be; older ones are late, are dropped and are
counted in the progress (``late_rows`` of a :mod:`~ridelake.streaming.report`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_KEY = ("station_id", "last_reported", "num_bikes_available", "num_docks_available")


def with_report_time(flat: DataFrame, delay: str) -> DataFrame:
    return flat.withColumn("reported_at", F.timestamp_seconds("last_reported")).withWatermark("reported_at", delay)


def once_each(flat: DataFrame, delay: str, key: Sequence[str] = REPORT_KEY) -> DataFrame:
    """Every report once, however often and in however many documents it comes within ``delay``."""
    return with_report_time(flat, delay).dropDuplicatesWithinWatermark(list(key))


def status_windows(flat: DataFrame, delay: str, size: str = "5 minutes") -> DataFrame:
    """For each station and window of time: the number of reports and the newest one's
    counts (of several at one instant the largest counts). A window is given out once, when
    the watermark has passed its end, and leaves the state then."""
    newest = F.max_by(F.struct("last_reported", "num_bikes_available", "num_docks_available"),
                      F.struct("last_reported", "num_bikes_available", "num_docks_available")).alias("newest")
    return (with_report_time(flat, delay).groupBy(F.window("reported_at", size), "station_id")
            .agg(F.count(F.lit(1)).alias("n_reports"), newest)
            .select("station_id", F.col("window.start").cast("long").alias("window_start"), "n_reports", "newest.*"))
