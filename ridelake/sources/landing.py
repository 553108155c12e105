"""Land driver-derived data in the raw formats the feeds arrive in (trip CSV
per month, station-information and status JSON documents), so the file
sources and the stream are exercised on real files.

Documents group at most ``block`` consecutive source rows: a document is
built by a bounded ``collect_list`` (never a whole table, day or station in
one group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.scalars import ts_to_epoch_seconds
from ridelake.schemas import STATUS_COUNTERS
from ridelake.session import order_files

STATUS_BLOCK = 100
STATION_BLOCK = 500


def status_documents(events: DataFrame, block: int = STATUS_BLOCK) -> DataFrame:
    """Feed documents ``{"last_updated": ..., "data": {"stations": [...]}}``
    as JSON strings (column ``value``), one per block of event ids; the
    document time is the newest report it carries."""
    eid = F.col("event_id")
    epoch = ts_to_epoch_seconds("ts")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    counters = {
        "num_bikes_available": (eid % 5).cast("bigint"), "num_bikes_disabled": zero,
        "num_docks_available": (eid % 7).cast("bigint"), "num_docks_disabled": zero,
        "is_installed": one, "is_renting": one, "is_returning": one, "last_reported": epoch,
        "num_ebikes_available": zero, "num_scooters_available": zero,
        "num_scooters_unavailable": zero,
    }
    station = F.struct(F.concat(F.lit("uuid-"), F.col("user_id").cast("string")).alias("station_id"),
                       *[counters[c].alias(c) for c in STATUS_COUNTERS])
    docs = (events.groupBy(F.floor(eid / block).alias("doc_id"))
            .agg(F.max(epoch).alias("last_updated"), F.collect_list(station).alias("stations")))
    doc = F.struct("last_updated", F.struct(F.col("stations").alias("stations")).alias("data"))
    return docs.select("doc_id", F.to_json(doc).alias("value"))


def station_info_documents(snapshots: DataFrame, block: int = STATION_BLOCK) -> DataFrame:
    """Station-information documents, one per fetch time and station hash
    bucket of about ``block`` stations, however many a fetch holds
    (coordinates and capacity travel as text, as feeds often do)."""
    fetches = snapshots.groupBy("extracted_at").agg(F.count(F.lit(1)).alias("n"))
    buckets = max(1, -(-(fetches.agg(F.max("n")).first()[0] or 0) // block))
    st = F.struct(
        F.col("station_id"), F.col("station_name").alias("name"), F.col("short_name"),
        F.col("lon").cast("string").alias("lon"), F.col("lat").cast("string").alias("lat"),
        F.col("region_id"), F.col("capacity").cast("string").alias("capacity"),
        F.struct(F.col("rental_uri_android").alias("android"),
                 F.col("rental_uri_ios").alias("ios")).alias("rental_uris"))
    bucket = F.pmod(F.xxhash64("station_id"), F.lit(buckets))
    docs = (snapshots.groupBy("extracted_at", bucket.alias("bucket"))
            .agg(F.collect_list(st).alias("stations")))
    doc = F.struct(ts_to_epoch_seconds("extracted_at").alias("last_updated"),
                   F.struct(F.col("stations").alias("stations")).alias("data"))
    return docs.select(F.to_json(doc).alias("value"))


def write_json_lines(docs: DataFrame, path: str) -> None:
    """One document per line (the landing format of the feed files)."""
    docs.select("value").write.mode("overwrite").text(path)


def land_in_order(docs: DataFrame, path: str, files: int) -> int:
    """(value, file) rows as one text file for each ``file`` number below ``files``, with
    modification times in the order of the numbers; returns how many files there are."""
    docs.repartitionById(files, F.col("file").cast("int")).select("value").write.mode("overwrite").text(path)
    return order_files(docs.sparkSession, path)


def trip_csv_columns(trips_raw: DataFrame) -> DataFrame:
    """The published CSV columns (all text) plus the month folder."""
    cols = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
            "start_station_id", "end_station_name", "end_station_id", "start_lat", "start_lng",
            "end_lat", "end_lng", "member_casual"]
    return trips_raw.select(*[F.col(c).cast("string").alias(c) for c in cols],
                            F.col("source_month").alias("month"))


def write_trip_csv_landing(trips_raw: DataFrame, root: str) -> None:
    """``root/month=YYYYMM/part-*.csv`` with header, one folder per month."""
    (trip_csv_columns(trips_raw).write.mode("overwrite").partitionBy("month")
     .option("header", True).option("escape", '"').csv(root))
