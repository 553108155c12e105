"""Explicit schemas for every raw input. Nothing is inferred: inference costs a
full extra scan at scale and silently changes types between files."""

from __future__ import annotations

from pyspark.sql import types as T

# Monthly trip CSV as published (all text; typed by the transform).
TRIP_CSV = T.StructType([
    T.StructField("ride_id", T.StringType()),
    T.StructField("rideable_type", T.StringType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("ended_at", T.StringType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("end_station_id", T.StringType()),
    T.StructField("start_lat", T.StringType()),
    T.StructField("start_lng", T.StringType()),
    T.StructField("end_lat", T.StringType()),
    T.StructField("end_lng", T.StringType()),
    T.StructField("member_casual", T.StringType()),
])

# Bronze trips table (typed CSV + load metadata).
TRIPS_RAW_COLUMNS = [
    "ingestion_at", "source_month", "source_data", "ride_id", "rideable_type",
    "started_at", "ended_at", "start_station_id", "start_station_name",
    "end_station_id", "end_station_name", "start_lat", "end_lat", "start_lng",
    "end_lng", "member_casual",
]

# Bronze trips as written by the loaders (``date_str`` is the day folder; the
# schema keeps it a string instead of letting partition discovery make it INT).
TRIPS_BRONZE = T.StructType([
    T.StructField("ingestion_at", T.TimestampNTZType()),
    T.StructField("source_month", T.StringType()),
    T.StructField("source_data", T.StringType()),
    T.StructField("ride_id", T.StringType()),
    T.StructField("rideable_type", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("end_station_id", T.StringType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("start_lat", T.DoubleType()),
    T.StructField("end_lat", T.DoubleType()),
    T.StructField("start_lng", T.DoubleType()),
    T.StructField("end_lng", T.DoubleType()),
    T.StructField("member_casual", T.StringType()),
    T.StructField("date_str", T.StringType()),
])

STATION_INFO_DOC = T.StructType([
    T.StructField("last_updated", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(T.StructType([
            T.StructField("station_id", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("short_name", T.StringType()),
            T.StructField("lon", T.StringType()),
            T.StructField("lat", T.StringType()),
            T.StructField("region_id", T.StringType()),
            T.StructField("capacity", T.StringType()),
            T.StructField("rental_uris", T.StructType([
                T.StructField("android", T.StringType()),
                T.StructField("ios", T.StringType()),
            ])),
        ]))),
    ])),
])

SNAPSHOT_COLUMNS = [
    "station_id", "station_name", "short_name", "lon", "lat", "region_id",
    "capacity", "rental_uri_android", "rental_uri_ios", "extracted_at",
]

STATUS_COUNTERS = [
    "num_bikes_available", "num_bikes_disabled", "num_docks_available",
    "num_docks_disabled", "is_installed", "is_renting", "is_returning",
    "last_reported", "num_ebikes_available", "num_scooters_available",
    "num_scooters_unavailable",
]

# 0/1 flags: older feed versions send numbers, newer ones JSON booleans; read
# as text so both survive parsing, then normalized to 0/1 when flattened.
STATUS_FLAGS = ["is_installed", "is_renting", "is_returning"]

STATUS_DOC = T.StructType([
    T.StructField("last_updated", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("stations", T.ArrayType(T.StructType(
            [T.StructField("station_id", T.StringType())]
            + [T.StructField(c, T.StringType() if c in STATUS_FLAGS else T.LongType())
               for c in STATUS_COUNTERS]
        ))),
    ])),
])

# Bronze status table: one row per station per feed message.
STATUS_RAW_COLUMNS = [
    "ingestion_at", "feed_last_updated", "station_id", "num_bikes_available",
    "num_bikes_disabled", "num_docks_available", "num_docks_disabled",
    "is_installed", "is_renting", "is_returning", "last_reported",
    "num_ebikes_available", "num_scooters_available", "num_scooters_unavailable",
]
