"""The analysis models, one DataFrame -> DataFrame function each.

Layering (each arrow is plain function composition, so Catalyst sees the
whole plan and prunes/pushes across layers):

  trips_raw -> stg_trips -> int_trips -> trips_enriched -> hourly_traffic
  snapshots -> stg_stations -> dim_station --^        \\-> demand_vs_supply
  status_raw -> stg_status -> status_current ---------------^
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions import scalars as S
from ridelake.operators.dedup import dedup_priority, latest_per_key, month_match_priority
from ridelake.operators.joins import current_versions, enrich_as_of, fill_matches, lookup, match_current
from ridelake.operators.rollup import count_where, distribution, rollup
from ridelake.operators.scd import scd2
from ridelake.schemas import SNAPSHOT_COLUMNS, STATUS_FLAGS, TRIPS_RAW_COLUMNS

TRIP_KEY = ["ride_id", "started_at", "ended_at"]
TRACKED_STATION_ATTRS = ["station_name", "short_name", "lon", "lat", "region_id", "capacity"]
HOURLY_KEYS = ["started_date", "started_hour", "started_day_name", "is_weekend", "time_of_day",
               "start_station_id", "start_station_name", "member_casual", "rideable_type"]


def _ts_literal(value: datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    text = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, datetime) else value
    return S.ntz_literal(text)


# --------------------------------------------------------------- ingest (C1-C3)

def transform_trips(raw: DataFrame, month: str | Column, ingestion_at=None) -> DataFrame:
    """Typed trips from an all-text CSV frame. Malformed timestamps and
    coordinates become NULL (never an error); ``date_str`` is the day routing
    key (NULL when ``started_at`` is unparsable: see :func:`quarantine_trips`)."""
    month_col = month if isinstance(month, Column) else F.lit(str(month))
    ingest = S.utc_now() if ingestion_at is None \
        else _ts_literal(ingestion_at)
    started, ended = S.text_to_utc("started_at"), S.text_to_utc("ended_at")
    typed = raw.select(
        ingest.alias("ingestion_at"),
        month_col.cast("string").alias("source_month"),
        F.lit(S.SOURCE_DATA_BATCH).alias("source_data"),
        "ride_id", "rideable_type",
        started.alias("started_at"), ended.alias("ended_at"),
        "start_station_id",
        F.trim("start_station_name").alias("start_station_name"),
        "end_station_id",
        F.trim("end_station_name").alias("end_station_name"),
        *[F.col(c).try_cast("double").alias(c) for c in ("start_lat", "end_lat", "start_lng", "end_lng")],
        "member_casual",
    )
    return typed.withColumn("date_str", S.day_key("started_at"))


def quarantine_trips(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split typed trips into (routable, quarantined): rows without a
    parsable start time cannot be routed to a day partition."""
    ok = F.col("date_str").isNotNull()
    return typed.filter(ok), typed.filter(~ok)


def transform_stations(raw: DataFrame, extracted_at=None) -> DataFrame:
    """One row per station from station-information documents.
    ``extracted_at``: None = run time, ``"document"`` = the document's own
    ``last_updated`` (epoch seconds), or a fixed instant."""
    if extracted_at is None:
        ts = S.utc_now()
    elif isinstance(extracted_at, str) and extracted_at == "document":
        ts = S.epoch_seconds_to_ts("last_updated")
    else:
        ts = _ts_literal(extracted_at)
    st = raw.select(F.explode("data.stations").alias("s"), "last_updated")
    return st.select(
        F.trim(F.col("s.station_id").cast("string")).alias("station_id"),
        F.trim(F.col("s.name").cast("string")).alias("station_name"),
        F.trim(F.col("s.short_name").cast("string")).alias("short_name"),
        F.col("s.lon").try_cast("double").alias("lon"),
        F.col("s.lat").try_cast("double").alias("lat"),
        F.col("s.region_id").cast("string").alias("region_id"),
        F.col("s.capacity").try_cast("int").alias("capacity"),
        F.col("s.rental_uris.android").cast("string").alias("rental_uri_android"),
        F.col("s.rental_uris.ios").cast("string").alias("rental_uri_ios"),
        ts.alias("extracted_at"),
    )


def flatten_open_status(docs: DataFrame, known: Sequence[str]) -> DataFrame:
    """One row per station of VARIANT documents (``doc``): the ``known`` fields by their names, as
    whole numbers (flags true and false as 1 and 0), and every other field of the station
    as one JSON text ``extras`` (NULL without any), so that a feed version with new
    fields loses nothing."""
    station = docs.select(
        F.try_variant_get("doc", "$.last_updated", "bigint").alias("feed_last_updated"),
        F.explode(F.try_variant_get("doc", "$.data.stations", "array<variant>")).alias("s"))

    def number(c: str) -> Column:
        as_flag = F.try_variant_get("s", f"$.{c}", "boolean").cast("bigint")
        return F.coalesce(F.try_variant_get("s", f"$.{c}", "bigint"), as_flag).alias(c)

    fields = F.from_json(F.to_json("s"), "map<string,string>")
    extras = F.map_filter(fields, lambda k, v: ~k.isin("station_id", *known))
    return station.select("feed_last_updated", F.try_variant_get("s", "$.station_id", "string").alias("station_id"),
                          *[number(c) for c in known],
                          F.when(F.size(extras) > 0, F.to_json(F.map_from_entries(F.array_sort(F.map_entries(extras))))).alias("extras"))


def flatten_status(raw: DataFrame, ingestion_at=None) -> DataFrame:
    """One row per station per status document; works unchanged on a
    streaming DataFrame (stateless: explode + projection)."""
    ts = S.utc_now() if ingestion_at is None \
        else _ts_literal(ingestion_at)
    st = raw.select(F.col("last_updated").alias("feed_last_updated"),
                    F.explode("data.stations").alias("s"))

    def field(c: str) -> Column:
        if c in STATUS_FLAGS:  # true/false -> 1/0; any other value stays for the checks (-1: no number)
            return F.expr(f"CASE lower(CAST(s.{c} AS STRING)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 "
                          f"ELSE CASE WHEN s.{c} IS NOT NULL THEN coalesce(try_cast(s.{c} AS BIGINT), -1) END END"
                          ).cast("bigint").alias(c)
        return F.col(f"s.{c}").alias(c)

    return st.select(
        ts.alias("ingestion_at"),
        "feed_last_updated",
        F.col("s.station_id").alias("station_id"),
        *[field(c) for c in (
            "num_bikes_available", "num_bikes_disabled", "num_docks_available",
            "num_docks_disabled", "is_installed", "is_renting", "is_returning",
            "last_reported", "num_ebikes_available", "num_scooters_available",
            "num_scooters_unavailable")],
    )


# --------------------------------------------------------------- staging (C4-C6)

def stg_trips(trips_raw: DataFrame) -> DataFrame:
    """One row per trip key: a copy delivered in the trip's own month wins,
    then the most recent delivery."""
    deduped = dedup_priority(trips_raw, TRIP_KEY, month_match_priority(), "ingestion_at")
    return deduped.select(
        "ingestion_at", "source_month", "source_data", "ride_id", "rideable_type",
        "started_at", "ended_at", "start_station_id", "start_station_name",
        "end_station_id", "end_station_name", "start_lat", "start_lng", "end_lat",
        "end_lng", "member_casual")


def stg_stations(snapshots: DataFrame) -> DataFrame:
    return snapshots.select("station_id", "station_name", "short_name", "lat", "lon",
                            "region_id", "capacity", "rental_uri_android",
                            "rental_uri_ios", "extracted_at")


def stg_status(status_raw: DataFrame) -> DataFrame:
    """Typed status rows: epoch seconds become timestamps."""
    text = dict(status_raw.dtypes)["ingestion_at"] == "string"
    ingestion = S.text_to_utc("ingestion_at") if text else F.col("ingestion_at").cast("timestamp_ntz")
    return status_raw.select(
        ingestion.alias("ingestion_at"),
        S.epoch_seconds_to_ts("feed_last_updated").alias("feed_last_updated"),
        "station_id", "num_bikes_available", "num_bikes_disabled",
        "num_docks_available", "num_docks_disabled", "is_installed", "is_renting",
        "is_returning",
        S.epoch_seconds_to_ts("last_reported").alias("last_reported"),
        "num_ebikes_available", "num_scooters_available", "num_scooters_unavailable")


# --------------------------------------------------------------- intermediate (C7)

def add_time_dims(trips: DataFrame) -> DataFrame:
    """Duration and calendar attributes of each trip (projection only)."""
    secs = S.elapsed_seconds_sql("started_at", "ended_at")
    return trips.selectExpr(
        "ingestion_at", "source_month", "source_data", "ride_id", "rideable_type",
        "started_at", "ended_at",
        f"{S.minutes_2dp_sql(secs)} AS trip_duration_minutes",
        f"{secs} AS trip_duration_seconds",
        "to_date(started_at) AS started_date",
        "hour(started_at) AS started_hour",
        f"{S.weekday_name_sql('started_at')} AS started_day_name",
        f"{S.is_weekend_sql('started_at')} AS is_weekend",
        f"{S.time_of_day_sql('hour(started_at)')} AS time_of_day",
        "start_station_id", "start_station_name", "end_station_id", "end_station_name",
        "start_lat", "start_lng", "end_lat", "end_lng", "member_casual")


def int_trips(stg: DataFrame) -> DataFrame:
    return add_time_dims(stg)


# --------------------------------------------------------------- dimension (C8)

def dim_station(stations: DataFrame) -> DataFrame:
    """Station versions (SCD type 2) over every snapshot ever loaded."""
    snaps = stations.select(*SNAPSHOT_COLUMNS)
    return scd2(snaps, "station_id", TRACKED_STATION_ATTRS, "extracted_at",
                sk_name="station_sk")


# --------------------------------------------------------------- facts (C9-C13)

ENRICHED_COLUMNS = [
    "ingestion_at", "source_month", "source_data", "ride_id", "rideable_type",
    "started_at", "ended_at", "trip_duration_seconds", "trip_duration_minutes",
    "started_date", "started_hour", "started_day_name", "is_weekend", "time_of_day",
    "start_station_id", "start_station_name", "end_station_id", "end_station_name",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
]


def trips_matched(trips: DataFrame, dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """Trips with the current station versions that fit their ends, one row a trip: what
    several readers of :func:`trips_enriched` share."""
    return match_current(trips, dim, strategy=strategy)


def enriched_from(matched: DataFrame) -> DataFrame:
    """``trips_enriched`` of its matched trips (projections only)."""
    filled = fill_matches(matched).select(*ENRICHED_COLUMNS)
    flag = S.data_quality_flag("start_station_id", "start_lat", "start_lng",
                               "end_station_id", "end_lat", "end_lng",
                               "trip_duration_seconds")
    return filled.withColumn("data_quality_flag", flag)


def trips_enriched(trips: DataFrame, dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """Trips with station gaps filled from current station versions and a
    row-level quality flag (evaluated on the filled values)."""
    return enriched_from(trips_matched(trips, dim, strategy))


def trips_station_as_of(trips: DataFrame, dim: DataFrame, end: str = "start",
                        ts: str = "started_at", strategy: str = "auto",
                        time_bucket: str | None = "month", span: DataFrame | None = None,
                        tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Point-in-time variant: attach the station version that was valid at
    the trip's start (by station code). ``span``: raw trips, from whose times
    the months to cover are taken."""
    take = {"station_sk": f"{end}_station_sk", "station_name": f"{end}_version_name",
            "lat": f"{end}_version_lat", "lon": f"{end}_version_lng",
            "valid_from": f"{end}_version_valid_from"}
    return enrich_as_of(trips, dim, f"{end}_station_id", "short_name", ts, take,
                        strategy=strategy, time_bucket=time_bucket, span=span, tiebreak=tiebreak)


def hourly_traffic(enriched: DataFrame) -> DataFrame:
    """Trips per start station and hour cell (+ duration and quality counts)."""
    flag = F.col("data_quality_flag")
    measures = {
        "total_trips": F.count("ride_id"),
        "total_trip_duration_seconds": F.sum("trip_duration_seconds"),
        "avg_trip_duration_seconds": S.safe_divide(F.sum("trip_duration_seconds"), F.count("ride_id")),
        "valid_trips_count": count_where(flag == "valid"),
        "flagged_trips_count": count_where(flag != "valid"),
    }
    return rollup(enriched.filter(F.col("start_station_id").isNotNull()), HOURLY_KEYS, measures)


def flag_distribution(enriched: DataFrame) -> DataFrame:
    return distribution(enriched, "data_quality_flag", "trip_count", "pct_of_total")


def historical_demand(hourly: DataFrame, hour: int | Column | None = None,
                      day_name: str | Column | None = None) -> DataFrame:
    """Mean trips per (station code, hour, weekday) over hourly cells; optional
    hour/day restriction is applied before the aggregation."""
    h = hourly
    if hour is not None:
        h = h.filter(F.col("started_hour") == hour)
    if day_name is not None:
        h = h.filter(F.col("started_day_name") == day_name)
    return h.groupBy(F.col("start_station_id").alias("short_name"), "started_hour",
                     "started_day_name").agg(F.avg("total_trips").alias("avg_historical_trips"))


def status_current(stg: DataFrame, dim: DataFrame, strategy: str = "auto") -> DataFrame:
    """Latest status per station plus its current station attributes."""
    latest = latest_per_key(stg, ["station_id"], "ingestion_at")
    cur = current_versions(dim, ["station_id", "station_name", "short_name", "lat", "lon"])
    joined = lookup(latest, cur, {"station_id": "station_id"},
                    {"station_name": "station_name", "short_name": "short_name",
                     "lat": "lat", "lon": "lon"}, strategy=strategy, prefix="__cur")
    return joined.select(
        "ingestion_at", "station_id", "station_name", "short_name", "lat", "lon",
        "num_bikes_available", "num_bikes_disabled", "num_docks_available",
        "num_docks_disabled", "num_ebikes_available", "is_installed", "is_renting",
        "is_returning", "last_reported")


def demand_vs_supply(current: DataFrame, hourly: DataFrame, dim: DataFrame,
                     as_of: datetime | str | None = None, strategy: str = "auto",
                     tz: str | None = None) -> DataFrame:
    """Current bikes/docks per station against the historical mean demand for
    the weekday and hour of ``as_of``.

    ``as_of`` is a fixed instant (UTC wall-clock) so reruns agree; ``None``
    means the query's current time. ``tz`` reads the current hour/weekday on
    that zone's clock instead of UTC (trip hours stay as recorded)."""
    if as_of is None:
        now = "convert_timezone('UTC', CAST(current_timestamp() AS TIMESTAMP_NTZ))"
    else:
        now = S.ntz_sql(as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, datetime) else as_of)
    if tz:
        now = f"convert_timezone('UTC', {S.sql_str(tz)}, {now})"
    cur_hour = F.expr(f"hour({now})")
    cur_day = S.weekday_name(now)
    hist = historical_demand(hourly, cur_hour, cur_day).select("short_name", "avg_historical_trips")
    bridge = current_versions(dim, ["station_id", "short_name"])
    with_code = lookup(current, bridge, {"station_id": "station_id"},
                       {"short_name": "__bridge_code"}, strategy=strategy, prefix="__br")
    with_hist = lookup(with_code, hist, {"__bridge_code": "short_name"},
                       {"avg_historical_trips": "avg_historical_trips"},
                       strategy=strategy, prefix="__hd")
    return with_hist.select(
        "station_id", "station_name", "num_bikes_available", "num_docks_available",
        cur_hour.alias("current_hour"), cur_day.alias("current_day_name"),
        "avg_historical_trips",
        S.supply_status("num_bikes_available", "num_docks_available",
                        "avg_historical_trips").alias("supply_status"))
