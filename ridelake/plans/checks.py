"""The quality checks attached to each model (53 in total: 29 not_null,
9 accepted_values, 2 unique, 4 relationships, 7 key-uniqueness and 2
expression-consistency checks)."""

from __future__ import annotations

from ridelake.functions import scalars as S
from ridelake.operators.quality import ModelChecks, accepted_values, expression, not_null

TRIP_KEY = ("ride_id", "started_at", "ended_at")


def _nn(*cols: str):
    return [not_null(c) for c in cols]


def _duration_mismatch() -> str:
    """Stored minutes disagree with seconds/60 by more than 0.01."""
    return "abs(trip_duration_minutes - round(trip_duration_seconds / 60.0D, 2)) > 0.01"


def _time_of_day_mismatch() -> str:
    bands = S.TIME_OF_DAY_BANDS + [(19, 23, S.TIME_OF_DAY_OTHER)]
    return " OR ".join(f"(started_hour BETWEEN {lo} AND {hi} AND time_of_day != {S.sql_str(label)})"
                       for lo, hi, label in bands)


def model_checks() -> dict[str, ModelChecks]:
    """Check specs per model (built on call: Columns need a live session)."""
    return {
        "stg_trips": ModelChecks(
            "stg_trips",
            rows=_nn("ride_id", "started_at", "ended_at")
            + [accepted_values("rideable_type", S.RIDEABLE_TYPES),
               accepted_values("member_casual", S.MEMBER_TYPES)],
            combos=[(TRIP_KEY, None)]),
        "stg_stations": ModelChecks(
            "stg_stations",
            rows=_nn("station_id", "station_name", "lat", "lon", "capacity"),
            combos=[(("station_id", "extracted_at"), None)]),
        "stg_status": ModelChecks(
            "stg_status",
            rows=_nn("station_id", "ingestion_at")
            + [accepted_values(c, [0, 1]) for c in ("is_installed", "is_renting", "is_returning")]),
        "int_trips": ModelChecks(
            "int_trips",
            rows=_nn("ride_id", "trip_duration_seconds", "trip_duration_minutes", "started_date",
                     "started_hour", "is_weekend", "time_of_day")
            + [accepted_values("is_weekend", [True, False]),
               accepted_values("time_of_day", S.TIME_OF_DAY_LABELS),
               expression("duration_consistency", _duration_mismatch()),
               expression("time_of_day_consistency", _time_of_day_mismatch())]),
        "dim_station": ModelChecks(
            "dim_station",
            rows=_nn("station_sk", "station_id", "valid_from", "is_current"),
            unique=["station_sk"],
            combos=[(("station_id",), "is_current")]),
        "trips_enriched": ModelChecks(
            "trips_enriched",
            rows=_nn("ride_id", "data_quality_flag")
            + [accepted_values("data_quality_flag", S.QUALITY_FLAGS)],
            combos=[(TRIP_KEY, None)],
            relations=[("start_station_id", "dim_station", "short_name"),
                       ("end_station_id", "dim_station", "short_name")]),
        "hourly_traffic": ModelChecks(
            "hourly_traffic",
            rows=_nn("started_date", "start_station_id", "total_trips"),
            combos=[(("started_date", "started_hour", "start_station_id", "member_casual",
                      "rideable_type"), None)],
            relations=[("start_station_id", "dim_station", "short_name")]),
        "status_current": ModelChecks(
            "status_current",
            rows=_nn("station_id"),
            unique=["station_id"],
            combos=[(("station_id",), None)],
            relations=[("station_id", "dim_station", "station_id")]),
        "demand_vs_supply": ModelChecks(
            "demand_vs_supply",
            rows=_nn("station_id", "supply_status")
            + [accepted_values("supply_status", S.SUPPLY_STATUSES)],
            combos=[(("station_id",), None)]),
    }
