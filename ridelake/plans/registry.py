"""Registered queries: name -> Spark callable, plus the oracle SQL of each.

Every query reads the full driver tables of ``sf_dir`` (or data Spark derives
from them); none subsets rows. Timestamps that may hold the open-end sentinel
are rendered as text so they survive conversion to pandas.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.functions import scalars as S
from ridelake.operators.dedup import latest_per_key
from ridelake.operators.joins import fanout_keys
from ridelake.operators.quality import only, run_model_checks, summarize
from ridelake.operators.rollup import distinct_values
from ridelake.plans import faults, growth, streams
from ridelake.plans import jobs as J
from ridelake.plans import models as M
from ridelake.plans import oracle as O
from ridelake.plans.checks import model_checks
from ridelake.plans.tables import Tables
from ridelake.session import scratch_path
from ridelake.sinks.writers import append_snapshot, read_version, write_day_partitioned
from ridelake.sources import adapters as A
from ridelake.sources import landing as L
from ridelake.sources.files import (parse_status_messages, read_station_snapshot_json,
                                    read_trip_months, require_columns, split_malformed)
from ridelake.streaming.status import (await_bounded, start_latest_status_stream,
                                       start_status_stream)

QueryFn = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _Q[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _text_ts(col: str) -> F.Column:
    return S.ts_text(col).alias(col)


# ------------------------------------------------------------------ trips slice

@register("hourly_traffic_raw", O.with_(*O.TRIPS_CHAIN) + """
SELECT started_date, started_hour, started_day_name, start_station_id, member_casual,
  rideable_type, count(ride_id) AS total_trips,
  CAST(sum(trip_duration_seconds) AS BIGINT) AS total_trip_duration_seconds,
  sum(trip_duration_seconds) / nullif(count(ride_id), 0) AS avg_trip_duration_seconds
FROM int_trips WHERE start_station_id IS NOT NULL GROUP BY ALL""")
def q_hourly_traffic_raw(t: Tables) -> DataFrame:
    """Minimum slice: dedup -> time dims -> hourly rollup on raw codes."""
    secs = F.sum("trip_duration_seconds")
    return (t.int_trips.filter(F.col("start_station_id").isNotNull())
            .groupBy("started_date", "started_hour", "started_day_name", "start_station_id",
                     "member_casual", "rideable_type")
            .agg(F.count("ride_id").alias("total_trips"),
                 secs.alias("total_trip_duration_seconds"),
                 S.safe_divide(secs, F.count("ride_id")).alias("avg_trip_duration_seconds")))


@register("dedup_priority_trips", O.with_(O.TRIP_ROWS, O.TRIPS_RAW, O.STG_TRIPS)
          + "SELECT * FROM stg_trips")
def q_dedup(t: Tables) -> DataFrame:
    return t.stg_trips


@register("int_trips_time_dims", O.with_(*O.TRIPS_CHAIN) + "SELECT * FROM int_trips")
def q_int_trips(t: Tables) -> DataFrame:
    return t.int_trips


# ------------------------------------------------------------------ dimension

@register("scd2_stations", O.with_(*O.DIM_CHAIN) + """
SELECT station_sk, station_id, station_name, short_name, lon, lat, region_id,
  CAST(capacity AS DOUBLE) AS capacity, rental_uri_android, rental_uri_ios, valid_from,
  strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, is_current
FROM dim_station""")
def q_scd2(t: Tables) -> DataFrame:
    d = t.dim_station
    return d.select(*[_text_ts(c) if c == "valid_to" else
                      F.col(c).cast("double").alias(c) if c == "capacity" else c
                      for c in d.columns])


@register("scd2_current_only", O.with_(*O.DIM_CHAIN) + """
SELECT station_sk, station_id, station_name, short_name, lon, lat, region_id,
  CAST(capacity AS DOUBLE) AS capacity, valid_from
FROM dim_station WHERE is_current""")
def q_scd2_current(t: Tables) -> DataFrame:
    return t.dim_station.filter("is_current").select(
        "station_sk", "station_id", "station_name", "short_name", "lon", "lat", "region_id",
        F.col("capacity").cast("double").alias("capacity"), "valid_from")


@register("surrogate_keys", O.with_(*O.DIM_CHAIN) + """
SELECT station_id, valid_from, station_sk,
  count(*) OVER (PARTITION BY station_sk) AS sk_uses
FROM dim_station""")
def q_surrogate_keys(t: Tables) -> DataFrame:
    d = t.dim_station.select("station_id", "valid_from", "station_sk")
    uses = d.groupBy("station_sk").agg(F.count(F.lit(1)).alias("sk_uses"))
    return d.join(uses, "station_sk").select("station_id", "valid_from", "station_sk", "sk_uses")


# ------------------------------------------------------------------ enrichment

_FILLED = ["start_station_id", "start_station_name", "start_lat", "start_lng",
           "end_station_id", "end_station_name", "end_lat", "end_lng"]


@register("enrich_current", O.with_(*O.ENRICHED_CHAIN) + f"""
SELECT ride_id, started_at, ended_at, {", ".join(_FILLED)} FROM trips_enriched""")
def q_enrich_current(t: Tables) -> DataFrame:
    return t.trips_enriched.select("ride_id", "started_at", "ended_at", *_FILLED)


_AS_OF_SQL = O.with_(*O.TRIPS_CHAIN, *O.DIM_CHAIN) + """
SELECT t.ride_id, t.started_at, t.ended_at, t.start_station_id,
  d.station_sk AS start_station_sk, d.station_name AS start_version_name,
  d.lat AS start_version_lat, d.lon AS start_version_lng,
  d.valid_from AS start_version_valid_from
FROM int_trips t LEFT JOIN dim_station d
  ON t.start_station_id = d.short_name AND t.started_at >= d.valid_from AND t.started_at < d.valid_to"""


@register("enrich_as_of", _AS_OF_SQL)
def q_enrich_as_of(t: Tables) -> DataFrame:
    pit = M.trips_station_as_of(t.int_trips, t.dim_station, strategy=t.strategy, span=t.trips_raw)
    return pit.select("ride_id", "started_at", "ended_at", "start_station_id", "start_station_sk",
                      "start_version_name", "start_version_lat", "start_version_lng",
                      "start_version_valid_from")


@register("enrich_as_of_sorted", _AS_OF_SQL)
def q_enrich_as_of_sorted(t: Tables) -> DataFrame:
    """Same point-in-time join through the sort-based, skew-safe as-of plan
    (what large version histories use)."""
    pit = M.trips_station_as_of(t.int_trips, t.dim_station, strategy="sorted", span=t.trips_raw)
    return pit.select("ride_id", "started_at", "ended_at", "start_station_id", "start_station_sk",
                      "start_version_name", "start_version_lat", "start_version_lng",
                      "start_version_valid_from")


@register("enriched_flags", O.with_(*O.ENRICHED_CHAIN) + "SELECT * FROM trips_enriched")
def q_enriched(t: Tables) -> DataFrame:
    return t.trips_enriched


@register("join_fanout", O.with_(*O.ENRICHED_CHAIN) + """
SELECT ride_id, started_at, ended_at, count(*) AS n FROM trips_enriched
GROUP BY ride_id, started_at, ended_at HAVING count(*) > 1""")
def q_join_fanout(t: Tables) -> DataFrame:
    return fanout_keys(t.trips_enriched, ["ride_id", "started_at", "ended_at"])


@register("flag_distribution", O.with_(*O.ENRICHED_CHAIN) + """
SELECT data_quality_flag, count(*) AS trip_count,
  round(count(*) * 100.0e0 / sum(count(*)) OVER (), 2) AS pct_of_total
FROM trips_enriched GROUP BY data_quality_flag ORDER BY trip_count DESC""")
def q_flag_distribution(t: Tables) -> DataFrame:
    return M.flag_distribution(t.trips_enriched)


# ------------------------------------------------------------------ rollups

@register("hourly_traffic", O.with_(*O.ENRICHED_CHAIN, O.HOURLY) + "SELECT * FROM hourly_traffic")
def q_hourly(t: Tables) -> DataFrame:
    return t.hourly_traffic


@register("historical_demand", O.with_(*O.ENRICHED_CHAIN, O.HOURLY) + """
SELECT start_station_id AS short_name, started_hour, started_day_name,
  round(avg(total_trips), 6) AS avg_historical_trips
FROM hourly_traffic GROUP BY start_station_id, started_hour, started_day_name""")
def q_historical_demand(t: Tables) -> DataFrame:
    h = M.historical_demand(t.hourly_traffic)
    return h.withColumn("avg_historical_trips", F.round("avg_historical_trips", 6))


# ------------------------------------------------------------------ status

@register("latest_status", O.with_(*O.STATUS_CHAIN) + "SELECT * FROM latest_status")
def q_latest_status(t: Tables) -> DataFrame:
    return latest_per_key(t.stg_status, ["station_id"], "ingestion_at")


@register("status_current", O.with_(*O.DIM_CHAIN, *O.STATUS_CHAIN, O.STATUS_CURRENT)
          + "SELECT * FROM status_current")
def q_status_current(t: Tables) -> DataFrame:
    return t.status_current


DEMAND_SQL = (O.with_(*O.ENRICHED_CHAIN, O.HOURLY, *O.STATUS_CHAIN, O.STATUS_CURRENT, O.DEMAND)
              + "SELECT * FROM demand_vs_supply")


@register("demand_vs_supply", DEMAND_SQL)
def q_demand(t: Tables) -> DataFrame:
    return t.demand_vs_supply


# ------------------------------------------------------------------ quality checks

_CHECKED_MODELS = ["stg_trips", "stg_stations", "stg_status", "int_trips", "dim_station",
                   "trips_enriched", "hourly_traffic", "status_current", "demand_vs_supply"]


# what a model is built from, of the models that are worth sharing; in build order
_BUILT_FROM = {
    "stg_trips": (), "int_trips": ("stg_trips",), "dim_station": (), "trips_enriched": ("int_trips", "dim_station"),
    "hourly_traffic": ("trips_enriched",), "status_current": ("dim_station",),
    "demand_vs_supply": ("status_current", "hourly_traffic", "dim_station"),
}


_SHARED = ("stg_trips", "dim_station", "trips_enriched")  # with the windows and joins; the rest are cheap projections and sums of them
# written in their place: a trip of many matches is one row there, and many in the model
_WRITTEN_AS = {"trips_enriched": "trips_matched"}


def shared_models(checked: list[str], with_parents: list[str]) -> list[str]:
    """The models that several checks and models read, in build order; those of ``with_parents``
    (relationship checks) read the dimension too."""
    readers: dict[str, int] = {}

    def read(name: str) -> None:
        readers[name] = readers.get(name, 0) + 1
        if readers[name] == 1:
            for parent in _BUILT_FROM.get(name, ()):
                read(parent)

    for name in checked:
        read(name)
    for _ in with_parents:
        read("dim_station")
    return [n for n in _SHARED if readers.get(n, 0) > 1]


def check_results(t: Tables, kinds=None, check: str | None = None, share: bool = True) -> DataFrame:
    """Union of the selected checks over every model.

    With ``share``, models that several checks and models read are written once, as the
    layered job does with all of them, so the versions and the joins run once
    whatever the number of checks; the others stay in the plan. Without it all is one plan."""
    specs = {n: model_checks()[n] if check is None else only(model_checks()[n], check) for n in _CHECKED_MODELS}
    specs = {n: s for n, s in specs.items() if s.covers(kinds)}
    related = kinds is None or "relationships" in kinds
    for name in shared_models(list(specs), [n for n, s in specs.items() if s.relations and related]) if share else ():
        written = _WRITTEN_AS.get(name, name)
        model, path = t.model(written), scratch_path(t.spark, "checked", written)
        model.write.parquet(path)
        t.__dict__.pop(name, None)
        t.__dict__[written] = t.spark.read.schema(model.schema).parquet(path)
    parts = []
    for name, spec in specs.items():
        parents = {"dim_station": t.dim_station} if spec.relations and related else {}
        parts.append(run_model_checks(t.model(name), spec, parents, kinds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("dq_not_null", O.dq_sql(O.dq_not_null_rows()))
def q_dq_not_null(t: Tables) -> DataFrame:
    return check_results(t, ["row"], "not_null")


@register("dq_accepted_values", O.dq_sql(O.dq_accepted_rows()))
def q_dq_accepted(t: Tables) -> DataFrame:
    return check_results(t, ["row"], "accepted_values")


@register("dq_expression", O.dq_sql(O.dq_expression_rows()))
def q_dq_expression(t: Tables) -> DataFrame:
    return check_results(t, ["row"], "expression")


@register("dq_unique", O.dq_sql(O.dq_unique_rows()))
def q_dq_unique(t: Tables) -> DataFrame:
    return check_results(t, ["unique"])


@register("dq_relationships", O.dq_sql(O.dq_relationship_rows()))
def q_dq_relationships(t: Tables) -> DataFrame:
    return check_results(t, ["relationships"], share=False)  # few readers: sharing saves less than it writes


@register("dq_unique_combination", O.dq_sql(O.dq_combo_rows()))
def q_dq_combos(t: Tables) -> DataFrame:
    return check_results(t, ["unique_combination"])


@register("dq_gate_summary", O.dq_summary_sql())
def q_dq_gate(t: Tables) -> DataFrame:
    return summarize(check_results(t))


# ------------------------------------------------------------------ sources, sinks, stream

FIXED_INGESTION = "2024-02-01 00:00:00"


@register("flatten_json_docs", O.FLAT_STATUS)
def q_flatten_json(t: Tables) -> DataFrame:
    """Feed payload strings -> parsed documents -> one row per station."""
    docs = L.status_documents(A.table(t.spark, t.sf_dir, "events"))
    parsed = require_columns(parse_status_messages(docs), ["data"])
    good, _bad = split_malformed(parsed)
    return M.flatten_status(good, FIXED_INGESTION)


@register("stream_status_flatten", O.FLAT_STATUS)
def q_stream_flatten(t: Tables) -> DataFrame:
    """Land feed documents as files, run the status stream to completion
    (bounded intake per micro-batch, checkpointed parquet sink), read the
    bronze table back."""
    landing = scratch_path(t.spark, "landing", "status")
    L.write_json_lines(L.status_documents(A.table(t.spark, t.sf_dir, "events")), landing)
    bronze = scratch_path(t.spark, "bronze", "status")
    q = start_status_stream(t.spark, landing, bronze, scratch_path(t.spark, "checkpoints"),
                            available_now=True, ingestion_at=FIXED_INGESTION)
    await_bounded(q)
    return t.spark.read.parquet(bronze)


@register("stream_latest_status", O.STREAM_LATEST)
def q_stream_latest(t: Tables) -> DataFrame:
    """Streaming latest-status-per-station state. Each document's own time is
    its ingestion time, so the newest report per station is well defined."""
    landing = scratch_path(t.spark, "landing", "status")
    L.write_json_lines(L.status_documents(A.table(t.spark, t.sf_dir, "events")), landing)
    target = scratch_path(t.spark, "silver", "status_latest")
    q = start_latest_status_stream(t.spark, landing, target, scratch_path(t.spark, "checkpoints"),
                                   available_now=True,
                                   ingestion_at=S.epoch_seconds_to_ts("feed_last_updated"))
    await_bounded(q)
    return read_version(t.spark, target)


@register("station_info_json", O.STATION_DOCS)
def q_station_json(t: Tables) -> DataFrame:
    """Station documents landed as JSON files, read back and flattened."""
    landing = scratch_path(t.spark, "landing", "station_information")
    L.write_json_lines(L.station_info_documents(t.snapshots), landing)
    raw = read_station_snapshot_json(t.spark, landing, multi_line=False)
    st = M.transform_stations(raw, extracted_at="document")
    return st.select(*[F.col(c).cast("double").alias(c) if c == "capacity" else c
                       for c in ("station_id", "station_name", "short_name", "lon", "lat",
                                 "region_id", "capacity", "rental_uri_android",
                                 "rental_uri_ios", "extracted_at")])


@register("csv_trip_months", O.CSV_TRIPS)
def q_csv_months(t: Tables) -> DataFrame:
    """Monthly CSV landing folders read in one scan (month from the folder)."""
    root = scratch_path(t.spark, "landing", "trips")
    L.write_trip_csv_landing(t.trips_raw, root)
    raw = read_trip_months(t.spark, root)
    typed = M.transform_trips(raw, F.col("month"), FIXED_INGESTION)
    return typed.drop("ingestion_at")


@register("day_split_counts", O.DAY_SPLIT)
def q_day_split(t: Tables) -> DataFrame:
    """Typed trips written as one folder per day in a single job, read back
    with the folder as a string partition column."""
    typed = t.trips_raw.withColumn("date_str", S.day_key("started_at"))
    path = scratch_path(t.spark, "bronze", "trips")
    write_day_partitioned(typed, path, "date_str", ["start_station_id", "member_casual"],
                          mode="overwrite_days")
    back = t.spark.read.schema(typed.schema).parquet(path)
    return back.groupBy("date_str").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count_distinct("ride_id").alias("n_rides"))


@register("month_reload", O.MONTH_RELOAD)
def q_month_reload(t: Tables) -> DataFrame:
    """Every delivery loaded, then the later ones again (they hold re-delivered
    trips of earlier days): no reload touches what another delivery brought."""
    warehouse = scratch_path(t.spark, "reload")
    months = [r[0] for r in t.trips_raw.select("source_month").distinct().orderBy("source_month").collect()]
    for month in months + months[1:]:
        J.load_trips_raw(t.trips_raw.filter(F.col("source_month") == month), warehouse, mode="overwrite_days")
    return J.read_bronze_trips(t.spark, warehouse).groupBy("source_month", "date_str").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("distinct_days", O.DISTINCT_DAYS)
def q_distinct_days(t: Tables) -> DataFrame:
    """Day routing keys present in a load (NULL start times excluded)."""
    return distinct_values(t.trips_raw.select(S.day_key("started_at").alias("date_str")), "date_str")


@register("run_cardinality", O.RUN_CARDINALITY)
def q_run_cardinality(t: Tables) -> DataFrame:
    """Run-report counts: rows, distinct days, months and load runs."""
    return t.trips_raw.agg(F.count(F.lit(1)).alias("n_rows"),
                           F.count_distinct(S.day_key("started_at")).alias("n_days"),
                           F.count_distinct("source_month").alias("n_months"),
                           F.count_distinct("ingestion_at").alias("n_loads"))


@register("layered_run_checks", O.dq_all_sql())
def q_layered_run(t: Tables) -> DataFrame:
    """End-to-end layered job on a scratch warehouse: land the three feeds,
    build every layer as a table, run each layer's checks after it is written
    (report mode, so every layer is built) and return all check results."""
    wh = scratch_path(t.spark, "warehouse")
    append_snapshot(t.snapshots, f"{wh}/{J.BRONZE}/station_snapshots")
    t.status_raw.write.mode("append").parquet(f"{wh}/{J.BRONZE}/station_status")
    J.load_trips_raw(t.trips_raw, wh)
    report = J.build_station_models(t.spark, wh, on_error="report")
    J.build_trip_models(t.spark, wh, on_error="report", report=report)
    J.build_status_models(t.spark, wh, t.as_of, on_error="report", report=report)
    return report.all_results()


for _name, (_fn, _sql) in (faults.FOUND | growth.FOUND | streams.FOUND).items():
    register(_name, _sql)(_fn)


def queries() -> dict[str, QueryFn]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
