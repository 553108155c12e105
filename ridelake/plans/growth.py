"""Registered queries over tables that grow by delivery: the dimension built run by run,
loads that take only new files, layers published only after their checks, a bucketed
layout. Each reads its whole tables; rules only decide in which delivery a row comes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions import scalars as S
from ridelake.operators.scd_deliveries import Dimension, deliver, read_dimension
from ridelake.plans import jobs as J
from ridelake.plans import models as M
from ridelake.plans import oracle as O
from ridelake.plans.tables import Tables
from ridelake.session import path_exists, scratch_path
from ridelake.sinks.writers import append_snapshot, write_bucketed
from ridelake.sources import adapters as A
from ridelake.sources import landing as L
from ridelake.sources.files import read_open_documents

LOADED_AT = "2024-02-01 00:00:00"


def scd2_incremental(t: Tables) -> DataFrame:
    """Station versions from three deliveries, the third of which brings late snapshots of
    many stations (and new ones of others)."""
    snapshots = t.stg_stations.select(*M.SNAPSHOT_COLUMNS)
    first, last = snapshots.agg(F.min("extracted_at"), F.max("extracted_at")).first()
    middle = S.ntz_literal((first + (last - first) / 2).strftime("%Y-%m-%d %H:%M:%S"))
    late = F.pmod(F.xxhash64("station_id", "extracted_at"), F.lit(40)) == 0
    turn = F.when(late, 2).when(F.col("extracted_at") < middle, 0).otherwise(1)
    store = Dimension(scratch_path(t.spark, "dim-store"), "station_id", M.TRACKED_STATION_ATTRS, "extracted_at", sk_name="station_sk")
    for k in range(3):
        deliver(store, snapshots.filter(turn == k))
    d = read_dimension(t.spark, store, snapshots.schema)
    return d.select(*[S.ts_text(c).alias(c) if c == "valid_to" else F.col(c).cast("double").alias(c) if c == "capacity" else c
                      for c in d.columns])


HOT = "CASE WHEN right({c}, 1) IN ('0', '3', '6') THEN 'HOT' ELSE {c} END"


def _hot_as_of(t: Tables, strategy: str) -> DataFrame:
    """The as-of join where a third of all stations, with their versions and trips, share one
    code: their versions become one line, in which the newer start wins."""
    dim = t.dim_station.withColumn("short_name", F.expr(HOT.format(c="short_name")))
    trips, raw = (d.withColumn("start_station_id", F.expr(HOT.format(c="start_station_id"))) for d in (t.int_trips, t.trips_raw))
    pit = M.trips_station_as_of(trips, dim, strategy=strategy, span=raw, tiebreak=("station_sk",),
                                time_bucket="day")
    return pit.select("ride_id", "started_at", "ended_at", "start_station_id", "start_station_sk", "start_version_valid_from")


def hot_station_as_of(t: Tables) -> DataFrame:
    return _hot_as_of(t, "auto")


def hot_station_as_of_sorted(t: Tables) -> DataFrame:
    return _hot_as_of(t, "sorted")


HOT_AS_OF = O.with_(*O.TRIPS_CHAIN, *O.DIM_CHAIN, f"""line AS (
  SELECT * FROM (SELECT station_sk, {HOT.format(c="short_name")} AS short_name, valid_from, valid_to
                 FROM dim_station WHERE valid_from < valid_to)
  QUALIFY row_number() OVER (PARTITION BY short_name, valid_from ORDER BY valid_to DESC, station_sk) = 1
), ended AS (
  SELECT station_sk, short_name, valid_from,
    least(valid_to, coalesce(lead(valid_from) OVER (PARTITION BY short_name ORDER BY valid_from), valid_to)) AS valid_to
  FROM line
), asked AS (
  SELECT ride_id, started_at, ended_at, {HOT.format(c="start_station_id")} AS start_station_id FROM int_trips
)""") + """
SELECT t.ride_id, t.started_at, t.ended_at, t.start_station_id,
  CASE WHEN t.started_at < d.valid_to THEN d.station_sk END AS start_station_sk,
  CASE WHEN t.started_at < d.valid_to THEN d.valid_from END AS start_version_valid_from
FROM asked t ASOF LEFT JOIN ended d ON t.start_station_id = d.short_name AND t.started_at >= d.valid_from"""


VERSIONS_SQL = O.with_(*O.DIM_CHAIN) + """
SELECT station_sk, station_id, station_name, short_name, lon, lat, region_id,
  CAST(capacity AS DOUBLE) AS capacity, rental_uri_android, rental_uri_ios, valid_from,
  strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to, is_current
FROM dim_station"""

def delivered_once(t: Tables) -> DataFrame:
    """Months that land in two steps and are loaded four times: each load takes what is new, the
    last two find nothing."""
    landing, warehouse = scratch_path(t.spark, "landing", "trips"), scratch_path(t.spark, "ledger-load")
    months = [r[0] for r in t.trips_raw.select("source_month").distinct().orderBy("source_month").collect()]
    loads = []
    for part in (months[:1], months[1:], [], []):
        if part:
            (L.trip_csv_columns(t.trips_raw.filter(F.col("source_month").isin(part))).write.mode("append")
             .partitionBy("month").option("header", True).option("escape", '"').csv(landing))
        loads += J.load_new_deliveries(t.spark, landing, warehouse, LOADED_AT)
    counts = J.read_bronze_trips(t.spark, warehouse).groupBy("source_month", "date_str").agg(F.count(F.lit(1)).alias("n_rows"))
    times = t.spark.createDataFrame([(m, loads.count(m)) for m in months], "source_month string, times_loaded long")
    return counts.join(times, "source_month").select("source_month", "date_str", "n_rows", "times_loaded")


def gated_layer(t: Tables) -> DataFrame:
    """A faulty load after a good one: the checks stop it, readers keep the good layer, and no later
    layer is built from it. Where the first load's own rows fail a check (of the stations as of the
    trips), it ends there too, and only the layers that are published are counted."""
    warehouse = scratch_path(t.spark, "gated")
    station = t.snapshots.withColumn("capacity", F.coalesce("capacity", F.lit(0)))
    append_snapshot(station, f"{warehouse}/{J.BRONZE}/station_snapshots")
    stations = J.build_station_models(t.spark, warehouse)
    J.load_trips_raw(t.trips_raw, warehouse, mode="overwrite_days")
    report = J.build_trip_models(t.spark, warehouse)
    first = [stations.stopped_at or report.stopped_at]
    faulty = t.trips_raw.filter("source_month = '202401'").withColumn("member_casual", F.when(
        F.col("member_casual") == "casual", F.lit("guest")).otherwise(F.col("member_casual")))
    J.load_trips_raw(faulty, warehouse, mode="overwrite_days")
    report = J.build_trip_models(t.spark, warehouse)
    names = [(layer, name) for layer, names in J.LAYER_TABLES.items() if layer != J.BRONZE for name in names
             if path_exists(t.spark, f"{warehouse}/{layer}/{name}")]
    kept = [t.spark.read.parquet(f"{warehouse}/{layer}/{name}").agg(
        F.lit(name).alias("layer"), F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(F.col("member_casual") == "guest") if name in ("stg_trips", "int_trips", "trips_enriched", "hourly_traffic")
         else F.lit(0).cast("bigint")).alias("n_faulty")) for layer, name in names]
    found = reduce(DataFrame.unionByName, kept) if kept else t.spark.createDataFrame([], "layer string, n_rows bigint, n_faulty bigint")
    return found.select("*", F.lit(str(first[0])).alias("first_stop"), F.lit(str(report.stopped_at)).alias("second_stop"))


def open_documents(t: Tables) -> DataFrame:
    """Feed documents of two versions, the newer one with flags as booleans and with fields that no
    schema knows, in files of several lines each: nothing is lost."""
    events = A.table(t.spark, t.sf_dir, "events")
    epoch = S.ts_to_epoch_seconds("ts")
    newer = (F.col("event_id") / 100).cast("long") % 2 == 1
    common = [F.concat(F.lit("uuid-"), F.col("user_id").cast("string")).alias("station_id"),
              (F.col("event_id") % 5).alias("num_bikes_available"), epoch.alias("last_reported")]
    old = F.to_json(F.struct(*common, F.lit(1).alias("is_renting")))
    new = F.to_json(F.struct(*common, (F.col("event_id") % 3 != 0).alias("is_renting"), F.col("event_type").alias("vehicle"),
                             F.struct((F.col("event_id") % 9).alias("scooters")).alias("dock")))
    station = F.when(newer, new).otherwise(old)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", station.alias("json")))), lambda s: s["json"]), ",\n  ")
    docs = events.groupBy(F.floor(F.col("event_id") / 100).alias("doc_id")).agg(F.max(epoch).alias("u"), body.alias("stations"))
    # up to 50 documents a file, as an array over many lines
    doc = F.concat(F.lit('{"last_updated": '), F.col("u").cast("string"), F.lit(', "data": {"stations": [\n  '), F.col("stations"), F.lit("\n]}}"))
    blocks = docs.groupBy(F.floor(F.col("doc_id") / 50).alias("file")).agg(F.concat(
        F.lit("[\n"), F.array_join(F.collect_list(doc), ",\n"), F.lit("\n]")).alias("value"))
    landing = scratch_path(t.spark, "landing", "open")
    last = blocks.agg(F.coalesce(F.max("file"), F.lit(0))).first()[0]
    blocks.repartitionById(int(last) + 1, F.col("file").cast("int")).select("value").write.text(landing)
    return M.flatten_open_status(read_open_documents(t.spark, landing), ["num_bikes_available", "last_reported", "is_renting"])


def bucketed_hourly(t: Tables) -> DataFrame:
    """Hourly traffic from trips laid out in buckets of day, hour and station: no exchange."""
    path = scratch_path(t.spark, "bucketed", "trips_enriched")
    name = "ridelake_" + path.rsplit("/", 1)[-1]
    by = ["started_date", "started_hour", "start_station_id"]
    trips = write_bucketed(t.trips_enriched, name, path, by, int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return M.hourly_traffic(trips)


_EPOCH = "date_sub('second', TIMESTAMP '1970-01-01 00:00:00', ts)"

# the layers of the first load: its trips, of which every event is one, and the stations
# with 0 where a capacity is missing
_GATED_CHAIN = [c.replace("'5-LOW' THEN NULL", "'5-LOW' THEN 0") for c in (*O.ENRICHED_CHAIN, O.HOURLY)]
GATED_SQL = O.with_(*_GATED_CHAIN) + "\nUNION ALL\n".join(
    f"""SELECT '{layer}' AS layer, count(*) AS n_rows, 0 AS n_faulty, 'None' AS first_stop, 'stg_trips' AS second_stop FROM {table}"""
    for layer, table in (("stg_trips", "int_trips"), ("int_trips", "int_trips"), ("dim_station", "dim_station"),
                         ("trips_enriched", "trips_enriched"), ("hourly_traffic", "hourly_traffic")))

FOUND = {
    "scd2_incremental": (scd2_incremental, VERSIONS_SQL),
    "delivered_once": (delivered_once, O.with_(O.TRIP_ROWS, O.TRIPS_RAW) + """
SELECT source_month, strftime(started_at, '%Y%m%d') AS date_str, count(*) AS n_rows, 1 AS times_loaded
FROM trips_raw GROUP BY ALL"""),
    "gated_layer": (gated_layer, GATED_SQL),
    "open_documents": (open_documents, f"""SELECT
  max({_EPOCH}) OVER (PARTITION BY event_id // 100) AS feed_last_updated, 'uuid-' || CAST(user_id AS VARCHAR) AS station_id,
  event_id % 5 AS num_bikes_available, {_EPOCH} AS last_reported,
  CASE WHEN event_id // 100 % 2 = 1 AND event_id % 3 = 0 THEN 0 ELSE 1 END AS is_renting,
  CASE WHEN event_id // 100 % 2 = 1 THEN '{{"dock":"{{\\"scooters\\":' || CAST(event_id % 9 AS VARCHAR) || '}}","vehicle":"' || event_type || '"}}' END AS extras
FROM events"""),
    "bucketed_hourly_traffic": (bucketed_hourly, O.with_(*O.ENRICHED_CHAIN, O.HOURLY) + "SELECT * FROM hourly_traffic"),
    "hot_station_as_of": (hot_station_as_of, HOT_AS_OF),
    "hot_station_as_of_sorted": (hot_station_as_of_sorted, HOT_AS_OF),
}
