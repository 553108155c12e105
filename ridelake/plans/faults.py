"""Registered queries whose inputs hold faults made by rule, so that every kind
of check, quarantine and rebuild has something to find. Each reads its whole
tables; a rule changes values or repeats rows, it leaves none out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.functions import scalars as S
from ridelake.operators.joins import fanout_keys
from ridelake.operators.quality import ModelChecks, accepted_values, run_model_checks
from ridelake.operators.rollup import cardinality, duplicates
from ridelake.plans import jobs as J
from ridelake.plans import models as M
from ridelake.plans import oracle as O
from ridelake.plans.checks import TRIP_KEY, model_checks
from ridelake.plans.tables import Tables
from ridelake.session import scratch_path
from ridelake.sinks.writers import add_run_timestamp, as_view, materialize_table
from ridelake.sources import adapters as A
from ridelake.sources import landing as L
from ridelake.sources.files import (parse_status_messages, read_multi_part_csv, read_station_snapshot_json, read_trip_months,
                                    split_malformed)

LOADED_AT = "2024-02-01 00:00:00"

# the faults, by the hour a trip starts in (SQL that both engines read alike)
FAULTS = {
    "trip_duration_minutes": "CASE WHEN started_hour = 3 THEN NULL WHEN started_hour % 4 = 1 "
                             "THEN trip_duration_minutes + 5 ELSE trip_duration_minutes END",
    "time_of_day": "CASE started_hour WHEN 7 THEN 'Dawn' WHEN 8 THEN 'Night' ELSE time_of_day END",
    "member_casual": "CASE WHEN started_hour = 9 THEN 'guest' ELSE member_casual END",
    "start_station_id": "CASE WHEN started_hour = 13 THEN 'gone-' || start_station_id ELSE start_station_id END",
}
TWICE = "started_hour = 12"


def faulty_trips(t: Tables) -> DataFrame:
    once = t.int_trips.withColumns({c: F.expr(rule) for c, rule in FAULTS.items()})
    return once.unionByName(once.filter(TWICE))


def faulty_trip_checks(t: Tables) -> DataFrame:
    """Every kind of check, each with failures, over trips with faults."""
    rows = [*model_checks()["int_trips"].rows, accepted_values("member_casual", S.MEMBER_TYPES)]
    spec = ModelChecks("faulty_trips", rows=rows, unique=["ride_id"], combos=[(TRIP_KEY, None)],
                       relations=[("start_station_id", "dim_station", "short_name")])
    return run_model_checks(faulty_trips(t), spec, {"dim_station": t.dim_station})


def _faulty_checks_sql() -> str:
    replaced = ", ".join(f"{rule} AS {c}" for c, rule in FAULTS.items())
    ctes = (*O.TRIPS_CHAIN, *O.DIM_CHAIN, f"once AS (SELECT * REPLACE ({replaced}) FROM int_trips)",
            f"faulty_trips AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE {TWICE})")
    name = "faulty_trips"
    found = [O._row(name, "not_null", c, "error", f"SELECT count(*) - count({c}) FROM {name}")
             for m, cols in O.DQ_NOT_NULL if m == "int_trips" for c in cols]
    accepted = [(c, v) for m, c, v in O.DQ_ACCEPTED if m == "int_trips"] + [("member_casual", "'member', 'casual'")]
    found += [O._row(name, "accepted_values", c, "error", f"SELECT count(*) FROM {name} WHERE {c} NOT IN ({v})")
              for c, v in accepted]
    found += [O._row(name, "expression", c, "error", f"SELECT count(*) FROM {name} WHERE {p}")
              for m, c, p in O.DQ_EXPRESSION if m == "int_trips"]
    for check, keys in (("unique", "ride_id"), ("unique_combination", "ride_id,started_at,ended_at")):
        found.append(O._row(name, check, keys, "error", f"SELECT count(*) FROM (SELECT 1 FROM {name} "
                            f"{'WHERE ride_id IS NOT NULL ' if check == 'unique' else ''}GROUP BY {keys} HAVING count(*) > 1)"))
    found.append(O._row(name, "relationships", "start_station_id->short_name", "warn",
                        f"SELECT count(start_station_id) FROM {name} WHERE start_station_id NOT IN "
                        "(SELECT short_name FROM dim_station WHERE short_name IS NOT NULL)"))
    return O.with_(*ctes) + "\nUNION ALL\n".join(found)


def order_fanout(t: Tables) -> DataFrame:
    """Orders that a join with their lines repeats, and how often."""
    orders, lines = (A.table(t.spark, t.sf_dir, n) for n in ("orders", "lineitem"))
    return fanout_keys(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")), ["o_orderkey"])


def repeated_reports(t: Tables) -> DataFrame:
    """Reports of one kind by one user on one day, where there are several."""
    events = A.table(t.spark, t.sf_dir, "events")
    return duplicates(events.withColumn("day", S.day_key("ts")), ["user_id", "event_type", "day"])


def reporting_users(t: Tables) -> DataFrame:
    return cardinality(A.table(t.spark, t.sf_dir, "events"), "user_id", "n_users")


def text_timestamps(t: Tables) -> DataFrame:
    """Timestamps as text: plain, with an offset, in ISO form with ``Z``, malformed."""
    text = S.ts_text("ts")
    place = F.col("event_id") % 4
    seen = (F.when(place == 0, text).when(place == 1, F.concat(text, F.lit("+05:00")))
            .when(place == 2, F.concat(F.translate(text, " ", "T"), F.lit("Z")))
            .otherwise(F.concat(F.lit("not "), text)))
    rows = A.table(t.spark, t.sf_dir, "events").select("event_id", seen.alias("seen"))
    return rows.select("event_id", S.text_to_utc("seen").alias("seen_at"))


def malformed_documents(t: Tables) -> DataFrame:
    """Feed documents without data, and texts that are no documents, are set
    apart and counted; the others are flattened."""
    docs = L.status_documents(A.table(t.spark, t.sf_dir, "events"))
    broken = F.expr("CASE doc_id % 5 WHEN 0 THEN '{\"last_updated\": 1}' WHEN 1 THEN 'no document' ELSE value END")
    good, bad = split_malformed(parse_status_messages(docs.withColumn("value", broken)))
    count = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"))
    return count(M.flatten_status(good, LOADED_AT), "station rows kept").unionByName(count(bad, "documents set apart"))


def multi_part_csv(t: Tables) -> DataFrame:
    """Each month's CSV in several parts in sub-folders, read as one scan a month."""
    root = scratch_path(t.spark, "landing", "trip-parts")
    trips = L.trip_csv_columns(t.trips_raw).withColumn("part", F.pmod(F.xxhash64("ride_id"), F.lit(3)))
    (trips.write.partitionBy("month", "part").option("header", True).option("escape", '"').csv(root))
    months = [r[0] for r in t.trips_raw.select("source_month").distinct().orderBy("source_month").collect()]
    read = [M.transform_trips(read_multi_part_csv(t.spark, f"{root}/month={m}"), m, LOADED_AT) for m in months]
    return reduce(DataFrame.unionByName, read).drop("ingestion_at")


def rebuilt_table(t: Tables) -> DataFrame:
    """A day-partitioned table rebuilt over an older one that held other days too."""
    path = scratch_path(t.spark, "rebuilt")
    trips = t.int_trips.select("ride_id", "started_hour", "started_date")
    older = trips.withColumn("started_date", F.date_add("started_date", 400))
    for version in (trips.unionByName(older), trips):
        materialize_table(version, path, "started_date", ["started_hour"])
    back = t.spark.read.schema(trips.schema).parquet(path)
    return back.groupBy("started_date").agg(F.count(F.lit(1)).alias("n_rows"))


def session_view(t: Tables) -> DataFrame:
    """A model as a session view with its load instant, asked in SQL."""
    as_view(add_run_timestamp(t.int_trips, "run_at", LOADED_AT), "ridelake_run_trips")
    return t.spark.sql("SELECT run_at, member_casual, count(*) AS n FROM ridelake_run_trips GROUP BY ALL")


def padded_names(t: Tables) -> DataFrame:
    """Trip files whose station names are padded with blanks, read and typed."""
    root = scratch_path(t.spark, "landing", "padded")
    pad = lambda c: F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c)
    names = ("start_station_name", "end_station_name")
    (L.trip_csv_columns(t.trips_raw).withColumns({c: pad(c) for c in names}).write.partitionBy("month")
     .option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(root))
    raw = read_trip_months(t.spark, root)
    typed = M.transform_trips(raw, F.col("month"), LOADED_AT)
    counts = typed.groupBy("source_month", *names).agg(F.count(F.lit(1)).alias("n_rows"))
    padded = raw.agg(F.count_if(F.col("start_station_name").startswith("  ")).alias("n_padded")).scalar()
    return counts.withColumn("n_padded", padded)


def flag_ranks(t: Tables) -> DataFrame:
    """The quality flags in the order of their distribution, with their places in it."""
    found = M.flag_distribution(t.trips_enriched)
    # a row for each flag: a handful
    return found.withColumn("place", F.row_number().over(Window.orderBy(F.desc("trip_count"), "data_quality_flag")).cast("long"))


def chosen_days(t: Tables) -> DataFrame:
    """Every third day of a loaded table, by its folders: the scan has the days as partition filters."""
    warehouse = scratch_path(t.spark, "days")
    days = J.load_trips_raw(t.trips_raw, warehouse, mode="overwrite_days")
    chosen = [d for d in days if int(d) % 3 == 0]
    read = J.read_bronze_trips(t.spark, warehouse, chosen)
    pruned = "PartitionFilters: [date_str" in read._jdf.queryExecution().executedPlan().toString()
    return read.groupBy("date_str").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("pruned", F.lit(pruned))


def run_instant(t: Tables) -> DataFrame:
    """The run's instant on every row: one value, and later than all documents."""
    stamped = add_run_timestamp(t.stg_status, "run_at")
    return stamped.agg(F.count_distinct("run_at").alias("n_instants"), F.count(F.lit(1)).alias("n_rows"),
                       F.count_if(F.col("run_at") > F.col("feed_last_updated")).alias("n_later"),
                       (F.max("run_at") <= S.utc_now() + F.expr("INTERVAL 1 SECOND")).alias("not_ahead"))


def stations_over_lines(t: Tables) -> DataFrame:
    """Station documents of many lines each, several to a file: a thousand orders a document, fifty
    documents a file."""
    root = scratch_path(t.spark, "landing", "stations")
    numbered = A.station_snapshots_from_orders(A.table(t.spark, t.sf_dir, "orders"), ("o_orderkey",))
    st = F.struct("station_id", F.concat(F.lit(" "), F.col("station_name")).alias("name"), "short_name", F.col("lon").cast("string").alias("lon"),
                  F.col("lat").cast("string").alias("lat"), "region_id", F.col("capacity").cast("string").alias("capacity"))
    docs = numbered.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("doc")).agg(
        F.max(S.ts_to_epoch_seconds("extracted_at")).alias("last_updated"), F.collect_list(st).alias("stations"))
    texts = docs.select(F.to_json(F.struct("last_updated", F.struct("stations").alias("data")), {"pretty": "true"}).alias("value"),
                        F.floor(F.col("doc") / 50).alias("file"))
    files = texts.groupBy("file").agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("\n]")).alias("value"))
    last = files.agg(F.coalesce(F.max("file"), F.lit(0))).first()[0]
    files.repartitionById(int(last) + 1, F.col("file").cast("int")).select("value").write.text(root)
    read = M.transform_stations(read_station_snapshot_json(t.spark, root), extracted_at="document")
    return read.select("station_id", "station_name", "short_name", "lon", "lat", "region_id", F.col("capacity").cast("double").alias("capacity"), "extracted_at")


_SECOND = "date_trunc('second', ts)"

FOUND = {
    "faulty_trip_checks": (faulty_trip_checks, _faulty_checks_sql()),
    "order_fanout": (order_fanout, """SELECT l_orderkey AS o_orderkey, count(*) AS n FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey HAVING count(*) > 1"""),
    "repeated_reports": (repeated_reports, """SELECT user_id, event_type, strftime(ts, '%Y%m%d') AS day, count(*) AS n
FROM events GROUP BY ALL HAVING count(*) > 1"""),
    "reporting_users": (reporting_users, "SELECT count(DISTINCT user_id) AS n_users FROM events"),
    "text_timestamps": (text_timestamps, f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN {_SECOND}
  WHEN 1 THEN {_SECOND} - INTERVAL 5 HOUR WHEN 2 THEN {_SECOND} END AS seen_at FROM events"""),
    "malformed_documents": (malformed_documents, """SELECT 'station rows kept' AS kind, count(*) AS n FROM events
WHERE (event_id // 100) % 5 > 1
UNION ALL SELECT 'documents set apart', count(DISTINCT event_id // 100) FROM events WHERE (event_id // 100) % 5 <= 1"""),
    "multi_part_csv": (multi_part_csv, O.CSV_TRIPS),
    "rebuilt_table": (rebuilt_table, O.with_(*O.TRIPS_CHAIN)
                      + "SELECT started_date, count(*) AS n_rows FROM int_trips GROUP BY started_date"),
    "padded_names": (padded_names, O.with_(O.TRIP_ROWS, O.TRIPS_RAW) + """
SELECT source_month, start_station_name, end_station_name, count(*) AS n_rows,
  (SELECT count(start_station_name) FROM trips_raw) AS n_padded FROM trips_raw GROUP BY 1, 2, 3"""),
    "flag_ranks": (flag_ranks, O.with_(*O.ENRICHED_CHAIN) + """
SELECT data_quality_flag, count(*) AS trip_count, round(count(*) * 100.0e0 / sum(count(*)) OVER (), 2) AS pct_of_total,
  row_number() OVER (ORDER BY count(*) DESC, data_quality_flag) AS place FROM trips_enriched GROUP BY data_quality_flag"""),
    "chosen_days": (chosen_days, O.with_(O.TRIP_ROWS, O.TRIPS_RAW) + """
SELECT strftime(started_at, '%Y%m%d') AS date_str, count(*) AS n_rows, true AS pruned FROM trips_raw
WHERE CAST(strftime(started_at, '%Y%m%d') AS INTEGER) % 3 = 0 GROUP BY 1"""),
    "run_instant": (run_instant, """SELECT 1 AS n_instants, count(*) AS n_rows, count(*) AS n_later, true AS not_ahead FROM events"""),
    "stations_over_lines": (stations_over_lines, O.with_(O.SNAPSHOTS.replace("SELECT 'uuid-'", "SELECT o_orderkey, 'uuid-'")) + """
SELECT station_id, station_name, short_name, lon, lat, region_id, CAST(capacity AS DOUBLE) AS capacity,
  max(extracted_at) OVER (PARTITION BY o_orderkey // 1000) AS extracted_at FROM snapshots"""),
    "session_view": (session_view, O.with_(*O.TRIPS_CHAIN) + f"""SELECT TIMESTAMP '{LOADED_AT}' AS run_at, member_casual,
  count(*) AS n FROM int_trips GROUP BY member_casual"""),
}
