"""Layered batch jobs: ingest -> staging -> intermediate -> warehouse: write, check, publish.

Every materialized layer is written to a staging folder, its checks scan that table,
and only when they pass is it renamed into its place under ``warehouse``; a table that
fails stays staged for inspection, readers keep the former one and no later layer
is built. The next layer reads the published table, which cuts the lineage (a lost
executor recomputes from the last written layer, never from the raw files).
Only the check results (one small row per check) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.operators.scd_deliveries import Dimension, deliver, read_dimension
from ridelake.operators.quality import ERROR, RESULT_SCHEMA, QualityGateError, gate, run_model_checks
from ridelake.functions.scalars import day_key
from ridelake.plans import models as M
from ridelake.plans.checks import model_checks
from ridelake.schemas import TRIPS_BRONZE
from ridelake.session import list_names, path_exists, remove_path, scratch_path
from ridelake.sinks.writers import append_snapshot, layout, materialize_table, promote, published_version, write_day_partitioned
from ridelake.sources.files import read_station_snapshot_json, read_table, read_trip_months

BRONZE, STAGING, SILVER, GOLD, QUARANTINE = "bronze", "staging", "intermediate", "warehouse", "quarantine"
STAGED = "_staged"
TRIP_CLUSTER = ["start_station_id", "member_casual"]
TASK_ROWS = 250_000  # filled trips that a task writes, on average,
TASK_TRIPS = 25_000  # unless so few matched trips (which it sorts) make more


@dataclass
class RunReport:
    """Check results per layer; ``stopped_at`` names the layer whose error
    checks failed (nothing after it was built)."""
    results: list[DataFrame] = field(default_factory=list)
    warnings: list[dict] = field(default_factory=list)
    errors: list[dict] = field(default_factory=list)
    stopped_at: str | None = None

    def all_results(self) -> DataFrame | None:
        if not self.results:
            return None
        out = self.results[0]
        for r in self.results[1:]:
            out = out.unionByName(r)
        return out


def _check(report: RunReport, df: DataFrame, model: str, parents: dict[str, DataFrame],
           on_error: str) -> bool:
    """Run the model's checks and its gate; return False when the run must stop.
    The results are one small row per check, so they are collected once and
    kept as a tiny local frame."""
    res = run_model_checks(df, model_checks()[model], parents)
    if res is None:
        return True
    rows = res.collect()
    local = df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
    report.results.append(local)
    failing = [r.asDict() for r in rows if r["failures"] > 0]
    report.warnings += [r for r in failing if r["severity"] != ERROR]
    report.errors += [r for r in failing if r["severity"] == ERROR]
    try:
        gate(local)
    except QualityGateError:
        if on_error == "stop":
            report.stopped_at = model
            return False
    return True


def _publish(report: RunReport, df: DataFrame, warehouse: str, layer: str, name: str, parents: dict[str, DataFrame],
             on_error: str, days: list[str] | None = None, day_col: str | None = None, **layout_options) -> DataFrame | None:
    """Write a layer aside, check it there, and put it in place; None if its gate stops the run.
    ``days`` (yyyyMMdd): the table holds only those, and only those are replaced."""
    spark = df.sparkSession
    staged, target = f"{warehouse}/{STAGED}/{layer}/{name}", f"{warehouse}/{layer}/{name}"
    remove_path(spark, staged)
    materialize_table(df, staged, day_col, **layout_options)
    # the layer's own columns, so that an empty table and its day folders read back alike
    if not _check(report, spark.read.schema(df.schema).parquet(staged), name, parents, on_error):
        return None
    promote(spark, staged, target, day_col, None if days is None else [_iso(d) for d in days])
    return _day_slice(spark.read.schema(df.schema).parquet(target), days)


def _days(df: DataFrame) -> list[str]:
    """Day keys present in a load (one small distinct; at most one row per
    day reaches the driver)."""
    return sorted(r[0] for r in df.select("date_str").distinct().collect() if r[0] is not None)


def load_trip_files(spark: SparkSession, landing_root: str, warehouse: str,
                    months: list[str] | None = None, ingestion_at: datetime | str | None = None,
                    mode: str = "append") -> list[str]:
    """Monthly CSV landing folders -> typed bronze trips, one folder per day.
    Rows whose start time cannot be parsed go to a quarantine table instead
    of being dropped silently. Returns the day keys loaded.

    The text is parsed once, into a scratch table; both writes and the list of
    days read that."""
    raw = read_trip_months(spark, landing_root, months)
    typed = M.transform_trips(raw, F.col("month"), ingestion_at)
    parsed = scratch_path(spark, "parsed", "trips")
    typed.write.parquet(parsed)
    ok, bad = M.quarantine_trips(spark.read.schema(typed.schema).parquet(parsed))
    write_day_partitioned(ok, f"{warehouse}/{BRONZE}/trips_raw", "date_str", TRIP_CLUSTER, mode=mode,
                          load_col="source_month")
    # by month as well: a reload replaces its own rejects and adds none twice
    rejects = bad.write.partitionBy("source_month")
    rejects = (rejects.mode("append") if mode == "append"
               else rejects.mode("overwrite").option("partitionOverwriteMode", "dynamic"))
    rejects.parquet(f"{warehouse}/{QUARANTINE}/trips_raw")
    # one short row a delivery and day
    pairs = {(r[0], r[1]) for r in ok.select("source_month", "date_str").distinct().collect()}
    if mode == "overwrite_days":  # days that a delivery brought before and no longer has
        bronze = f"{warehouse}/{BRONZE}/trips_raw"
        for month in {m for m, _ in pairs} | set(months or ()):
            for folder in list_names(spark, f"{bronze}/source_month={month}"):
                if folder.startswith("date_str=") and (month, folder.split("=")[1]) not in pairs:
                    remove_path(spark, f"{bronze}/source_month={month}/{folder}")
    return sorted({d for _, d in pairs if d is not None})


MANIFEST = "manifest"
ENTRY = "path string, length long, modified timestamp, delivery string"


def landed_files(spark: SparkSession, landing_root: str) -> DataFrame:
    """(path, length, modified, delivery) of the trip files under ``landing_root``; only listed."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
             .load(landing_root).select("path", "length", F.col("modificationTime").alias("modified")))
    return files.filter(~F.col("path").contains("/__MACOSX/")).withColumn(
        "delivery", F.regexp_extract("path", r"month=([0-9]{6})", 1))


def loaded_files(spark: SparkSession, warehouse: str) -> DataFrame:
    """The files that are loaded, with the run that loaded them: a delivery's newest run counts."""
    path = f"{warehouse}/{MANIFEST}/trips_raw"
    if not path_exists(spark, path):
        return spark.createDataFrame([], ENTRY + ", run int")
    found = spark.read.schema(ENTRY + ", run int").parquet(path)
    newest = found.groupBy("delivery").agg(F.max("run").alias("run"))
    return found.join(newest, ["delivery", "run"], "left_semi")


def load_new_deliveries(spark: SparkSession, landing_root: str, warehouse: str,
                        ingestion_at: datetime | str | None = None) -> list[str]:
    """Load the deliveries of which a file is new, changed (by size or time) or gone since they
    were loaded, whole; returns them. The manifest is written after the rows, so a
    run that fails is repeated, and a reload replaces what the delivery brought before."""
    landed, loaded = landed_files(spark, landing_root), loaded_files(spark, warehouse)
    same = ["path", "length", "modified", "delivery"]
    new = landed.join(loaded, same, "left_anti").select("delivery")
    gone = loaded.join(landed, same, "left_anti").select("delivery")
    present = landed.select("delivery").distinct()
    # one short row a delivery
    due = sorted(r[0] for r in new.unionByName(gone.join(present, "delivery", "left_semi")).distinct().collect())
    if not due:
        return []
    runs = [int(n.split("=")[1]) for n in list_names(spark, f"{warehouse}/{MANIFEST}/trips_raw") if n.startswith("run=")]
    run = max(runs, default=-1) + 1
    scratch = scratch_path(spark, "manifest")
    landed.filter(F.col("delivery").isin(due)).write.parquet(scratch)  # as listed before the load, whatever lands meanwhile
    load_trip_files(spark, landing_root, warehouse, due, ingestion_at, mode="overwrite_days")
    spark.read.schema(ENTRY).parquet(scratch).write.mode("overwrite").parquet(f"{warehouse}/{MANIFEST}/trips_raw/run={run}")
    return due


def load_trips_raw(df: DataFrame, warehouse: str, mode: str = "append") -> list[str]:
    """Append an already-typed bronze frame (e.g. another feed adapter);
    returns the day keys it touched."""
    typed = df.withColumn("date_str", day_key("started_at"))
    write_day_partitioned(typed, f"{warehouse}/{BRONZE}/trips_raw", "date_str", TRIP_CLUSTER,
                          mode=mode, load_col="source_month")
    return _days(typed)


def read_bronze_trips(spark: SparkSession, warehouse: str,
                      days: list[str] | None = None) -> DataFrame:
    """Bronze trips; a ``days`` list prunes to those day folders before any
    file is opened."""
    df = spark.read.schema(TRIPS_BRONZE).parquet(f"{warehouse}/{BRONZE}/trips_raw")
    return df if days is None else df.filter(F.col("date_str").isin(days))


def load_station_files(spark: SparkSession, landing: str, warehouse: str,
                       extracted_at: datetime | str | None = None, multi_line: bool = True) -> None:
    append_snapshot(read_station_files(spark, landing, extracted_at, multi_line), f"{warehouse}/{BRONZE}/station_snapshots")


def read_station_files(spark: SparkSession, landing: str, extracted_at: datetime | str | None = None,
                       multi_line: bool = True) -> DataFrame:
    """Typed station snapshots of landed documents."""
    return M.transform_stations(read_station_snapshot_json(spark, landing, multi_line), extracted_at)


def build_station_models(spark: SparkSession, warehouse: str, on_error: str = "stop",
                         report: RunReport | None = None) -> RunReport:
    """Snapshots -> staging (checked) -> dim_station (rebuilt over the whole
    history, checked)."""
    report = report or RunReport()
    snaps = read_table(spark, warehouse, BRONZE, "station_snapshots")
    stg = M.stg_stations(snaps)
    if not _check(report, stg, "stg_stations", {}, on_error):
        return report
    _publish(report, M.dim_station(stg), warehouse, GOLD, "dim_station", {}, on_error)
    return report


def station_store(warehouse: str) -> Dimension:
    """Where the station dimension grows by delivery."""
    return Dimension(f"{warehouse}/{GOLD}/dim_station_store", "station_id", M.TRACKED_STATION_ATTRS, "extracted_at", sk_name="station_sk")


def deliver_stations(spark: SparkSession, warehouse: str, delivery: DataFrame, on_error: str = "stop",
                     report: RunReport | None = None) -> RunReport:
    """Take one delivery of (typed) station snapshots into the dimension, reading of its past only the
    open versions. The delivery is checked before it is taken, and the versions it makes
    before they become visible."""
    report = report or RunReport()
    stg = M.stg_stations(delivery)
    if not _check(report, stg, "stg_stations", {}, on_error):
        return report
    append_snapshot(delivery, f"{warehouse}/{BRONZE}/station_snapshots")
    deliver(station_store(warehouse), stg.select(*M.SNAPSHOT_COLUMNS),
            lambda changed: _check(report, changed, "dim_station", {}, on_error))
    return report


def read_dim_station(spark: SparkSession, warehouse: str) -> DataFrame:
    """The station dimension, grown by delivery where it is, else as last built over all snapshots."""
    store = station_store(warehouse)
    if published_version(spark, f"{store.root}/open") is None:
        return read_table(spark, warehouse, GOLD, "dim_station")
    snapshots = M.stg_stations(read_table(spark, warehouse, BRONZE, "station_snapshots")).select(*M.SNAPSHOT_COLUMNS)
    return read_dimension(spark, store, snapshots.schema)


def _lacks(report: RunReport, spark: SparkSession, warehouse: str, name: str) -> bool:
    """Whether a published table that the next layers read isn't there, as where its checks have stopped its first
    load. The run then stops at it, like one that is stopped by checks of its own."""
    grown = name == "dim_station" and published_version(spark, f"{station_store(warehouse).root}/open") is not None
    if grown or path_exists(spark, f"{warehouse}/{GOLD}/{name}"):
        return False
    report.stopped_at = report.stopped_at or name
    return True


def build_trip_models(spark: SparkSession, warehouse: str, on_error: str = "stop",
                      report: RunReport | None = None, strategy: str = "auto",
                      days: list[str] | None = None) -> RunReport:
    """Bronze trips -> stg (table, checked) -> int (table, checked) -> enriched
    (table, checked) -> hourly traffic (table, checked). Stops before the enriched
    layer while no dim_station is published.

    ``days`` rebuilds only those days: every copy of a trip shares its start
    time, so dedup, time dimensions and the hourly rollup are day-local and
    the slice result equals the full rebuild for those days (enrichment uses
    the dimension as of this run, as a full rebuild would). Only those bronze
    day folders are read and only those output day folders are replaced (or
    removed, where a day has no rows any more)."""
    report = report or RunReport()
    laid = {"day_col": "started_date", "cluster_cols": TRIP_CLUSTER, "days": days}
    # the priority dedup is the one full shuffle of the trip history: run it
    # once, write the staging model as a day-partitioned table, and let its
    # checks and the next layer read that table
    deduped = M.stg_trips(read_bronze_trips(spark, warehouse, days)).withColumn("started_date", F.to_date("started_at"))
    stg = _publish(report, deduped, warehouse, STAGING, "stg_trips", {}, on_error, **laid)
    if stg is None:
        return report
    # a projection of the table just laid out: written as it lies
    trips = M.int_trips(stg.drop("started_date"))
    it = _publish(report, trips, warehouse, SILVER, "int_trips", {}, on_error, laid_out=True, **laid)
    if it is None or _lacks(report, spark, warehouse, "dim_station"):
        return report
    dim = read_dim_station(spark, warehouse)
    enriched = M.enriched_from(_laid_out_matches(M.trips_matched(it, dim, strategy)))
    enr = _publish(report, enriched, warehouse, GOLD, "trips_enriched", {"dim_station": dim}, on_error, in_order=True, **laid)
    if enr is None:
        return report
    _publish(report, M.hourly_traffic(enr), warehouse, GOLD, "hourly_traffic", {"dim_station": dim}, on_error, **laid)
    return report


def _laid_out_matches(matched: DataFrame) -> DataFrame:
    """Matched trips in the layout and order of the table that they will fill (a trip without a code stands by the
    first that it will get). They are written once, so that the joins run once, and laid out
    before a trip becomes many rows; the partitions are as many as those rows need
    (``TASK_ROWS`` each), but no more than the trips (``TASK_TRIPS``): the sample of the layout
    grows with the partitions, and filled rows are written without being held."""
    spark = matched.sparkSession
    path = scratch_path(spark, "matched", "trips")
    matched.write.parquet(path)
    found = spark.read.schema(matched.schema).parquet(path)
    filled, trips = found.agg(F.sum(F.col("__start_n").cast("long") * F.col("__end_n")), F.count(F.lit(1))).first()
    partitions = max(1, min(-(-(filled or 0) // TASK_ROWS), -(-trips // TASK_TRIPS)))
    code = F.coalesce("start_station_id", F.get("__start_m", F.lit(0))["short_name"])
    ranged = layout(found.withColumn("__code", code), "started_date", TRIP_CLUSTER, partitions)
    return ranged.sortWithinPartitions("started_date", "__code", "member_casual").drop("__code")


def unfinished(spark: SparkSession, warehouse: str) -> bool:
    """Whether a layer lies staged: its checks have failed, or its run ended before them."""
    return any(list_names(spark, f"{warehouse}/{STAGED}/{layer}") for layer in (STAGING, SILVER, GOLD))


def _iso(day: str) -> str:
    return f"{day[:4]}-{day[4:6]}-{day[6:]}"


def _day_slice(df: DataFrame, days: list[str] | None) -> DataFrame:
    """Rows of the given yyyyMMdd days from a ``started_date``-partitioned
    table (partition pruning)."""
    if days is None:
        return df
    return df.filter(F.col("started_date").cast("string").isin([_iso(d) for d in days]))


def build_status_models(spark: SparkSession, warehouse: str, as_of: datetime | str | None,
                        on_error: str = "stop", report: RunReport | None = None,
                        strategy: str = "auto", tz: str | None = None) -> RunReport:
    """Bronze status -> stg (checked) -> status_current (table, checked) ->
    demand_vs_supply at ``as_of`` (table, checked). Stops where dim_station or hourly_traffic
    isn't published yet."""
    report = report or RunReport()
    stg = M.stg_status(read_table(spark, warehouse, BRONZE, "station_status"))
    if not _check(report, stg, "stg_status", {}, on_error) or _lacks(report, spark, warehouse, "dim_station"):
        return report
    dim = read_dim_station(spark, warehouse)
    cur = _publish(report, M.status_current(stg, dim, strategy), warehouse, GOLD, "status_current",
                   {"dim_station": dim}, on_error)
    if cur is None or _lacks(report, spark, warehouse, "hourly_traffic"):
        return report
    hourly = read_table(spark, warehouse, GOLD, "hourly_traffic")
    _publish(report, M.demand_vs_supply(cur, hourly, dim, as_of, strategy, tz), warehouse, GOLD, "demand_vs_supply",
             {}, on_error)
    return report


LAYER_TABLES = {
    BRONZE: ["trips_raw", "station_snapshots", "station_status"],
    STAGING: ["stg_trips"],
    SILVER: ["int_trips"],
    GOLD: ["dim_station", "trips_enriched", "hourly_traffic", "status_current",
           "demand_vs_supply"],
}


def register_views(spark: SparkSession, warehouse: str) -> list[str]:
    """Expose every built layer table (plus the staging models, which are
    views by nature) as session views, so analyses can be plain
    ``spark.sql``. Returns the view names created."""
    names = []
    for layer, tables in LAYER_TABLES.items():
        for name in tables:
            path = f"{warehouse}/{layer}/{name}"
            grown = name == "dim_station" and path_exists(spark, f"{station_store(warehouse).root}/open")
            if not grown and not path_exists(spark, path):
                continue
            df = (read_bronze_trips(spark, warehouse) if name == "trips_raw" else read_dim_station(spark, warehouse) if grown
                  else read_table(spark, warehouse, layer, name))
            df.createOrReplaceTempView(name)
            names.append(name)
    staging = {"stg_stations": ("station_snapshots", M.stg_stations),
               "stg_status": ("station_status", M.stg_status)}
    for view, (src, model) in staging.items():
        if src in names:
            model(spark.table(src)).createOrReplaceTempView(view)
            names.append(view)
    return names
