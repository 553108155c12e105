"""Lazily-built model DataFrames over one input directory.

Nothing here runs a job: each attribute is a logical plan, so a query that
uses only part of the chain only pays for that part (Catalyst prunes the
rest), and the models a query shares are planned once per query.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ridelake.plans import models as M
from ridelake.sources import adapters as A

DEFAULT_AS_OF = datetime(2024, 1, 30, 12, 0, 0)  # a Tuesday, hour 12


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str, strategy: str = "auto",
                 as_of: datetime | str = DEFAULT_AS_OF):
        self.spark, self.sf_dir, self.strategy, self.as_of = spark, sf_dir, strategy, as_of

    # raw feeds
    @cached_property
    def trips_raw(self) -> DataFrame:
        return A.trips_raw(self.spark, self.sf_dir)

    @cached_property
    def snapshots(self) -> DataFrame:
        return A.station_snapshots(self.spark, self.sf_dir)

    @cached_property
    def status_raw(self) -> DataFrame:
        return A.station_status(self.spark, self.sf_dir)

    # staging
    @cached_property
    def stg_trips(self) -> DataFrame:
        return M.stg_trips(self.trips_raw)

    @cached_property
    def stg_stations(self) -> DataFrame:
        return M.stg_stations(self.snapshots)

    @cached_property
    def stg_status(self) -> DataFrame:
        return M.stg_status(self.status_raw)

    # intermediate / warehouse
    @cached_property
    def int_trips(self) -> DataFrame:
        return M.int_trips(self.stg_trips)

    @cached_property
    def dim_station(self) -> DataFrame:
        return M.dim_station(self.stg_stations)

    @cached_property
    def trips_matched(self) -> DataFrame:
        return M.trips_matched(self.int_trips, self.dim_station, self.strategy)

    @cached_property
    def trips_enriched(self) -> DataFrame:
        return M.enriched_from(self.trips_matched)

    @cached_property
    def hourly_traffic(self) -> DataFrame:
        return M.hourly_traffic(self.trips_enriched)

    @cached_property
    def status_current(self) -> DataFrame:
        return M.status_current(self.stg_status, self.dim_station, self.strategy)

    @cached_property
    def demand_vs_supply(self) -> DataFrame:
        return M.demand_vs_supply(self.status_current, self.hourly_traffic, self.dim_station,
                                  self.as_of, self.strategy)

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
