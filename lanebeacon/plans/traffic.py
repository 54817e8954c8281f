"""Traffic: the wide trace to master tables, master tables to views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanebeacon import operators as ops
from lanebeacon.plans.shared import written_once
from lanebeacon.sinks import write_master, write_view
from lanebeacon.sources import read_fcd_csv
from lanebeacon.sources.files import CORRUPT


# Fixed value: a column title of the written report.
TRAFFIC_TITLES = {"sightings": "count(edge_id)"}


def _load(spark: SparkSession, paths: str | list[str], rows_of: Callable, master: str, mode: str, **options) -> None:
    """Parses the lines once; those that do not parse are written to ``<master>.rejected``."""
    with written_once(read_fcd_csv(spark, paths), "parsed") as parsed:
        write_master(parsed.where(F.col(CORRUPT).isNotNull()), f"{master.rstrip('/')}.rejected", mode=mode)
        write_master(rows_of(parsed.where(F.col(CORRUPT).isNull())), master, mode=mode, **options)


def load_traces(spark: SparkSession, paths: str | list[str], master: str, mode: str = "errorifexists") -> None:
    """Vehicle and person rows into one table partitioned by kind, from a single scan."""
    _load(spark, paths, ops.split_traces, master, mode, partition_by=["kind"])


def load_vehicles(spark: SparkSession, paths: str | list[str], master: str, mode: str = "errorifexists") -> None:
    _load(spark, paths, ops.split_vehicles, master, mode)


def load_persons(spark: SparkSession, paths: str | list[str], master: str, mode: str = "errorifexists") -> None:
    _load(spark, paths, ops.split_persons, master, mode)


def write_traffic_views(
    vehicle: DataFrame, target: str, *, edge_id_mode: str = "fixed2"
) -> None:
    """Traffic per edge, busiest first, and cars per lane of the wide edges.

    The sightings are scanned once, into the counts per lane both views start from.
    """
    lanes_path = f"{target}/cars_per_lane"
    write_master(ops.cars_per_lane(vehicle), lanes_path, mode="overwrite")
    per_lane = vehicle.sparkSession.read.parquet(lanes_path)
    write_view(
        ops.edge_traffic(per_lane, edge_id_mode=edge_id_mode),
        f"{target}/edge_traffic",
        order_by=[F.desc("sightings"), "edge_id"],
        columns=TRAFFIC_TITLES,
    )
    write_view(
        ops.lane_zipper(per_lane, edge_id_mode=edge_id_mode),
        f"{target}/lane_zipper",
        order_by=["edge_id", "vehicle_lane"],
    )
