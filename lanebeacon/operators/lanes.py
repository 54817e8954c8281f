"""Views per lane and per edge of the road network.

Sightings are counted per lane first. That merges inside each map task, leaves one
row per lane whatever the traffic on it, and keeps the parsing of lane ids off the
raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanebeacon.functions import lanes

LANE = "vehicle_lane"


def parse_lanes(traces: DataFrame, *, lane: str = LANE, edge_id_mode: str = "fixed2") -> DataFrame:
    """Adds ``edge_id``, ``lane_index``, ``direction`` and ``junction_edge``."""
    column = F.col(lane)
    return traces.withColumns(
        {
            "edge_id": lanes.edge_id(column, edge_id_mode),
            "lane_index": lanes.lane_index(column),
            "direction": lanes.direction(column, edge_id_mode),
            "junction_edge": lanes.junction_edge(column),
        }
    )


def cars_per_lane(vehicle: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sightings per lane. The two views below take this table in place of raw sightings.

    ``keep`` names columns that follow from the lane, such as an ``edge_id`` the sightings are bucketed by.
    """
    return vehicle.groupBy(*keep, LANE).agg(F.count(LANE).alias("nb_cars"))


def _counted(vehicle: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return vehicle if "nb_cars" in vehicle.columns else cars_per_lane(vehicle, keep)


def edge_traffic(vehicle: DataFrame, *, edge_id_mode: str = "fixed2") -> DataFrame:
    """Vehicle sightings per edge, busiest first; rows without a lane show up as NULL with 0."""
    edge = lanes.edge_id(F.col(LANE), edge_id_mode).alias("edge_id")
    per_edge = _counted(vehicle).groupBy(edge).agg(F.sum("nb_cars").alias("sightings"))
    return per_edge.orderBy(F.desc("sightings"), "edge_id")


def lane_zipper(
    vehicle: DataFrame,
    min_lanes: int = 3,
    *,
    edge_id_mode: str = "fixed2",
    per_direction: bool = False,
) -> DataFrame:
    """Cars per lane on the edges with at least ``min_lanes`` lanes.

    Lanes of both directions count together unless ``per_direction``. The lane counts
    are joined with their own per-edge summary instead of being ranked in a window:
    no edge is gathered in one task, and as both sides start from the same columns
    the scan and the shuffle by lane run once. Sightings that have their ``edge_id`` (by the same ``edge_id_mode``) and
    are bucketed by it are not shuffled at all.
    """
    known = ("edge_id",) if "edge_id" in vehicle.columns else ()
    # Naming a value for NULL, though none is left, tells Spark that an edge is never
    # NULL; otherwise the join would check it on, and so parse, every raw row.
    located = _counted(vehicle.where(F.col(LANE).isNotNull()), known).withColumn(LANE, F.coalesce(LANE, F.lit("")))
    per_lane = parse_lanes(located.withColumnRenamed("edge_id", "_known"), edge_id_mode=edge_id_mode).drop("junction_edge")
    if known:
        per_lane = per_lane.drop("edge_id").withColumnRenamed("_known", "edge_id")
    edge = ["edge_id", "direction"] if per_direction else ["edge_id"]
    # Every lane has cars; counting those with cars keeps nb_cars, and with it the
    # shared shuffle, on this side as well.
    wide = per_lane.groupBy(*edge).agg(F.count_if(F.col("nb_cars") > 0).alias("nb_lanes"))
    return per_lane.join(wide.where(F.col("nb_lanes") >= min_lanes), edge).select(
        LANE, "nb_cars", "edge_id", "lane_index", "direction", "nb_lanes"
    )
