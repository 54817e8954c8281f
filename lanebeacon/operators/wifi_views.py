"""Views over flat readings: usage per router, occupancy per room, signal quality.

``readings`` needs ``did, cid, ts`` (epoch seconds) and, for the quality view,
``rssi, snRatio``; ``meta`` needs ``did, location``. Routers missing from ``meta``
drop out of the views, a router listed twice counts for each listing. No join
carries a hint: ``meta`` is broadcast when Spark finds it small enough, beyond that
the join shuffles and adaptive execution splits a hot router.

Every view also takes ``client_hours`` of the readings in their place, so that a run
over several views needs to read the sightings only once. Usage and occupancy also take ``client_sketches``,
whose clients are sketches instead of rows: any weeks, routers and rooms are their union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanebeacon.functions.aggregates import distinct_count, exact_mean, number, whole_part
from lanebeacon.functions.rooms import AUDITORIUMS, Rules, room_name
from lanebeacon.functions.time import (
    FROM_SEPARATOR,
    HOUR,
    TO_SEPARATOR,
    WEEK,
    bucket_start,
    clock_label,
    day_label,
    hour_label,
    local_time,
    week_offset,
    weekday_label,
)


MEASURES = ("rssi", "snRatio")
# A sketch of 2 ** 14 cells is right to about 0.8%.
SKETCH_PRECISION = 14


def client_hours(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per router, hour and client: its accesses, and sum and number of each measure.

    ``ts`` becomes the start of the hour. ``keep`` names further columns to keep apart by; the views add
    their parts up again.
    """
    sums = {f"{measure}_sum": F.sum(number(measure)) for measure in MEASURES}
    sizes = {f"{measure}_n": F.count(number(measure)) for measure in MEASURES}
    aggregates = {"accesses": F.count("cid"), **sums, **sizes}
    return (
        readings.where(F.col("ts").isNotNull())
        .groupBy(*keep, "did", "cid", bucket_start(F.col("ts"), HOUR).alias("ts"))
        .agg(*[aggregate.alias(name) for name, aggregate in aggregates.items()])
    )


def client_sketches(readings: DataFrame, keep: tuple[str, ...] = (), precision: int = SKETCH_PRECISION) -> DataFrame:
    """One row per router and hour: a sketch of its distinct clients, and its accesses.

    ``ts`` becomes the start of the hour, ``keep`` is as in ``client_hours``, whose rows are taken as well. A sketch has
    a bounded size whatever it has seen; its count is within about 1.04 / sqrt(2 ** precision).
    """
    return (
        readings.where(F.col("ts").isNotNull())
        .groupBy(*keep, "did", bucket_start(F.col("ts"), HOUR).alias("ts"))
        .agg(F.hll_sketch_agg("cid", precision).alias("client_sketch"), _accesses(readings).alias("accesses"))
    )


def _clients(readings: DataFrame, approx: bool) -> Column:
    """Distinct clients: of sketches the estimate of their union, else the count."""
    if "client_sketch" in readings.columns:
        return F.hll_sketch_estimate(F.hll_union_agg("client_sketch"))
    return distinct_count("cid", approx)


def _accesses(readings: DataFrame) -> Column:
    return F.sum("accesses") if "accesses" in readings.columns else F.count("cid")


def _mean(readings: DataFrame, measure: str) -> Column:
    """Mean of a measure held as double or as text; text that is no number is skipped."""
    if "accesses" in readings.columns:
        return exact_mean(F.sum(f"{measure}_sum"), F.sum(f"{measure}_n"))
    return exact_mean(F.sum(number(measure)), F.count(number(measure)))


def weekly_router_usage(
    readings: DataFrame,
    meta: DataFrame,
    *,
    tz: str = "UTC",
    week_start: str = "thursday",
    approx: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Distinct clients and accesses per router and week.

    Weeks are counted from the epoch and so start on Thursday unless ``week_start``
    says otherwise. Aggregation comes before the join, which then sees one row per
    router and week. ``how="left"`` keeps routers without metadata.
    """
    week = bucket_start(F.col("ts"), WEEK, week_offset(week_start)).alias("week")
    usage = (
        readings.where(F.col("ts").isNotNull())
        .groupBy("did", week)
        .agg(_clients(readings, approx).alias("unique_clients"), _accesses(readings).alias("accesses"))
    )
    return usage.join(meta.select("did", "location"), "did", how).select(
        "did",
        "location",
        day_label(local_time(F.col("week"), tz), FROM_SEPARATOR).alias("from_day"),
        day_label(local_time(F.col("week") + WEEK, tz), TO_SEPARATOR).alias("to_day"),
        "unique_clients",
        "accesses",
    )


def room_occupancy_hourly(
    readings: DataFrame,
    meta: DataFrame,
    rules: Rules = AUDITORIUMS,
    *,
    tz: str = "UTC",
    approx: bool = False,
) -> DataFrame:
    """Distinct devices per room and hour, a room being all routers that name it."""
    rooms = meta.select("did", room_name(F.col("location"), rules).alias("location")).where("location is not null")
    hour = bucket_start(F.col("ts"), HOUR).alias("hour")
    occupancy = (
        readings.where(F.col("ts").isNotNull())
        .join(rooms, "did")
        .groupBy("location", hour)
        .agg(_clients(readings, approx).alias("devices"))
    )
    return occupancy_labels(occupancy, tz)


def occupancy_labels(occupancy: DataFrame, tz: str = "UTC") -> DataFrame:
    """The report's columns from ``location, hour, devices``, ``hour`` being its start in epoch seconds."""
    start, end = local_time(F.col("hour"), tz), local_time(F.col("hour") + HOUR, tz)
    return occupancy.select(
        "location",
        day_label(start, TO_SEPARATOR).alias("day"),
        clock_label(start).alias("from_time"),
        clock_label(end).alias("to_time"),
        "devices",
    )


def signal_quality_profile(readings: DataFrame, meta: DataFrame, *, tz: str = "UTC", how: str = "inner") -> DataFrame:
    """Mean of the hourly means per router, weekday and hour of day, cut to whole numbers.

    Every hour weighs the same, however many readings it holds. All means come as bigint,
    which holds every value.
    """
    hourly = (
        readings.where(F.col("ts").isNotNull())
        .groupBy("did", bucket_start(F.col("ts"), HOUR).alias("hour"))
        .agg(
            _mean(readings, "rssi").alias("rssi"),
            _mean(readings, "snRatio").alias("snRatio"),
            _accesses(readings).alias("accesses"),
        )
    )
    start, end = local_time(F.col("hour"), tz), local_time(F.col("hour") + HOUR, tz)
    profile = hourly.groupBy(
        "did",
        weekday_label(start).alias("weekday"),
        hour_label(start).alias("start_hour"),
        hour_label(end).alias("end_hour"),
    ).agg(
        whole_part(F.avg("rssi")).alias("avg_rssi"),
        whole_part(F.avg("snRatio")).alias("avg_snRatio"),
        whole_part(F.avg(F.col("accesses").cast("decimal(20, 0)"))).alias("avg_accesses"),
    )
    return profile.join(meta.select("did", "location"), "did", how)
