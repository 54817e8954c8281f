"""The operators' inputs, derived from the star-schema and event tables.

Every derivation is row by row over a whole table.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lanebeacon.functions.time import epoch_seconds, local_time
from lanebeacon.schemas import CLIENT, FCD_RAW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sightings on 25 routers, one of the measures held as text."""
    return table(spark, sf_dir, "events").select(
        F.expr("cast(event_id % 25 as string)").alias("did"),
        F.col("user_id").cast("string").alias("cid"),
        F.col("event_type").alias("clientOS"),
        (-F.col("value")).alias("rssi"),
        F.get_json_object("props", "$.k").alias("snRatio"),
        F.concat("event_type", F.lit("-net")).alias("ssid"),
        epoch_seconds(F.col("ts")).alias("ts"),
    )


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 nations as router locations."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("did"), F.col("n_name").alias("location")
    )


def readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a nested document: one client, then two, then none, then no list."""
    flat = readings(spark, sf_dir)
    known = F.struct("cid", "clientOS", "rssi", F.col("snRatio").cast("double").alias("snRatio"), "ssid")
    nameless = F.struct(
        "cid",
        F.lit(None).cast("string").alias("clientOS"),
        F.lit(None).cast("double").alias("rssi"),
        F.lit(0.5).alias("snRatio"),
        "ssid",
    )
    nobody = F.filter(F.array(known), lambda client: F.lit(False))

    def at(clients, later: int):
        return F.struct(clients.alias("clients"), (F.col("ts") + later).alias("ts"))

    no_list = F.lit(None).cast(ArrayType(CLIENT))
    return flat.select(
        "did",
        F.array(at(F.array(known), 0), at(F.array(known, nameless), 60), at(nobody, 120), at(no_list, 180)).alias("readings"),
    )


def user_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sightings on one router per user, seen by up to 500 clients."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("did"),
        F.concat_ws("-", "event_type", F.get_json_object("props", "$.k")).alias("cid"),
        epoch_seconds(F.col("ts")).alias("ts"),
    )


def customer_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as router locations, those in debt still without one."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("did"),
        F.expr("if(c_acctbal < 0, 'change_me', c_name)").alias("location"),
    )


def supplier_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as router locations; there are fewer of them than users."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("did"), F.col("s_name").alias("location")
    )


def customer_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("did"), F.col("c_name").alias("location")
    )


def lectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bookings of the customer's room, 30 minutes to 8 hours long."""
    return table(spark, sf_dir, "orders").select(*_lecture_columns())


def _lecture_columns() -> list[Column]:
    """Name, room, start and end of an order's lecture."""
    first = F.expr("(o_orderkey % 700) * 3600 + (o_custkey % 60) * 60")
    length = F.expr("1800 + (o_orderkey % 451) * 60")
    epoch = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())
    return [
        F.col("o_orderkey").cast("string").alias("name"),
        F.expr("concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))").alias("room"),
        local_time(epoch + first).alias("start_ts"),
        local_time(epoch + first + length).alias("end_ts"),
    ]


def bookings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw bookings, without the order key, so that some are copies."""
    start_time = "case o_orderstatus when 'F' then '08:15' when 'O' then '13:30' else '9:00' end"
    return table(spark, sf_dir, "orders").select(
        F.expr("concat('course ', o_custkey % 5)").alias("name"),
        F.expr("cast(cast(o_orderdate as date) as string)").alias("startDate"),
        F.expr("cast(cast(o_orderdate as date) as string)").alias("endDate"),
        F.expr(start_time).alias("startTime"),
        F.lit("17:45").alias("endTime"),
        F.expr("concat('Aud', length(o_orderpriority) % 4, ', room ', o_orderstatus)").alias("room"),
        F.col("o_orderstatus").alias("type"),
        F.expr("replace(o_orderpriority, '-', ',')").alias("lecturers"),
        F.expr("nullif(o_orderstatus, 'P')").alias("programme"),
    )


def vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as vehicle sightings; returned items pass through junctions."""
    lane = """concat(
        case when l_returnflag = 'R' then ':' when l_linestatus = 'F' then '-' else '' end,
        l_suppkey,
        if(l_returnflag = 'R', concat('_', l_linenumber), ''),
        '_', l_linenumber % 4)"""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("cast(datediff(l_shipdate, date'1970-01-01') as float)").alias("timestep_time"),
        F.col("l_orderkey").cast("string").alias("vehicle_id"),
        F.expr(lane).alias("vehicle_lane"),
    )


def order_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sightings on one road per order, so that roads differ in width."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("concat(if(l_linestatus = 'F', '-', ''), l_orderkey, '_', l_linenumber)").alias("vehicle_lane")
    )


def wide_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same roads with lane indexes of one and of two digits."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("concat(if(l_linestatus = 'F', '-', ''), l_orderkey, '_', l_linenumber + 6)").alias("vehicle_lane")
    )


def auditorium_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as routers, a quarter of them near an auditorium."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("did"),
        F.expr("if(c_custkey % 20 < 5, concat('Hall AUD', c_custkey % 20, ' east'), c_name)").alias("location"),
    )


def auditorium_lectures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lectures, a quarter of them in an auditorium as people write it."""
    # Only the keys are joined; names and times are made from them afterwards.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rooms = orders.select("o_orderkey", F.expr("if(o_custkey % 20 < 5, concat('Aud ', o_custkey % 20, ', door A'), 'Lab 7')").alias("room"))
    name, _, start_ts, end_ts = _lecture_columns()
    return orders.join(rooms, "o_orderkey").select(name, start_ts, end_ts, "room")


def fcd_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the vehicle half and orders in the person half of wide rows."""
    cars = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(datediff(l_shipdate, date'1970-01-01') as float) as timestep_time",
        "cast(l_orderkey as string) as vehicle_id",
        "cast(l_extendedprice as string) as vehicle_x",
        "cast(l_quantity as string) as vehicle_y",
        "'0.0' as vehicle_z",
        "cast(l_discount as string) as vehicle_angle",
        "l_returnflag as vehicle_type",
        "cast(l_tax as string) as vehicle_speed",
        "if(l_linestatus = 'F', 'n/a', cast(l_partkey as string)) as vehicle_pos",
        "concat(l_suppkey, '_', l_linenumber) as vehicle_lane",
        "'0.0' as vehicle_slope",
    )
    people = table(spark, sf_dir, "orders").selectExpr(
        "cast(datediff(o_orderdate, date'1970-01-01') as float) as timestep_time",
        "cast(o_custkey as string) as person_id",
        "cast(o_totalprice as string) as person_x",
        "cast(o_orderkey as string) as person_y",
        "'0.0' as person_z",
        "'90' as person_angle",
        "left(o_orderpriority, 1) as person_speed",
        "if(o_orderstatus = 'F', 'n/a', cast(o_totalprice / 2 as string)) as person_pos",
        "o_orderpriority as person_edge",
        "'0.0' as person_slope",
    )
    return cars.unionByName(people, allowMissingColumns=True).select(*FCD_RAW.names)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as positions: price and quantity for the two axes."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("lat"), (F.col("l_quantity") / 5).alias("lng")
    )
