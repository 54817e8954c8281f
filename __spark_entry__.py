"""The driver's contract: a flagship query, all queries, and their SQL twins.

Every query reads whole tables. The SQL is written independently of the Spark code:
plain joins and groupings, no buckets and no pre-aggregation.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

import bindings as t
import round_trips
from lanebeacon import operators as ops

# The subpackage of training-data operators and its pipeline may be missing; nothing else may.
try:
    import corpus_pipeline
    from lanebeacon.llm import registry as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "lanebeacon.llm"):
        raise
    llm = corpus_pipeline = None

FLAGSHIP_DIR = "/root/testdata/sf0.001"

NATION_ROOMS = round_trips.NATION_ROOMS

Query = Callable[[SparkSession, str], DataFrame]


def _as_text(rows: DataFrame, *columns: str) -> DataFrame:
    """Times and dates as text, which compares the same everywhere."""
    return rows.withColumns({column: rows[column].cast("string") for column in columns})


def entry(spark: SparkSession) -> DataFrame:
    """Weekly usage per router at the smallest scale."""
    return queries()["weekly_router_usage"](spark, FLAGSHIP_DIR)


def queries() -> dict[str, Query]:
    return _own_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (llm.oracle_sql() if llm else {})


def _own_queries() -> dict[str, Query]:
    return {
        "flatten_readings": lambda s, d: ops.flatten_readings(t.readings_raw(s, d)),
        "device_sightings": lambda s, d: ops.device_sightings(t.readings_raw(s, d), "7"),
        "clean_locations": lambda s, d: ops.clean_locations(t.customer_meta(s, d)),
        "explode_bookings": lambda s, d: _as_text(
            ops.explode_bookings(t.bookings_raw(s, d)), "start_ts", "end_ts"
        ),
        "explode_bookings_trimmed": lambda s, d: _as_text(
            ops.explode_bookings(t.bookings_raw(s, d), trim=True), "start_ts", "end_ts"
        ),
        "weekly_router_usage": lambda s, d: ops.weekly_router_usage(t.readings(s, d), t.meta(s, d)),
        "weekly_router_usage_monday": lambda s, d: ops.weekly_router_usage(
            t.readings(s, d), t.meta(s, d), week_start="monday", tz="Europe/Copenhagen"
        ),
        "weekly_router_usage_unlisted": lambda s, d: ops.weekly_router_usage(
            t.user_readings(s, d), t.supplier_meta(s, d), how="left"
        ),
        "room_occupancy_hourly": lambda s, d: ops.room_occupancy_hourly(t.readings(s, d), t.meta(s, d), NATION_ROOMS),
        "signal_quality_profile": lambda s, d: ops.signal_quality_profile(t.readings(s, d), t.meta(s, d)),
        "lecture_attendance": lambda s, d: ops.lecture_attendance(
            t.user_readings(s, d), t.customer_rooms(s, d), t.lectures(s, d), rules=None
        ),
        "lecture_connections": lambda s, d: ops.lecture_connections(
            t.user_readings(s, d), t.customer_rooms(s, d), t.lectures(s, d), rules=None
        ),
        "lecture_attendance_rooms": lambda s, d: ops.lecture_attendance(
            t.user_readings(s, d), t.auditorium_meta(s, d), t.auditorium_lectures(s, d)
        ),
        "lecture_connections_rooms": lambda s, d: ops.lecture_connections(
            t.user_readings(s, d), t.auditorium_meta(s, d), t.auditorium_lectures(s, d)
        ),
        "split_vehicles": lambda s, d: ops.split_vehicles(t.fcd_raw(s, d)),
        "split_persons": lambda s, d: ops.split_persons(t.fcd_raw(s, d)),
        "split_traces": lambda s, d: ops.split_traces(t.fcd_raw(s, d)).selectExpr(
            "kind",
            "coalesce(vehicle.timestep_time, person.timestep_time) as timestep_time",
            "coalesce(vehicle.vehicle_id, person.person_id) as id",
            "coalesce(vehicle.vehicle_x, person.person_x) as x",
            "coalesce(vehicle.vehicle_lane, person.person_edge) as place",
        ),
        "parse_lanes": lambda s, d: ops.parse_lanes(t.vehicle(s, d)),
        "parse_lanes_last_underscore": lambda s, d: ops.parse_lanes(t.vehicle(s, d), edge_id_mode="last_underscore"),
        "edge_traffic": lambda s, d: ops.edge_traffic(t.vehicle(s, d)),
        "edge_traffic_last_underscore": lambda s, d: ops.edge_traffic(t.wide_lanes(s, d), edge_id_mode="last_underscore"),
        "lane_zipper_last_underscore": lambda s, d: ops.lane_zipper(t.wide_lanes(s, d), edge_id_mode="last_underscore"),
        "lane_zipper": lambda s, d: ops.lane_zipper(t.order_lanes(s, d)),
        "lane_zipper_per_direction": lambda s, d: ops.lane_zipper(t.order_lanes(s, d), per_direction=True),
        "vehicles_per_timestep": lambda s, d: ops.vehicles_per_timestep(t.vehicle(s, d)),
        "vehicles_per_lane": lambda s, d: ops.vehicles_per_lane(t.vehicle(s, d), n=100),
        "vehicles_per_lane_all": lambda s, d: ops.vehicles_per_lane(t.vehicle(s, d)),
        "timestep_count": lambda s, d: ops.timestep_count(t.vehicle(s, d)),
        "heatmap_density": lambda s, d: ops.heatmap_density(t.points(s, d), cell=1.0),
        "heatmap_positions": lambda s, d: ops.heatmap_density(t.points(s, d)),
        "readings_master": lambda s, d: _as_text(round_trips.readings_master(s, d), "ingest_date"),
        "partitioned_readings_master": lambda s, d: _as_text(round_trips.partitioned_readings_master(s, d), "ingest_date"),
        "mixed_readings_master": lambda s, d: _as_text(round_trips.mixed_readings_master(s, d), "ingest_date"),
        "streamed_readings": round_trips.streamed_readings,
        "bookings_master": lambda s, d: _as_text(round_trips.bookings_master(s, d), "start_ts", "end_ts", "ingest_date"),
        "streamed_bookings": lambda s, d: _as_text(round_trips.streamed_bookings(s, d), "start_ts", "end_ts", "ingest_date"),
        "meta_master": round_trips.meta_master,
        "traces_master": round_trips.traces_master,
        "text_masters": round_trips.text_masters,
        "edge_report": round_trips.edge_report,
        "wifi_views": round_trips.wifi_views,
        "signal_report": round_trips.signal_report,
        "occupancy_report": round_trips.occupancy_report,
        "connections_report": round_trips.connections_report,
        "incremental_views": round_trips.incremental_views,
        "streamed_occupancy": round_trips.streamed_occupancy,
        "sketched_usage": round_trips.sketched_usage,
        "sketched_occupancy": round_trips.sketched_occupancy,
        "bucketed_usage": round_trips.bucketed_usage,
        "bucketed_signal": round_trips.bucketed_signal,
        "bucketed_zipper": round_trips.bucketed_zipper,
        "traffic_views": round_trips.traffic_views,
    }


_READINGS = """
readings as (
  select cast(event_id % 25 as varchar) as did, cast(user_id as varchar) as cid, event_type as clientOS,
         -value as rssi, json_extract_string(props, '$.k') as snRatio, event_type || '-net' as ssid,
         cast(floor(epoch(ts)) as bigint) as ts
  from events),
meta as (select cast(n_nationkey as varchar) as did, n_name as location from nation)"""

_NESTED = f"""
with {_READINGS},
flat as (
  select did, cid, clientOS, rssi, cast(snRatio as double) as snRatio, ssid, ts, ts as first_ts from readings
  union all
  select did, cid, clientOS, rssi, cast(snRatio as double), ssid, ts + 60, ts from readings
  union all
  select did, cid, cast(null as varchar), cast(null as double), 0.5::double, ssid, ts + 60, ts from readings)"""

_BOOKINGS = """
with raw as (
  select distinct
         'course ' || (o_custkey % 5) as name,
         strftime(o_orderdate, '%Y-%m-%d') as "startDate",
         strftime(o_orderdate, '%Y-%m-%d') as "endDate",
         case o_orderstatus when 'F' then '08:15' when 'O' then '13:30' else '9:00' end as "startTime",
         '17:45' as "endTime",
         'Aud' || (length(o_orderpriority) % 4) || ', room ' || o_orderstatus as room,
         o_orderstatus as "type",
         replace(o_orderpriority, '-', ',') as lecturers,
         nullif(o_orderstatus, 'P') as programme
  from orders),
per_room as (select * replace (unnest(string_split(room, ',')) as room) from raw),
per_lecturer as (select * replace (unnest(string_split(lecturers, ',')) as lecturers) from per_room)
select name, "startDate", "endDate", "startTime", "endTime", {room} as room, "type", {lecturers} as lecturers, programme,
       strftime(strptime("startDate" || ' ' || "startTime", '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M:%S') as start_ts,
       strftime(strptime("endDate" || ' ' || "endTime", '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M:%S') as end_ts
from per_lecturer"""

_SIGHTINGS = """
sightings as (
  select cast(user_id as varchar) as did, event_type || '-' || json_extract_string(props, '$.k') as cid,
         cast(floor(epoch(ts)) as bigint) as ts
  from events)"""

_ATTENDANCE = f"""
with {_SIGHTINGS},
lectures as (
  select cast(o_orderkey as varchar) as name,
         'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') as room,
         cast(epoch(timestamp '2024-01-01') as bigint) + (o_orderkey % 700) * 3600 + (o_custkey % 60) * 60 as start_s,
         30 + o_orderkey % 451 as minutes
  from orders),
attendance as (
  select distinct l.name as name, s.cid as cid
  from sightings s
  join customer c on s.did = cast(c.c_custkey as varchar)
  join lectures l on l.room = c.c_name and s.ts >= l.start_s and s.ts <= l.start_s + l.minutes * 60)"""

_ROOM_ATTENDANCE = f"""
with {_SIGHTINGS},
rooms as (
  select cast(c_custkey as varchar) as did, c_custkey % 20 as number from customer where c_custkey % 20 between 1 and 4),
lectures as (
  select cast(o_orderkey as varchar) as name, o_custkey % 20 as number,
         cast(epoch(timestamp '2024-01-01') as bigint) + (o_orderkey % 700) * 3600 + (o_custkey % 60) * 60 as start_s,
         30 + o_orderkey % 451 as minutes
  from orders where o_custkey % 20 between 1 and 4),
attendance as (
  select distinct l.name as name, s.cid as cid
  from sightings s
  join rooms r on s.did = r.did
  join lectures l on l.number = r.number and s.ts >= l.start_s and s.ts <= l.start_s + l.minutes * 60)"""

_CONNECTIONS = """,
            per_client as (select cid, count(distinct ts) as connections from sightings group by cid)
            select name, cast(sum(connections) as bigint) as connections
            from attendance join per_client using (cid) group by name"""

_FCD_DAY = "cast(date_diff('day', date '1970-01-01', cast({0} as date)) as float)"

_VEHICLE = f"""
vehicle as (
  select {_FCD_DAY.format("l_shipdate")} as timestep_time,
         cast(l_orderkey as varchar) as vehicle_id,
         case when l_returnflag = 'R' then ':' || l_suppkey || '_' || l_linenumber || '_' || (l_linenumber % 4)
              when l_linestatus = 'F' then '-' || l_suppkey || '_' || (l_linenumber % 4)
              else l_suppkey || '_' || (l_linenumber % 4) end as vehicle_lane
  from lineitem)"""

_SIGNED = {
    "fixed2": "substr(vehicle_lane, 1, length(vehicle_lane) - 2)",
    "last_underscore": "regexp_replace(vehicle_lane, '_[^_]*$', '')",
}
_UNSIGNED = {"fixed2": "split_part(signed_edge, '-', 2)", "last_underscore": "substr(signed_edge, 2)"}


def _parsed(mode: str) -> str:
    return f"""
select timestep_time, vehicle_id, vehicle_lane,
       case when starts_with(signed_edge, '-') then {_UNSIGNED[mode]} else signed_edge end as edge_id,
       split_part(vehicle_lane, '_', -1) as lane_index,
       case when starts_with(signed_edge, '-') then 0 else 1 end as direction,
       array_to_string(list_slice(string_split(vehicle_lane, '_'), 1, 2), '_') as junction_edge
from (select *, {_SIGNED[mode]} as signed_edge from vehicle)"""


def _zipper(key: str, shift: int = 0) -> str:
    return f"""
with lanes as (
  select case when l_linestatus = 'F' then '-' else '' end || l_orderkey || '_' || (l_linenumber + {shift}) as vehicle_lane,
         count(*) as nb_cars, cast(l_orderkey as varchar) as edge_id, cast(l_linenumber + {shift} as varchar) as lane_index,
         case when l_linestatus = 'F' then 0 else 1 end as direction
  from lineitem group by all),
wide as (select {key}, count(*) as nb_lanes from lanes group by {key} having count(*) > 2)
select vehicle_lane, nb_cars, edge_id, lane_index, direction, nb_lanes from lanes join wide using ({key})"""


_EPOCH_WEEK = "time_bucket(interval 7 day, make_timestamp(ts * 1000000), timestamp '1970-01-01')"


def _usage(week: str, tables: str = _READINGS, rows: str = "readings", join: str = "join") -> str:
    return f"""
with {tables},
usage as (
  select did, {week} as week, count(distinct cid) as unique_clients, count(cid) as accesses
  from {rows} group by all)
select did, location, strftime(week, '%Y.%m.%d, %a') as from_day,
       strftime(week + interval 7 day, '%Y.%m.%d , %a') as to_day, unique_clients, accesses
from usage {join} meta using (did)"""


def _occupancy(tables: str, rows: str) -> str:
    return f"""
            with {tables},
            rooms as (
              select did, case when lower(location) like '%nation\\_1%' escape '\\' then 'Aud1' else 'Aud2' end as location
              from meta
              where lower(location) like '%nation\\_1%' escape '\\' or lower(location) like '%nation\\_2%' escape '\\'),
            hourly as (
              select location, time_bucket(interval 1 hour, make_timestamp(ts * 1000000)) as h, count(distinct cid) as devices
              from {rows} join rooms using (did) group by all)
            select location, strftime(h, '%Y.%m.%d , %a') as day, strftime(h, '%-I:%M %p') as from_time,
                   strftime(h + interval 1 hour, '%-I:%M %p') as to_time, devices
            from hourly"""


def _own_sql() -> dict[str, str]:
    day = _FCD_DAY.format
    nested = _NESTED.replace("with ", "", 1)
    occupancy = _occupancy(_READINGS, "readings")
    flat = f"{_NESTED} select did, cid, clientOS, rssi, snRatio, ssid, ts from flat"
    bookings = _BOOKINGS.format(room="room", lecturers="lecturers")
    vehicles = f"""
        select {day("l_shipdate")} as timestep_time, cast(l_orderkey as varchar) as vehicle_id,
               l_extendedprice as vehicle_x, l_quantity as vehicle_y, l_discount as vehicle_angle,
               l_returnflag as vehicle_type, l_tax as vehicle_speed,
               case when l_linestatus = 'F' then null else cast(l_partkey as double) end as vehicle_pos,
               l_suppkey || '_' || l_linenumber as vehicle_lane
        from lineitem"""
    persons = f"""
        select {day("o_orderdate")} as timestep_time, cast(o_custkey as varchar) as person_id,
               o_totalprice as person_x, cast(o_orderkey as double) as person_y,
               cast(90 as double) as person_angle, cast(substr(o_orderpriority, 1, 1) as double) as person_speed,
               case when o_orderstatus = 'F' then null else o_totalprice / 2 end as person_pos, o_orderpriority as person_edge
        from orders"""
    signal = f"""
        with {_READINGS},
        hourly as (
          select did, time_bucket(interval 1 hour, make_timestamp(ts * 1000000)) as h,
                 avg(rssi) as rssi, avg(try_cast(snRatio as double)) as sn, count(cid) as n
          from readings group by all),
        profile as (
          select did, strftime(h, '%a') as weekday, strftime(h, '%H') as start_hour,
                 strftime(h + interval 1 hour, '%H') as end_hour,
                 cast(trunc(round(avg(rssi), 9)) as bigint) as "avg_rssi",
                 cast(trunc(round(avg(sn), 9)) as bigint) as "avg_snRatio",
                 cast(trunc(round(avg(n), 9)) as bigint) as avg_accesses
          from hourly group by all)
        select did, weekday, start_hour, end_hour, avg_rssi, "avg_snRatio", avg_accesses, location
        from profile join meta using (did)"""
    dated_flat = f"""
        {_NESTED}
        select did, cid, clientOS, rssi, snRatio, ssid, ts,
               '2017-10-0' || ((first_ts // 86400) % 8 + 1) as ingest_date
        from flat"""
    dated_bookings = f"""select *, '2017-10-0' || (cast(substr("startDate", 9, 2) as integer) % 8 + 1) as ingest_date from ({bookings})"""
    edges = f"""
        with {_VEHICLE}
        select edge_id, count(edge_id) as sightings from ({_parsed("fixed2")}) group by edge_id"""
    return {
        "flatten_readings": flat,
        "device_sightings": f"{flat} where did = '7'",
        "clean_locations": """
            select cast(c_custkey as varchar) as did, case when c_acctbal < 0 then 'unknown' else c_name end as location
            from customer""",
        "explode_bookings": bookings,
        "explode_bookings_trimmed": _BOOKINGS.format(room="trim(room)", lecturers="trim(lecturers)"),
        "weekly_router_usage": _usage(_EPOCH_WEEK),
        "weekly_router_usage_unlisted": _usage(
            _EPOCH_WEEK,
            f"{_SIGHTINGS}, meta as (select cast(s_suppkey as varchar) as did, s_name as location from supplier)",
            "sightings",
            "left join",
        ),
        "weekly_router_usage_monday": _usage(
            "time_bucket(interval 7 day, make_timestamp(ts * 1000000), timestamp '1970-01-05') + interval 1 hour"
        ),
        "room_occupancy_hourly": occupancy,
        "occupancy_report": occupancy,
        "connections_report": _ROOM_ATTENDANCE + _CONNECTIONS,
        "incremental_views": _occupancy(nested, "(select * from flat where (first_ts // 86400) % 8 <> 3)"),
        "streamed_occupancy": _occupancy(nested, "flat"),
        "sketched_usage": f"select did, from_day, unique_clients, accesses, true as close, accesses as counted from ({_usage(_EPOCH_WEEK)})",
        "sketched_occupancy": f"select location, day, from_time, devices, true as close from ({occupancy})",
        "signal_quality_profile": signal,
        "signal_report": signal,
        "lecture_attendance": f"{_ATTENDANCE} select name, cid from attendance",
        "lecture_connections": _ATTENDANCE + _CONNECTIONS,
        "lecture_attendance_rooms": f"{_ROOM_ATTENDANCE} select name, cid from attendance",
        "lecture_connections_rooms": _ROOM_ATTENDANCE + _CONNECTIONS,
        "split_vehicles": vehicles,
        "split_persons": persons,
        "split_traces": f"""
            select 'vehicle' as kind, {day("l_shipdate")} as timestep_time, cast(l_orderkey as varchar) as id,
                   l_extendedprice as x, l_suppkey || '_' || l_linenumber as place
            from lineitem
            union all
            select 'person', {day("o_orderdate")}, cast(o_custkey as varchar), o_totalprice, o_orderpriority
            from orders""",
        "parse_lanes": f"with {_VEHICLE} {_parsed('fixed2')}",
        "parse_lanes_last_underscore": f"with {_VEHICLE} {_parsed('last_underscore')}",
        "edge_traffic": edges,
        "lane_zipper": _zipper("edge_id"),
        "lane_zipper_per_direction": _zipper("edge_id, direction"),
        "vehicles_per_timestep": f"""
            with {_VEHICLE}
            select timestep_time, count(distinct vehicle_id) as vehicles from vehicle group by timestep_time""",
        "vehicles_per_lane": f"""
            with {_VEHICLE}
            select vehicle_lane, count(distinct vehicle_id) as vehicles from vehicle group by vehicle_lane
            order by vehicles desc, vehicle_lane limit 100""",
        "timestep_count": f"with {_VEHICLE} select count(distinct timestep_time) as timesteps from vehicle",
        "heatmap_density": """
            select cast(floor(l_extendedprice / 1000) as bigint) as lat_cell,
                   cast(floor(l_quantity / 5) as bigint) as lng_cell, count(*) as weight
            from lineitem group by all""",
        "heatmap_positions": """
            select l_extendedprice / 1000 as lat, l_quantity / 5 as lng, count(*) as weight
            from lineitem group by all""",
        "vehicles_per_lane_all": f"""
            with {_VEHICLE}
            select vehicle_lane, count(distinct vehicle_id) as vehicles from vehicle group by vehicle_lane""",
        "edge_traffic_last_underscore": "select cast(l_orderkey as varchar) as edge_id, count(*) as sightings from lineitem group by l_orderkey",
        "lane_zipper_last_underscore": _zipper("edge_id", 6),
        "readings_master": dated_flat,
        "partitioned_readings_master": f"select * from ({dated_flat}) where ingest_date <> '2017-10-04'",
        "mixed_readings_master": dated_flat,
        "streamed_readings": flat,
        "bookings_master": dated_bookings,
        "streamed_bookings": dated_bookings,
        "meta_master": """
            select cast(c_custkey as varchar) as did, case when c_acctbal < 0 then 'unknown' else c_name end as location
            from customer""",
        "traces_master": f"select * from ({vehicles}) union all by name select * from ({persons})",
        "text_masters": f"""
            select 'vehicle' as master, count(*) as n, round(sum(vehicle_x), 2) as total from ({vehicles})
            union all select 'person', count(*), round(sum(person_x), 2) from ({persons})
            union all select 'readings', count(*), round(sum(rssi), 2) from ({flat})
            union all select 'bookings', count(*), cast(sum(cast(substr(start_ts, 12, 2) as integer)) as double) from ({bookings})""",
        "edge_report": edges,
        "wifi_views": _usage(_EPOCH_WEEK),
        "bucketed_usage": _usage(_EPOCH_WEEK),
        "bucketed_signal": signal,
        "bucketed_zipper": _zipper("edge_id"),
        "traffic_views": _zipper("edge_id"),
    }
