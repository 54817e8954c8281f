"""Operators against plain Python on random input, one Spark job per property."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import found
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lanebeacon import operators as ops
from lanebeacon import schemas
from lanebeacon.functions.time import bucket_start, local_time
from lanebeacon.schemas import LONG, STRING, columns

LANES = columns(vehicle_lane=STRING)


def edge_by_hand(lane: str, mode: str) -> tuple[str, int]:
    if mode == "fixed2":
        signed = lane[:-2] if len(lane) > 2 else ""
        return (signed.split("-")[1] if signed.startswith("-") else signed, 0 if signed.startswith("-") else 1)
    signed = lane.rsplit("_", 1)[0]
    return (signed[1:] if signed.startswith("-") else signed, 0 if signed.startswith("-") else 1)


@pytest.mark.parametrize("mode", ["fixed2", "last_underscore"])
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lanes=st.lists(st.text(alphabet="-_:ab1", max_size=8), min_size=30, max_size=200))
def test_lane_ids(table, mode, lanes):
    parsed = ops.parse_lanes(table(LANES, *[(lane,) for lane in lanes]), edge_id_mode=mode)
    expected = [
        (lane, *edge_by_hand(lane, mode), lane.rsplit("_", 1)[-1], "_".join(lane.split("_")[:2])) for lane in lanes
    ]
    assert found(parsed, "vehicle_lane", "edge_id", "direction", "lane_index", "junction_edge") == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("mode", ["fixed2", "last_underscore"])
def test_edge_views(table, mode, seed):
    chance = random.Random(seed)
    lanes = [
        f"{chance.choice(['', '-', ':'])}{chance.randrange(30)}{chance.choice(['', '-b', '_1'])}_{chance.randrange(12)}"
        for _ in range(800)
    ]
    sightings = table(LANES, *[(lane,) for lane in [*lanes, None]])
    per_edge = Counter(edge_by_hand(lane, mode)[0] for lane in lanes)
    traffic = {edge: seen for edge, seen in ops.edge_traffic(sightings, edge_id_mode=mode).collect()}
    assert traffic == {**per_edge, None: 0}
    lanes_of = defaultdict(set)
    for lane in lanes:
        lanes_of[edge_by_hand(lane, mode)[0]].add(lane)
    expected = sorted(
        (lane, lanes.count(lane), edge, len(members)) for edge, members in lanes_of.items() if len(members) > 2 for lane in members
    )
    columns = ("vehicle_lane", "nb_cars", "edge_id", "nb_lanes")
    assert sorted(found(ops.lane_zipper(sightings, edge_id_mode=mode), *columns)) == expected
    counted = ops.cars_per_lane(sightings)
    assert sorted(found(ops.lane_zipper(counted, edge_id_mode=mode), *columns)) == expected
    assert found(ops.edge_traffic(counted, edge_id_mode=mode)) == sorted(traffic.items(), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seconds=st.lists(st.integers(-(10**10), 10**11), min_size=20, max_size=100),
    width=st.sampled_from([1, 60, 3600, 604800]),
    offset=st.integers(0, 604800),
)
def test_buckets(table, seconds, width, offset):
    rows = table(columns(ts=LONG), *[(second,) for second in seconds])
    buckets = rows.select("ts", bucket_start(rows.ts, width, offset).alias("start")).collect()
    for second, start in buckets:
        assert start <= second < start + width and (start - offset) % width == 0


def test_local_time_follows_the_zone_given(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Tokyo")
    instants = spark.createDataFrame([(1509235200,), (1509238800,), (1490490000,), (4102444800,)], "ts bigint")
    shown = instants.select(local_time(instants.ts, "Europe/Copenhagen").cast("string").alias("t"))
    assert [row.t for row in shown.collect()] == [
        "2017-10-29 02:00:00",
        "2017-10-29 02:00:00",
        "2017-03-26 03:00:00",
        "2100-01-01 01:00:00",
    ]


def test_views_from_client_hours(spark):
    chance = random.Random(5)
    rows = [
        (
            f"r{chance.randrange(4)}",
            chance.choice([None, *[f"c{n}" for n in range(15)]]),
            "os",
            chance.choice([None, "bad", f"{-chance.randrange(4000, 9000) / 100}"]),
            chance.choice([None, f"{chance.randrange(40)}"]),
            "net",
            chance.choice([None, 1506816000 + chance.randrange(20 * 86400)]),
        )
        for _ in range(3000)
    ]
    readings = spark.createDataFrame(rows, schemas.READINGS_TEXT)
    meta = spark.createDataFrame([("r0", "aud1"), ("r1", "xAUD2"), ("r2", "aud1 b")], schemas.META)
    hours = ops.client_hours(readings)
    for view in (ops.weekly_router_usage, ops.room_occupancy_hourly, ops.signal_quality_profile):
        expected = found(view(readings, meta))
        assert expected and found(view(hours, meta)) == expected


def test_weekly_accesses_add_up(spark):
    readings = spark.range(5000).selectExpr("string(id % 6) as did", "if(id % 11 = 0, null, string(id % 90)) as cid", "id * 997 as ts")
    meta = spark.range(6).selectExpr("string(id) as did", "'x' as location")
    total = ops.weekly_router_usage(readings, meta).agg({"accesses": "sum"}).first()[0]
    assert total == readings.where("cid is not null").count()
