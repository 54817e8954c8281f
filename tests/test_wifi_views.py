from __future__ import annotations

import pytest
from conftest import executed_plan, found

from lanebeacon import operators as ops
from lanebeacon import schemas

OCTOBER_1 = 1506816000  # 2017-10-01 00:00 UTC, a Sunday
HOUR = 3600
META = [("r1", "Hall aud1"), ("r2", "AUD2 north"), ("r3", "canteen")]


def reading(did="r1", cid="a", ts=OCTOBER_1, rssi="-60", ratio="20"):
    return (did, cid, "os", rssi, ratio, "net", ts)


@pytest.fixture
def readings(table):
    return lambda *rows: table(schemas.READINGS_TEXT, *rows)


@pytest.fixture
def meta(table):
    return table(schemas.META, *META)


def test_weekly_usage(readings, meta):
    seen = readings(reading(), reading(), reading(cid="b"), reading(cid=None), reading(did="r2"), reading(did="lost"))
    assert found(ops.weekly_router_usage(seen, meta)) == [
        ("r1", "Hall aud1", "2017.09.28, Thu", "2017.10.05 , Thu", 2, 3),
        ("r2", "AUD2 north", "2017.09.28, Thu", "2017.10.05 , Thu", 1, 1),
    ]


def test_weekly_usage_keeps_unlisted_routers_on_request(readings, meta):
    usage = ops.weekly_router_usage(readings(reading(did="lost")), meta, how="left")
    assert found(usage, "did", "location", "accesses") == [("lost", None, 1)]


def test_a_router_listed_twice_counts_twice(readings, table):
    twice = table(schemas.META, ("r1", "x"), ("r1", "y"))
    assert found(ops.weekly_router_usage(readings(reading()), twice), "location") == [("x",), ("y",)]


@pytest.mark.parametrize(
    "week_start, first", [("thursday", "2017.09.28, Thu"), ("monday", "2017.09.25, Mon"), ("sunday", "2017.10.01, Sun")]
)
def test_week_starts(readings, meta, week_start, first):
    usage = ops.weekly_router_usage(readings(reading()), meta, week_start=week_start)
    assert found(usage, "from_day") == [(first,)]


def test_week_edges_and_times_before_the_epoch(readings, meta):
    week = 7 * 24 * HOUR
    usage = ops.weekly_router_usage(readings(reading(ts=week - 1), reading(ts=week), reading(ts=-1)), meta)
    assert found(usage, "from_day", "accesses") == [("1969.12.25, Thu", 1), ("1970.01.01, Thu", 1), ("1970.01.08, Thu", 1)]


def test_rows_without_a_time_are_left_out(readings, meta):
    assert found(ops.weekly_router_usage(readings(reading(ts=None)), meta)) == []


def test_approximate_counts(readings, meta):
    usage = ops.weekly_router_usage(readings(*[reading(cid=f"c{i}") for i in range(200)]), meta, approx=True)
    (clients, accesses), = found(usage, "unique_clients", "accesses")
    assert accesses == 200 and 170 <= clients <= 230


def test_room_occupancy(readings, meta, table):
    rooms = table(schemas.META, *META, ("r4", "xaud1x"), ("r5", "aud3"), ("r6", None))
    seen = readings(
        reading(),
        reading(did="r4"),
        reading(did="r4", cid="b", ts=OCTOBER_1 + HOUR - 1),
        reading(did="r4", ts=OCTOBER_1 + HOUR),
        reading(did="r2", ts=OCTOBER_1 + 12 * HOUR),
        *[reading(did=did) for did in ("r3", "r5", "r6")],
    )
    assert found(ops.room_occupancy_hourly(seen, rooms)) == [
        ("Aud1", "2017.10.01 , Sun", "12:00 AM", "1:00 AM", 2),
        ("Aud1", "2017.10.01 , Sun", "1:00 AM", "2:00 AM", 1),
        ("Aud2", "2017.10.01 , Sun", "12:00 PM", "1:00 PM", 1),
    ]


def test_labels_do_not_follow_the_session_zone(readings, meta, conf):
    gap = 1710037815  # 2024-03-10 02:30 UTC, a time that New York clocks skip
    conf(spark__sql__session__timeZone="America/New_York")
    assert found(ops.room_occupancy_hourly(readings(reading(ts=gap)), meta)) == [
        ("Aud1", "2024.03.10 , Sun", "2:00 AM", "3:00 AM", 1)
    ]


def test_both_hours_of_the_autumn_clock_change_stay_apart(readings, meta):
    first = 1509235200  # 2017-10-29 00:00 UTC, 02:00 in Copenhagen; an hour later it is 02:00 again
    seen = readings(reading(ts=first), reading(ts=first + HOUR))
    occupancy = ops.room_occupancy_hourly(seen, meta, tz="Europe/Copenhagen")
    assert found(occupancy, "from_time", "to_time") == [("2:00 AM", "2:00 AM"), ("2:00 AM", "3:00 AM")]


def test_quality_is_a_mean_of_hourly_means(readings, meta):
    week = 7 * 24 * HOUR
    seen = readings(
        reading(rssi="-60", ratio="10"),
        reading(rssi="-62", ratio="10"),
        reading(rssi="-64", ratio="13"),
        reading(rssi="-80", ratio="20", ts=OCTOBER_1 + week),
    )
    assert found(ops.signal_quality_profile(seen, meta)) == [("r1", "Sun", "00", "01", -71, 15, 2, "Hall aud1")]


def test_quality_cuts_towards_zero_and_skips_bad_text(readings, meta):
    seen = readings(reading(rssi="-67.8", ratio="bad"), reading(rssi="bad", ratio="20.9"), reading(rssi=None, ratio=None))
    assert found(ops.signal_quality_profile(seen, meta), "avg_rssi", "avg_snRatio", "avg_accesses") == [(-67, 20, 3)]


def test_quality_of_the_last_hour_of_the_day(readings, meta):
    profile = ops.signal_quality_profile(readings(reading(ts=OCTOBER_1 + 23 * HOUR + 1800)), meta)
    assert found(profile, "weekday", "start_hour", "end_hour") == [("Sun", "23", "00")]


def test_quality_counts_beyond_smallint(spark, meta):
    busy = spark.range(40_000).selectExpr(
        "'r1' as did", "'a' as cid", "-60.0 as rssi", "20.0 as snRatio", f"{OCTOBER_1}L as ts"
    )
    assert found(ops.signal_quality_profile(busy, meta), "avg_accesses") == [(40_000,)]


def test_quality_of_whole_number_means_does_not_depend_on_row_order(readings, meta):
    measures = ["-0.1", "-0.2", "-0.3", "-9.4", "-10.1", "-3.9"]  # their mean is -4
    for rows in (measures, measures[::-1], sorted(measures)):
        seen = readings(*[reading(rssi=measure) for measure in rows]).coalesce(1)
        assert found(ops.signal_quality_profile(seen, meta), "avg_rssi") == [(-4,)]


@pytest.mark.parametrize("view", [ops.weekly_router_usage, ops.room_occupancy_hourly, ops.signal_quality_profile])
def test_views_are_the_same_without_broadcast(view, spark, meta, conf):
    seen = spark.range(3000).selectExpr(
        "concat('r', if(id % 3 = 0, 1, id % 5)) as did",
        "concat('c', id % 40) as cid",
        "cast(-id % 70 as string) as rssi",
        "cast(id % 30 as double) as snRatio",
        f"{OCTOBER_1} + id * 977 as ts",
    )
    expected = found(view(seen, meta))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = executed_plan(view(seen, meta))
    assert "SortMergeJoin" in plan
    assert found(view(seen, meta)) == expected and expected


@pytest.mark.parametrize("view", [ops.weekly_router_usage, ops.room_occupancy_hourly, ops.signal_quality_profile])
def test_views_stay_on_the_jvm_and_distributed(view, readings, meta):
    plan = executed_plan(view(readings(reading()), meta))
    for unwanted in ("NestedLoop", "Cartesian", "EvalPython", "SinglePartition", "Window"):
        assert unwanted not in plan
