from __future__ import annotations

from datetime import datetime

import pytest
from conftest import executed_plan, found

from lanebeacon import operators as ops
from lanebeacon import schemas


def client(cid, system="iOS", rssi=-60.5, ratio=20.0, ssid="net"):
    return (cid, system, rssi, ratio, ssid)


@pytest.fixture
def nested(table):
    return table(
        schemas.READINGS_RAW,
        ("r1", [([client("a"), client("b", None, None)], 100), ([], 160), (None, 220)]),
        ("r2", [([client("a")], 100)]),
        ("r3", []),
        ("r4", None),
        ("r5", [([None], 100)]),
    )


def test_flatten_readings(nested):
    assert found(ops.flatten_readings(nested)) == sorted(
        [
            ("r1", "a", "iOS", -60.5, 20.0, "net", 100),
            ("r1", "b", None, None, 20.0, "net", 100),
            ("r2", "a", "iOS", -60.5, 20.0, "net", 100),
            ("r5", None, None, None, None, None, 100),
        ],
        key=repr,
    )


def test_flatten_readings_has_the_master_schema(nested):
    assert ops.flatten_readings(nested).schema.simpleString() == schemas.READINGS.simpleString()


def test_nesting_and_flattening_gives_the_same_rows(spark, table):
    flat = [(f"r{i % 3}", f"c{i % 5}", "os", float(-i), float(i), "net", 60 * (i % 7)) for i in range(200)]
    groups = {}
    for did, *fields, ts in flat:
        groups.setdefault(did, {}).setdefault(ts, []).append(tuple(fields))
    raw = table(
        schemas.READINGS_RAW, *[(did, [(clients, ts) for ts, clients in by_ts.items()]) for did, by_ts in groups.items()]
    )
    assert found(ops.flatten_readings(raw)) == sorted(flat, key=repr)


def test_device_sightings_filters_before_flattening(nested):
    seen = ops.device_sightings(nested, "r2")
    assert found(seen, "did", "cid") == [("r2", "a")]
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Filter")


def test_flattening_does_not_shuffle(nested):
    plan = executed_plan(ops.flatten_readings(nested))
    assert "Exchange" not in plan and "EvalPython" not in plan


def test_clean_locations(table):
    meta = table(schemas.META, ("1", "change_me"), ("2", "aud1"), ("3", None))
    assert found(ops.clean_locations(meta)) == [("1", "unknown"), ("2", "aud1"), ("3", None)]


def booking(name="Maths", room="A", lecturers="x", start="10:15", start_date="2017-10-02", end="12:00"):
    return (name, start_date, "2017-10-02", start, end, room, "lecture", lecturers, "CS")


def test_explode_bookings_lists(table):
    raw = table(schemas.BOOKINGS_RAW, booking(room="r1, r2", lecturers="x,y"))
    assert found(ops.explode_bookings(raw), "room", "lecturers") == [(" r2", "x"), (" r2", "y"), ("r1", "x"), ("r1", "y")]
    assert found(ops.explode_bookings(raw, trim=True), "room").count(("r2",)) == 2


@pytest.mark.parametrize(
    "room, rooms", [("", [("",)]), (None, []), ("A,A", [("A",), ("A",)]), ("A,,B", [("",), ("A",), ("B",)])]
)
def test_explode_bookings_edge_cases(table, room, rooms):
    assert found(ops.explode_bookings(table(schemas.BOOKINGS_RAW, booking(room=room))), "room") == rooms


def test_explode_bookings_removes_copies(table):
    raw = table(schemas.BOOKINGS_RAW, *[booking()] * 50, booking(end="13:00"))
    assert ops.explode_bookings(raw).count() == 2


def test_explode_bookings_per_file(spark, table):
    raw = table(schemas.BOOKINGS_RAW, booking(), booking())
    in_two_files = raw.selectExpr("*", "'one' as source_file").union(raw.selectExpr("*", "'two' as source_file"))
    assert ops.explode_bookings(in_two_files, scope="file").count() == 2
    assert ops.explode_bookings(in_two_files).count() == 1
    with pytest.raises(ValueError):
        ops.explode_bookings(raw, scope="day")


@pytest.mark.parametrize(
    "date, time, expected",
    [
        ("2017-10-02", "13:30", datetime(2017, 10, 2, 13, 30)),
        ("2017-10-02", "8:05", datetime(2017, 10, 2, 8, 5)),
        ("2017-10-02", "", None),
        ("2017-10-02", None, None),
        ("2017-13-02", "10:00", None),
        ("2017-10-02", "24:30", None),
        ("soon", "10:00", None),
    ],
)
def test_booking_times(table, conf, date, time, expected):
    conf(spark__sql__session__timeZone="America/New_York")
    raw = table(schemas.BOOKINGS_RAW, booking(start=time, start_date=date))
    assert found(ops.explode_bookings(raw), "start_ts") == [(expected,)]


def test_booking_times_in_a_clock_change_gap(table, conf):
    conf(spark__sql__session__timeZone="America/New_York")
    raw = table(schemas.BOOKINGS_RAW, booking(start_date="2024-03-10", start="02:30"))
    assert found(ops.explode_bookings(raw), "start_ts") == [(datetime(2024, 3, 10, 2, 30),)]


def test_bookings_have_the_master_schema(table):
    raw = table(schemas.BOOKINGS_RAW, booking())
    assert ops.explode_bookings(raw).schema.simpleString() == schemas.BOOKINGS.simpleString()
