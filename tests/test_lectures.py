from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from conftest import executed_plan, found

import bindings
from lanebeacon import operators as ops
from lanebeacon.functions.rooms import LECTURE_ROOMS
from lanebeacon.operators import lectures
from lanebeacon import schemas
from lanebeacon.schemas import STRING, WALL_TIME, columns

BOOKED = columns(name=STRING, room=STRING, start_ts=WALL_TIME, end_ts=WALL_TIME)
DAY = datetime(2017, 10, 2)


def epoch(moment: datetime) -> int:
    return int(moment.replace(tzinfo=timezone.utc).timestamp())


def at(hour=0, minute=0, second=0):
    return DAY + timedelta(hours=hour, minutes=minute, seconds=second)


@pytest.fixture
def sightings(table):
    return lambda *rows: table(
        schemas.READINGS, *[(did, cid, "os", -60.0, 20.0, "net", epoch(moment) if moment else None) for did, cid, moment in rows]
    )


@pytest.fixture
def meta(table):
    return table(schemas.META, ("r1", "bldg aud1 left"), ("r2", "AUD1 right"), ("r3", "aud2"), ("r4", "canteen"), ("r5", None))


def test_both_ends_count(sightings, meta, table):
    booked = table(BOOKED, ("Maths", "Aud 1", at(10, 15), at(11, 45)))
    seen = sightings(
        ("r1", "early", at(10, 14, 59)),
        ("r1", "start", at(10, 15)),
        ("r2", "middle", at(11)),
        ("r1", "end", at(11, 45)),
        ("r1", "late", at(11, 45, 1)),
        ("r3", "elsewhere", at(11)),
        ("r4", "canteen", at(11)),
        ("r5", "nowhere", at(11)),
        ("r9", "unlisted", at(11)),
        ("r1", "untimed", None),
    )
    assert found(ops.lecture_attendance(seen, meta, booked)) == [("Maths", "end"), ("Maths", "middle"), ("Maths", "start")]


def test_a_booking_within_one_bucket_looks_at_every_sighting(sightings, meta, table):
    booked = table(BOOKED, ("Short", "aud1", at(10, 20), at(10, 40)))
    seen = sightings(
        ("r1", "around", at(10, 10)), ("r1", "around", at(10, 50)), ("r1", "in", at(10, 10)), ("r1", "in", at(10, 30))
    )
    assert found(ops.lecture_attendance(seen, meta, booked)) == [("Short", "in")]


def test_copies_open_bookings_and_reversed_bookings(sightings, meta, table):
    booked = table(
        BOOKED,
        *[("Maths", "aud1", at(10), at(11))] * 5,
        ("Reversed", "aud1", at(11), at(10)),
        ("Open", "aud1", at(10), None),
        ("Roomless", None, at(10), at(11)),
        ("Other", "lab 7", at(10), at(11)),
    )
    seen = sightings(*[("r1", "a", at(10, minute)) for minute in range(30)])
    assert found(ops.lecture_attendance(seen, meta, booked)) == [("Maths", "a")]


def test_booking_times_are_local(sightings, meta, table):
    booked = table(BOOKED, ("Maths", "aud1", at(12), at(13)))
    seen = sightings(("r1", "utc", at(12, 30)), ("r1", "local", at(10, 30)))
    assert found(ops.lecture_attendance(seen, meta, booked, tz="Europe/Copenhagen"), "cid") == [("local",)]


def test_connections_count_each_time_once_and_everywhere(sightings, meta, table):
    booked = table(BOOKED, ("Maths", "aud1", at(10), at(11)), ("Physics", "aud2", at(10), at(11)))
    seen = sightings(
        ("r1", "a", at(10)), ("r2", "a", at(10)), ("r4", "a", at(20)), ("r1", "b", at(10, 30)), ("r3", "b", at(10, 45))
    )
    assert found(ops.lecture_connections(seen, meta, booked)) == [("Maths", 4), ("Physics", 2)]


@pytest.mark.parametrize("bucket_seconds", [3600, 600, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(sightings, table, seed, bucket_seconds):
    chance = random.Random(seed)
    rooms = ["A", "B"]
    rows = [(chance.choice(rooms), f"c{chance.randrange(12)}", at(8, 0, chance.randrange(4 * 3600))) for _ in range(400)]
    held = []
    for number in range(60):
        start = at(8, 0, chance.randrange(4 * 3600))
        length = chance.choice([0, 1, 30, 600, 3599, 3600, 3601, 7200, chance.randrange(9000)])
        held.append((f"l{number}", chance.choice(rooms), start, start + timedelta(seconds=length)))
    expected = {
        (name, cid)
        for name, room, start, end in held
        for did, cid, moment in rows
        if did == room and start <= moment <= end
    }
    meta = table(schemas.META, ("A", "A"), ("B", "B"), ("B", "B"))
    pairs = ops.lecture_attendance(
        sightings(*rows), meta, table(BOOKED, *held), rules=None, bucket_seconds=bucket_seconds
    )
    assert found(pairs) == sorted(expected, key=repr)


def test_one_room_and_client_with_a_third_of_all_sightings(spark, meta, table):
    second = f"{epoch(at(10))} + id % 7200"
    seen = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'r1', concat('r', id % 7)) as did", "if(id % 3 = 0, 'hot', concat('c', id % 500)) as cid", f"{second} as ts"
    )
    booked = table(BOOKED, ("Maths", "aud1", at(10, 5), at(10, 6)), ("Physics", "aud2", at(9), at(13)))
    rows = [(row.did, row.cid, row.ts) for row in seen.collect()]
    rooms = {"r1": "Maths", "r2": "Maths", "r3": "Physics"}
    spans = {"Maths": (epoch(at(10, 5)), epoch(at(10, 6))), "Physics": (epoch(at(9)), epoch(at(13)))}
    expected = set()
    for did, cid, ts in rows:
        name = rooms.get(did)
        if name and spans[name][0] <= ts <= spans[name][1]:
            expected.add((name, cid))
    assert found(ops.lecture_attendance(seen, meta, booked)) == sorted(expected, key=repr)


def test_a_booking_without_an_end(sightings, meta, table):
    booked = table(BOOKED, ("Open", "aud1", at(10, 0, 7), datetime(9999, 12, 31, 23, 59, 59)), ("Past", "aud1", datetime(1, 1, 1), at(9, 0, 1)))
    rows = [("r1", "before", at(9, 0, 2)), ("r1", "past", at(9, 0, 1)), ("r1", "start", at(10, 0, 7)), ("r1", "early", at(10, 0, 6)), ("r2", "later", DAY + timedelta(days=40_000, seconds=5))]
    for bucket_seconds in (60, 3600):
        pairs = found(ops.lecture_attendance(sightings(*rows), meta, booked, bucket_seconds=bucket_seconds))
        assert pairs == [("Open", "later"), ("Open", "start"), ("Past", "past")]
        pieces = lectures._booking_pieces(booked, LECTURE_ROOMS, "UTC", bucket_seconds)
        assert pieces.count() < 1500


def test_a_crowded_room_is_dealt_into_shares(spark, conf):
    conf(spark__sql__shuffle__partitions="16")
    seen = spark.range(1000).selectExpr("'r1' as did", "concat('c', id) as cid", f"{epoch(at(10))} + id % 3000 as ts")
    held = spark.range(600).selectExpr("concat('l', id) as name", "if(id < 0, 'B', 'A') as room", "timestamp_ntz'2017-10-02 10:00:00' as start_ts", "timestamp_ntz'2017-10-02 11:59:59' as end_ts")
    rooms = spark.createDataFrame([("r1", "A")], "did string, location string")
    clients = lectures._clients_per_bucket(seen.join(rooms.withColumnRenamed("location", "room"), "did"), 3600)
    pieces = lectures._booking_pieces(held, None, "UTC", 3600)
    met = lectures._meet(clients, pieces, (4, 3))
    cells = met.groupBy("client_share", "booking_share", F.spark_partition_id().alias("task")).count().where("count > 0").collect()
    assert len({(row[0], row[1]) for row in cells}) == 12 and len({row["task"] for row in cells}) >= 6
    assert max(row["count"] for row in cells) < 2 * 600_000 / 12
    assert ops.lecture_attendance(seen, rooms, held, rules=None).count() == 600_000


def test_plans_have_no_object_aggregate_and_one_scan(spark, tmp_path, meta, table):
    booked = table(BOOKED, ("Maths", "aud1", at(10, 5), at(10, 6)))
    path = str(tmp_path / "readings")
    spark.range(1000).selectExpr("'r1' as did", "concat('c', id % 9) as cid", f"{epoch(at(10))} + id as ts").write.parquet(path)
    connections = ops.lecture_connections(spark.read.parquet(path), meta, booked)
    assert "ObjectHashAggregate" not in executed_plan(connections)
    connections.collect()
    final = connections._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1


def test_long_bookings_are_never_broadcast(sightings, meta, table):
    booked = table(BOOKED, ("Exhibition", "aud1", at(0), at(24 * 365)))
    plan = executed_plan(ops.lecture_attendance(sightings(("r1", "a", at(5000))), meta, booked))
    assert "SortMergeJoin" in plan
    for unwanted in ("NestedLoop", "Cartesian", "EvalPython", "SinglePartition", "Window"):
        assert unwanted not in plan
    assert found(ops.lecture_attendance(sightings(("r1", "a", at(5000))), meta, booked)) == [("Exhibition", "a")]


def crowd(spark):
    """A third of the sightings and of the bookings in one room and hour."""
    seen = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'r1', concat('q', id % 50)) as did", "concat('c', id) as cid", f"{epoch(at(10))} + if(id % 3 = 0, id % 3000, id * 17 % 86400) as ts"
    )
    held = spark.range(300).selectExpr(
        "concat('l', id) as name",
        "if(id % 3 = 0, 'A', concat('Q', id % 50)) as room",
        "timestamp_ntz'2017-10-02 10:00:00' + make_interval(0, 0, 0, 0, if(id % 3 = 0, 0, cast(id % 20 as int)), 0, 0) as start_ts",
        "timestamp_ntz'2017-10-02 10:59:58' + make_interval(0, 0, 0, 0, if(id % 3 = 0, 0, cast(id % 20 as int)), 0, 0) as end_ts",
    )
    rooms = spark.sql("select 'r1' as did, 'A' as location union all select concat('q', id), concat('Q', id) from range(50)")
    return seen, rooms, held


def test_crowded_spots_are_counted_and_get_the_shares_they_need(spark, conf, monkeypatch):
    conf(spark__sql__shuffle__partitions="8")
    monkeypatch.setattr(lectures, "FEW_PAIRS", 10)
    seen, rooms, held = crowd(spark)
    there = seen.join(rooms.withColumnRenamed("location", "room"), "did")
    pieces = lectures._booking_pieces(held, None, "UTC", 3600)
    crowded = lectures._crowded(there, pieces, 3600)
    assert [(c.room, c.level) for c in crowded] == [("A", 0)]
    clients = lectures._clients_per_bucket(there, 3600)
    met = lectures._meet(clients, pieces, crowded)
    tasks = [row["count"] for row in met.where("room = 'A'").groupBy(F.spark_partition_id()).count().collect()]
    # A hundred thousand pairs over eight tasks.
    assert len(tasks) == 8 and max(tasks) < 1.5 * sorted(tasks)[4] and sum(tasks) == 100_000
    others = met.where("room != 'A'").agg(F.max("client_share"), F.max("booking_share")).first()
    assert tuple(others) == (0, 0)
    expected = ops.lecture_attendance(seen, rooms, held, rules=None, shares=(1, 1))
    assert found(ops.lecture_attendance(seen, rooms, held, rules=None)) == found(expected)
    assert expected.where("name = 'l0'").count() == 1000


def test_small_and_empty_tables_are_not_dealt(spark):
    seen, rooms, held = crowd(spark)
    there = seen.join(rooms.withColumnRenamed("location", "room"), "did")
    pieces = lectures._booking_pieces(held, None, "UTC", 3600)
    assert lectures._crowded(there, pieces, 3600) == []
    assert lectures._crowded(there.where("1 = 0"), pieces, 3600) == []
    assert ops.lecture_attendance(seen.where("1 = 0"), rooms, held, rules=None).count() == 0
    assert ops.lecture_attendance(seen, rooms, held.where("1 = 0"), rules=None).count() == 0


def lectures_bucket():
    return epoch(at(10)) // 3600


def test_only_spots_with_a_booking_inside_a_bucket_keep_seconds(spark, table):
    booked = table(BOOKED, ("Short", "A", at(10, 20), at(10, 40)), ("Long", "B", at(10, 20), at(12)), ("Start", "C", at(10), at(10, 40)), ("End", "D", at(10, 20), at(10, 59, 59)))
    held = lectures._held(booked, None, "UTC")
    wanted = lectures._within_one_bucket(held, 3600)
    assert sum(byte.bit_count() for byte in wanted) == 1 and len(wanted) == lectures.FILTER_BITS // 8
    spots = spark.sql("select * from values ('A'), ('B'), ('C'), ('D') as t(room)").withColumn("bucket", F.lit(lectures_bucket()).cast("bigint"))
    assert [row["room"] for row in spots.where(lectures._passes(wanted)).collect()] == ["A"]
    seen = spark.range(500).selectExpr("element_at(array('A', 'B', 'C', 'D', 'E'), 1 + cast(id % 5 as int)) as room", "concat('c', id % 7) as cid", f"{epoch(at(10))} + id * 7 as ts")
    kept = lectures._clients_per_bucket(seen, 3600, wanted).where(f"level = {lectures.SECONDS}")
    assert {row["room"] for row in kept.collect()} == {"A"} and kept.count() == 100
    assert lectures._clients_per_bucket(seen, 3600, bytes(8)).where(f"level = {lectures.SECONDS}").count() == 0


def test_every_bit_of_the_filter_is_found(spark, monkeypatch):
    monkeypatch.setattr(lectures, "FILTER_BITS", 64)
    spots = spark.range(200).selectExpr("concat('room ', id) as room", "id * 13 as bucket")
    bits = {row["bit"] for row in spots.select(lectures._spot_bit().alias("bit")).collect()}
    assert len(bits) > 50
    for some in (bits, set(list(bits)[::2]), {0}, {7, 63}):
        wanted = bytes(sum(1 << bit for bit in range(8) if 8 * byte + bit in some) for byte in range(8))
        passed = spots.where(lectures._passes(wanted)).select(lectures._spot_bit().alias("bit")).collect()
        assert {row["bit"] for row in passed} == some & bits


def test_rooms_without_a_booking_are_left_out_early(sightings, meta, table):
    booked = table(BOOKED, ("Maths", "aud1", at(10), at(11)))
    seen = sightings(*[("r3", f"c{i}", at(10, i)) for i in range(50)], ("r1", "a", at(10, 5)))
    rooms = lectures._router_rooms(meta, LECTURE_ROOMS).join(lectures._held(booked, LECTURE_ROOMS, "UTC").select("room").distinct(), "room", "left_semi")
    assert found(rooms, "did") == [("r1",), ("r2",)]
    assert found(ops.lecture_attendance(seen, meta, booked)) == [("Maths", "a")]


def test_a_booking_and_a_client_meet_once(spark):
    """However long the booking and however often the client is seen: the pairs need no step that makes them distinct."""
    seen = spark.range(200).selectExpr("'A' as room", "concat('c', id % 4) as cid", f"{epoch(at(0))} + id * 400 as ts")
    held = spark.createDataFrame([("day", "A", at(0, 30), at(20)), ("hours", "A", at(3, 10), at(7, 5)), ("short", "A", at(9, 5), at(9, 50))], BOOKED)
    pieces = lectures._booking_pieces(held, None, "UTC", 3600)
    met = lectures._meet(lectures._clients_per_bucket(seen, 3600), pieces, (1, 1)).where(f"level != {lectures.SECONDS}")
    assert found(met, "name", "cid") == [(name, f"c{i}") for name in ("day", "hours") for i in range(4)]
    assert pieces.count() == 3


@pytest.mark.parametrize("name", ["if(id % 3 = 0, null, concat('l', id % 7))", "concat('l', id)"])
def test_names_with_several_bookings_and_unnamed_ones(spark, name):
    seen = spark.range(300).selectExpr("concat('r', id % 2) as did", "if(id % 11 = 0, null, concat('c', id % 5)) as cid", f"{epoch(at(8))} + id * 37 as ts")
    held = spark.range(30).selectExpr(
        f"{name} as name",
        "concat('r', id % 2) as room",
        "timestamp_ntz'2017-10-02 08:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 5 as int), 7) as start_ts",
        "timestamp_ntz'2017-10-02 08:00:00' + make_interval(0, 0, 0, 0, 0, cast(id * 5 + 1 + id % 9 * 20 as int), 0) as end_ts",
    )
    meta = spark.sql("select 'r0' as did, 'r0' as location union all select 'r1', 'r1'")
    rows = [(row.did, row.cid, row.ts) for row in seen.collect()]
    expected = {
        (b.name, cid) for b in held.collect() for did, cid, ts in rows if did == b.room and epoch(b.start_ts) <= ts <= epoch(b.end_ts)
    }
    assert found(ops.lecture_attendance(seen, meta, held, rules=None)) == sorted(expected, key=repr)
    times = {cid: len({ts for _, c, ts in rows if c == cid}) for _, cid, _ in rows if cid is not None}
    sums = {}
    for one, cid in expected:
        if cid is not None:
            sums[one] = sums.get(one, 0) + times[cid]
    assert found(ops.lecture_connections(seen, meta, held, rules=None)) == sorted(sums.items(), key=repr)


def test_counts_join_clients_and_not_pairs(spark):
    """A task adds up its pairs itself: above the join with the bookings no pair is shuffled by its client."""
    seen, rooms, held = crowd(spark)
    plan = ops.lecture_connections(seen, rooms, held, rules=None, shares=(1, 1))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    meeting = min(i for i, line in enumerate(lines) if "Join Inner" in line and "strategy=merge" in line)
    assert not any("Join" in line for line in lines[:meeting])


def test_clients_stand_only_in_cells_their_room_may_need(spark):
    seen = spark.range(100).selectExpr("'A' as room", "concat('c', id % 3) as cid", f"{epoch(at(0))} + id * 3000 as ts")
    held = spark.createDataFrame([("short", "A", at(3, 10), at(5, 5))], BOOKED)
    needed = lectures._located(lectures._held(held, None, "UTC"), 3600).select(lectures._bit(F.col("level")).alias("levels"), lectures._mark().alias("marks"))
    every, some = lectures._clients_per_bucket(seen, 3600, bytes(8)), lectures._clients_per_bucket(seen.crossJoin(needed), 3600, bytes(8))
    pieces = lectures._booking_pieces(held, None, "UTC", 3600)
    assert some.count() < every.count() / 100
    assert found(lectures._meet(some, pieces, (1, 1))) == found(lectures._meet(every, pieces, (1, 1)))


def test_spots_are_only_counted_where_a_room_may_be_crowded(spark, monkeypatch):
    """Two numbers bound the pairs of every room; the counts per room and bucket are left out where those are few."""
    counted = []
    count = lectures._crowded
    monkeypatch.setattr(lectures, "_crowded", lambda *args: counted.append(True) or count(*args))
    seen, rooms, held = crowd(spark)
    expected = found(ops.lecture_attendance(seen, rooms, held, rules=None, shares=(1, 1)))
    monkeypatch.setattr(lectures, "FEW_PAIRS", 10**9)
    assert found(ops.lecture_attendance(seen, rooms, held, rules=None)) == expected and not counted
    monkeypatch.setattr(lectures, "FEW_PAIRS", 10)
    assert found(ops.lecture_attendance(seen, rooms, held, rules=None)) == expected and counted


@pytest.mark.parametrize("n, copies, may_be", [(5, 1, False), (6, 1, True), (2, 3, True)])
def test_a_room_may_be_crowded(spark, monkeypatch, n, copies, may_be):
    """Sightings of all routers of a room count, untimed and unlisted ones do not; copies of bookings do."""
    monkeypatch.setattr(lectures, "FEW_PAIRS", 5)
    seen = spark.sql(f"select if(id % 2 = 0, 'r1', 'r2') as did, 'c' as cid, id as ts from range({n}) union all select 'r1', 'c', null from range(9) union all select 'r9', 'c', 1 from range(9)")
    rooms = spark.createDataFrame([("r1", "A"), ("r2", "A"), ("r3", None)], "did string, location string")
    held = spark.createDataFrame([("one", "A", at(0), at(1))] * copies + [("none", None, at(0), at(1))] * 9, BOOKED)
    assert lectures._may_be_crowded(seen, rooms, held, None) == may_be
    empty = held.where("false")
    assert lectures._may_be_crowded(seen, rooms, empty, None) == (n > 5)


@pytest.mark.parametrize("rules", [[("aud1", "One"), ("aud2", "Two")], None])
@pytest.mark.parametrize("few", [1, 100_000])
def test_times_of_bookings_stand_in_for_them(sightings, table, monkeypatch, rules, few):
    """Rooms are already reduced and times already in seconds: the rules and the zone are not applied again."""
    monkeypatch.setattr(lectures, "FEW_PAIRS", few)
    rooms = table(schemas.META, ("r1", "aud1"), ("r2", "aud2"), ("r3", "hall"))
    held = [("a", "Aud 1" if rules else "aud1", at(12), at(15)), ("b", "aud2", at(12, 10), at(12, 20)), (None, "aud1", at(9), at(16)), ("c", "hall", at(9), at(16))]
    booked = table(BOOKED, *held, held[0])
    seen = sightings(*[(f"r{n % 3 + 1}", f"c{n % 7}", at(10 + n % 5, n % 60)) for n in range(200)])
    times = ops.booked_times(booked, rules, tz="Europe/Copenhagen")
    assert times.columns == ["name", "room", "start", "end"] and times.count() == (3 if rules else 4)
    for view in (ops.lecture_attendance, ops.lecture_connections):
        expected = found(view(seen, rooms, booked, rules, tz="Europe/Copenhagen"))
        assert expected and found(view(seen, rooms, times, rules, tz="Europe/Copenhagen")) == expected


def test_auditorium_lectures_with_repeated_and_missing_keys(spark, tmp_path):
    """Only keys are joined; the rows are those of the lectures joined with the rooms by name."""
    rows = [(1, 1), (1, 6), (1, 6), (2, None), (None, 3), (3, 21), (4, 19)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    rooms = spark.read.parquet(f"{tmp_path}/orders.parquet").selectExpr(
        "cast(o_orderkey as string) as name", "if(o_custkey % 20 < 5, concat('Aud ', o_custkey % 20, ', door A'), 'Lab 7') as room"
    )
    expected = bindings.lectures(spark, str(tmp_path)).drop("room").join(rooms, "name")
    got = bindings.auditorium_lectures(spark, str(tmp_path))
    assert got.columns == expected.columns and found(got) == found(expected) and got.count() == 12
