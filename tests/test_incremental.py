"""Views kept up to date, counts of a stream, stored sketches, and loads in one scan."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from conftest import found

from lanebeacon import operators as ops
from lanebeacon import schemas, sources
from lanebeacon.plans import incremental, wifi
from lanebeacon.plans.shared import shared_folder, written_once
from lanebeacon.streaming import close_hours, read_occupancy, stream_occupancy
from lanebeacon.streaming.occupancy import sightings

START = int(datetime(2017, 10, 1, 10, tzinfo=timezone.utc).timestamp())
HOUR = 3600


def router(did, *seen):
    clients = [{"ts": ts, "clients": [{"cid": cid, "rssi": -60.0, "snRatio": 20.0, "ssid": "net"}]} for cid, ts in seen]
    return {"did": did, "readings": clients}


def write(path, *documents):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(document) for document in documents))
    return str(path)


@pytest.fixture
def meta(spark):
    return spark.createDataFrame([("r1", "x aud1"), ("r2", "aud2"), ("r3", "canteen"), ("r4", "aud1 north")], schemas.META)


# Loads


def cids(spark, master):
    return found(sources.read_readings_master(spark, master), "cid")


def test_partitioned_folders_lose_the_rows_of_an_emptied_file(spark, tmp_path):
    raw, master = tmp_path / "raw", str(tmp_path / "master")
    write(raw / "d=1" / "a b%25c é-1-10-2017.json", router("r1", ("a", 1), ("b", 2), ("c", 3)))
    write(raw / "d=2" / "2-10-2017.json", router("r1", ("d", 1), ("e", 2)))
    loaded = wifi.load_readings(spark, str(raw), master)
    assert (loaded.files, loaded.read, loaded.kept, loaded.rejected) == (2, 2, 5, 0)
    write(raw / "d=2" / "2-10-2017.json")
    loaded = wifi.load_readings(spark, str(raw), master)
    assert (loaded.files, loaded.read, loaded.kept) == (2, 1, 3)
    assert cids(spark, master) == [("a",), ("b",), ("c",)]
    write(raw / "d=1" / "a b%25c é-1-10-2017.json")
    assert wifi.load_readings(spark, str(raw / "d=1"), master).kept == 0
    empty = sources.read_readings_master(spark, master)
    assert empty.count() == 0 and empty.columns == [*schemas.READINGS.names, "ingest_date", "file_key"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_readings_master(spark, str(tmp_path / "nowhere"))


def test_only_the_days_of_a_load_are_listed(spark, tmp_path, monkeypatch):
    raw, master = tmp_path / "raw", str(tmp_path / "master")
    for day in range(1, 6):
        write(raw / f"{day}-10-2017.json", router("r1", (f"c{day}", day)))
    wifi.load_readings(spark, str(raw), master)
    seen = []
    plain = wifi.partitions_of
    monkeypatch.setattr(wifi, "partitions_of", lambda s, m, files: seen.append(plain(s, m, files)) or seen[-1])
    wifi.load_readings(spark, str(raw / "3-10-2017.json"), master)
    assert all(len(found) == 1 and "ingest_date=2017-10-03" in next(iter(found)) for found in seen if found) and any(seen)
    assert len(cids(spark, master)) == 5


def test_counts_of_a_load_and_one_scan_of_its_files(spark, tmp_path, monkeypatch):
    path = Path(write(tmp_path / "raw" / "1-10-2017.json", router("r1", ("a", 1)), router("r2", ("b", 2), ("c", 3)), {"did": "r3"}))
    path.write_text(path.read_text() + '\n{"did": "r2", "readings": [{"cl\nnonsense')
    plans, plain = [], written_once

    def counted(rows, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return plain(rows, name)

    monkeypatch.setattr(wifi, "written_once", counted)
    loaded = wifi.load_readings(spark, str(path), str(tmp_path / "master"))
    assert (loaded.files, loaded.read, loaded.kept, loaded.rejected) == (1, 5, 3, 2)
    # All later steps start from what is written there.
    assert len(plans) == 1 and plans[0].count("FileScan json") == 1
    assert spark.read.parquet(f"{tmp_path}/master.rejected").count() == 2
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    left = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    assert not [f for f in left if f.getPath().getName().startswith("parsed-")]


def test_loads_of_files_without_a_line(spark, tmp_path):
    path = write(tmp_path / "raw" / "1-10-2017.json")
    loaded = wifi.load_readings(spark, path, str(tmp_path / "master"))
    assert (loaded.files, loaded.read, loaded.kept, loaded.rejected) == (1, 0, 0, 0)
    loaded = wifi.load_bookings(spark, path, str(tmp_path / "bookings"))
    assert (loaded.files, loaded.read, loaded.kept, loaded.rejected) == (1, 0, 0, 0)


class Cluster:
    def __init__(self, master):
        self.sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None)})
        known = {"spark.master": master, "spark.sql.warehouse.dir": "file:/w"}
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: known.get(key) or default)})


def test_a_cluster_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(Cluster(master))
    assert shared_folder(Cluster("local[*]")) == "file:/w/lanebeacon-work"


# Views kept up to date


def data_files(folder):
    return {str(path): path.stat().st_mtime_ns for path in Path(folder).rglob("*.parquet")}


def test_only_changed_files_are_computed_anew(spark, tmp_path, meta):
    raw, master, target = tmp_path / "raw", str(tmp_path / "master"), str(tmp_path / "views")
    hours = f"{target}/client_hours"
    for day in range(1, 5):
        write(raw / f"{day}-10-2017.json", router("r1", ("a", START + day), ("b", START + day)), router("r2", ("a", START)))
    wifi.load_readings(spark, str(raw), master)
    assert incremental.update_wifi_views(spark, master, meta, target) == incremental.Refreshed(4, 0)
    before = data_files(hours)
    assert incremental.update_wifi_views(spark, master, meta, target) == incremental.Refreshed(0, 0)
    assert data_files(hours) == before
    # One replaced, one emptied, one added, two as they were.
    write(raw / "1-10-2017.json", router("r1", ("new", START)))
    write(raw / "2-10-2017.json")
    write(raw / "5-10-2017.json", router("r1", ("late", START + HOUR)))
    wifi.load_readings(spark, [str(raw / f"{day}-10-2017.json") for day in (1, 2, 5)], master)
    assert incremental.update_wifi_views(spark, master, meta, target) == incremental.Refreshed(2, 1)
    after = data_files(hours)
    same = {path for path in after if before.get(path) == after[path]}
    assert len(same) == sum("ingest_date=2017-10-03" in path or "ingest_date=2017-10-04" in path for path in before)
    readings = sources.read_readings_master(spark, master)
    for name, view in (("router_usage", ops.weekly_router_usage), ("room_occupancy", ops.room_occupancy_hourly), ("signal_quality", ops.signal_quality_profile)):
        written = spark.read.csv(f"{target}/{name}", header=True)
        assert found(written) == sorted((tuple(map(str, row)) for row in view(readings, meta).collect()), key=repr)


def test_a_master_that_became_empty_leaves_empty_views(spark, tmp_path, meta):
    raw, master, target = tmp_path / "raw", str(tmp_path / "master"), str(tmp_path / "views")
    path = write(raw / "1-10-2017.json", router("r1", ("a", START)))
    wifi.load_readings(spark, path, master)
    incremental.update_wifi_views(spark, master, meta, target)
    write(raw / "1-10-2017.json")
    wifi.load_readings(spark, path, master)
    assert incremental.update_wifi_views(spark, master, meta, target) == incremental.Refreshed(0, 1)
    assert incremental.read_client_hours(spark, f"{target}/client_hours").count() == 0


def test_a_run_that_failed_is_done_again(spark, tmp_path, meta, monkeypatch):
    raw, master, hours = tmp_path / "raw", str(tmp_path / "master"), str(tmp_path / "hours")
    wifi.load_readings(spark, write(raw / "1-10-2017.json", router("r1", ("a", START))), master)
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "write_master", lambda *_, **__: 1 // 0)
        with pytest.raises(ZeroDivisionError):
            incremental.refresh_client_hours(spark, master, hours)
    assert incremental.refresh_client_hours(spark, master, hours) == incremental.Refreshed(1, 0)
    assert incremental.read_client_hours(spark, hours).count() == 1


# A stream of occupancy


def occupancy(spark, target):
    return [(row["location"], row["from_time"], row["devices"]) for row in read_occupancy(spark, target).orderBy("from_time", "location").collect()]


def test_hours_are_written_once_they_are_final(spark, tmp_path, meta):
    folder, target = tmp_path / "raw", str(tmp_path / "occupancy")

    def run():
        return stream_occupancy(spark, str(folder), meta, target, delay="30 minutes").late

    write(folder / "1.json", router("r1", ("a", START), ("a", START + 3599), ("b", START + 10)), router("r4", ("a", START + 5)), router("r3", ("z", START)))
    assert run() == 0 and occupancy(spark, target) == []
    # The same clients again, in the same hour.
    write(folder / "2.json", router("r1", ("b", START + 3000), ("c", START + 20)))
    assert run() == 0 and occupancy(spark, target) == []
    write(folder / "3.json", router("r1", ("c", START + 40), ("a", START + HOUR), (None, START + HOUR)))
    assert run() == 0 and occupancy(spark, target) == [("Aud1", "10:00 AM", 3)]
    write(folder / "4.json", router("r2", ("a", START + 2 * HOUR)))
    assert run() == 0 and len(occupancy(spark, target)) == 2
    # Too late: the hour has been written.
    write(folder / "5.json", router("r1", ("d", START + 30), ("e", START + 2 * HOUR)))
    assert run() == 1
    close_hours(spark, target, START + 24 * HOUR)
    assert run() == 0
    assert occupancy(spark, target) == [("Aud1", "10:00 AM", 3), ("Aud1", "11:00 AM", 1), ("Aud1", "12:00 PM", 1), ("Aud2", "12:00 PM", 1)]
    assert run() == 0 and len(occupancy(spark, target)) == 4


def test_lines_and_rows_that_cannot_be_counted(spark, tmp_path, meta):
    folder, target = tmp_path / "raw", str(tmp_path / "occupancy")
    path = Path(write(folder / "1.json", router("r1", ("a", None), (None, START)), {"did": None}, {"did": "r1", "readings": []}))
    path.write_text(path.read_text() + "\nnonsense")
    stream_occupancy(spark, str(folder), meta, target)
    close_hours(spark, target, START + 9 * HOUR)
    stream_occupancy(spark, str(folder), meta, target)
    assert occupancy(spark, target) == [("Aud1", "10:00 AM", 0)]
    assert sightings(spark, str(folder), target).isStreaming


# Sketches


def test_sketches_of_hours_add_up_to_weeks_and_rooms(spark, meta):
    seen = spark.range(60_000).selectExpr(
        "concat('r', 1 + id % 4) as did", "concat('c', (id * 7919) % 9000) as cid", f"{START} + (id * 31) % {20 * 24 * HOUR} as ts"
    )
    sketches = ops.client_sketches(seen)
    assert set(sketches.columns) == {"did", "ts", "client_sketch", "accesses"}
    for view, keys, count in ((ops.weekly_router_usage, ["did", "from_day"], "unique_clients"), (ops.room_occupancy_hourly, ["location", "day", "from_time"], "devices")):
        exact = {tuple(row[k] for k in keys): row[count] for row in view(seen, meta).collect()}
        near = {tuple(row[k] for k in keys): row[count] for row in view(sketches, meta).collect()}
        assert set(exact) == set(near) and all(abs(near[k] - n) <= max(0.03 * n, 0.5) for k, n in exact.items())
    accesses = [sorted(row["accesses"] for row in ops.weekly_router_usage(rows, meta).collect()) for rows in (seen, sketches)]
    assert accesses[0] == accesses[1]
    # From hours per client they are as good.
    again = ops.client_sketches(ops.client_hours(seen.selectExpr("*", "1.0 as rssi", "2.0 as snRatio")))
    for one, other in zip(found(ops.weekly_router_usage(again, meta)), found(ops.weekly_router_usage(seen, meta))):
        assert one[:4] == other[:4] and one[5] == other[5] and abs(one[4] - other[4]) <= 0.03 * other[4]


def test_sketches_of_nobody(spark, meta):
    seen = spark.createDataFrame([("r1", None, START), ("r1", None, None)], "did string, cid string, ts bigint")
    assert found(ops.weekly_router_usage(ops.client_sketches(seen), meta), "unique_clients", "accesses") == [(0, 0)]


def test_hours_are_kept_apart_by_file(spark):
    rows = spark.createDataFrame([("r1", "a", START, date(2017, 10, 1)), ("r1", "a", START, date(2017, 10, 2))], "did string, cid string, ts bigint, day date")
    rows = rows.selectExpr("*", "1.0 as rssi", "2.0 as snRatio")
    assert found(ops.client_hours(rows, ("day",)), "day", "accesses") == [(date(2017, 10, 1), 1), (date(2017, 10, 2), 1)]
    assert found(ops.client_hours(rows), "accesses") == [(2,)]
